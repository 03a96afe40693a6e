"""Removal of line passages that occur elsewhere, by content-defined chunks.

Lines are the ``\\n``-split parts of a text. A rolling hash over the hashes of the last ``SPAN`` lines
ends a chunk where its low bits are zero, so that equal passages are cut alike from their ``SPAN``-th
line on, wherever they start and whatever stands beside them. A chunk with two or more filled lines
that occurs again is removed from every document but the one with the smallest id, where its
first occurrence stays.

Chunks leave the edges of a passage, and passages shorter than a chunk. These are found by windows
from each filled line to the next, in a second search: a window inside a chunk that is removed is not
looked up, so a passage that thousands of documents share sends its windows once, from the document
where it stays, and else only the few at its edges. Every passage with two or more filled lines is a chain
of chunks and windows, so all of it goes; what overlaps is one run. A run with fewer than ``LEAST_WORDS``
words stays: a signature or a heading of a few words is no passage.

Hashes only bring equal ranges together: those whose hash occurs twice are grouped by their
bytes, and a hash that stands for different bytes removes nothing.

Defined cases: null texts have no lines and stay null; lines alone are never removed; an
occurrence that overlaps the first one in its document stays; rows that repeat an id count as
one document, so the passage stays in each of them; a null id ranks behind all others; other
columns are kept as they are, but for one with the name of a result column, which the result
replaces.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepwise.llm.common import slices
from stepwise.session import stored

#: Filled lines in a window.
WINDOW = 2
#: Lines that decide about a boundary, and one place in so many is one.
SPAN, EVERY = 2, 4
#: A run of removed lines with fewer words stays.
LEAST_WORDS = 10
_BASE = np.uint64(0x9E3779B97F4A7C15)
_ALL = (1 << 64) - 1
_NO_ID = -(1 << 63)


def cut(lines: list[str]) -> list[tuple[int, int]]:
    """Content-defined chunks as ranges of line numbers."""
    hashes = np.array([xxhash.xxh64_intdigest(line) for line in lines], np.uint64)
    rolled = hashes.copy()
    with np.errstate(over="ignore"):
        for back in range(1, min(SPAN, len(lines))):  # lines further back weigh more powers of the base
            rolled[back:] += hashes[:-back] * _BASE ** np.uint64(back)
        rolled = (rolled ^ (rolled >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    ends = np.flatnonzero((rolled >> np.uint64(33)) % np.uint64(EVERY) == 0) + 1
    edges = sorted({0, *ends.tolist(), len(lines)})
    return list(zip(edges, edges[1:]))


def ranges(text: str, split: Callable[[list[str]], list[tuple[int, int]]] = cut) -> tuple[list[str], list[tuple[int, int]], list[tuple[int, int, tuple[int, int] | None]]]:
    """Lines, chunks of ``WINDOW`` filled lines or more, and windows with the chunk that holds each, if one does."""
    lines = text.split("\n")
    at = [i for i, line in enumerate(lines) if line.strip()]
    if len(at) < WINDOW:
        return lines, [], []
    chunks = []
    for a, b in split(lines):
        if bisect_left(at, b) - bisect_left(at, a) >= WINDOW:
            chunks.append((a, b))
    windows = []
    starts = [a for a, _ in chunks]
    for a, last in zip(at, at[WINDOW - 1 :]):
        home = bisect_right(starts, a) - 1
        inside = home >= 0 and last < chunks[home][1]
        windows.append((a, last + 1, chunks[home] if inside else None))
    return lines, chunks, windows


def _halves(chunk: str) -> tuple[int, int]:
    value = xxhash.xxh3_128_intdigest(chunk)
    return (value >> 64) - (1 << 63), (value & _ALL) - (1 << 63)


def _smaller(a: int | None, b: int | None) -> int | None:
    return b if a is None else a if b is None else min(a, b)


def _entries(batches):
    """One row per distinct text of the chosen ranges of a slice: smallest id and number of places."""
    for part in slices(batches, "text"):
        seen: dict[str, list] = {}
        for ident, text, chosen in zip(*(part.column(c).to_pylist() for c in ("doc_id", "text", "ranges"))):
            lines = text.split("\n")
            for r in chosen:
                entry = seen.setdefault("\n".join(lines[r["a"] : r["b"]]), [ident, 0])
                entry[0] = _smaller(entry[0], ident)
                entry[1] += 1
        rows = [(*_halves(chunk), chunk, *e) for chunk, e in seen.items()]
        cols = list(zip(*rows)) if rows else [()] * 5
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], ["h1", "h2", "chunk", "first_id", "places"])


_RANGE = "doc_id long, text_key long, h1 long, h2 long, a int, b int, again boolean"
_HOME = ", c1 long, c2 long, c_again boolean"


def _members(windows: bool, split: Callable = cut):
    """One row per chunk, or per window, of a document, and whether an equal one ends before it.

    A window also has the hash of the chunk that holds it, and whether that one stands before.
    """
    names = [f.split()[0] for f in (_RANGE + (_HOME if windows else "")).split(", ")]
    kinds = [pa.int64()] * 4 + [pa.int32(), pa.int32(), pa.bool_()] + ([pa.int64(), pa.int64(), pa.bool_()] if windows else [])

    def run(batches):
        for part in slices(batches, "text"):
            rows = []
            for ident, key, text in zip(*(part.column(n).to_pylist() for n in ("doc_id", "text_key", "text"))):
                lines, chunks, pairs = ranges(text, split)
                homes, ends = {}, {}
                for a, b in chunks:
                    chunk = "\n".join(lines[a:b])
                    homes[a, b] = (*_halves(chunk), ends.setdefault(chunk, b) <= a)
                    if not windows:
                        h1, h2, again = homes[a, b]
                        rows.append((ident, key, h1, h2, a, b, again))
                if windows:
                    ends = {}
                    for a, b, home in pairs:
                        chunk = "\n".join(lines[a:b])
                        rows.append((ident, key, *_halves(chunk), a, b, ends.setdefault(chunk, b) <= a, *homes.get(home, (None,) * 3)))
            cols = list(zip(*rows)) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names)

    return run


def repeated_chunks(docs: DataFrame) -> DataFrame:
    """Ranges that stand in two places or more: h1, h2, first_id. ``docs`` has doc_id, text and the ``ranges`` to look at."""
    entries = docs.select("doc_id", "text", "ranges").mapInArrow(_entries, "h1 long, h2 long, chunk string, first_id long, places long")
    by_bytes = entries.groupBy("h1", "h2", "chunk").agg(F.min("first_id").alias("first_id"), F.sum("places").alias("places"))
    by_hash = by_bytes.groupBy("h1", "h2").agg(
        F.count("*").alias("texts"), F.min("first_id").alias("first_id"), F.sum("places").alias("places")
    )
    return by_hash.where("texts = 1 AND places > 1").select("h1", "h2", "first_id")


def _owner() -> tuple:
    return F.coalesce("doc_id", F.lit(_NO_ID)).alias("__id"), F.col("text_key").alias("__key")


def _elsewhere(first: str, ident) -> Column:
    return F.col(first).isNotNull() & ((ident == _NO_ID) | (F.col(first) < ident))


def chunk_hashes(members: DataFrame) -> DataFrame:
    """Chunks whose hash occurs twice: h1, h2, first_id."""
    counted = members.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id"))
    return stored(counted.where("n > 1").drop("n"), "line-hashes")


def window_members(rows: DataFrame, repeated: DataFrame, split: Callable = cut) -> DataFrame:
    """Windows to look up: those that lie in a chunk whose hash stands before are left out.

    The chunk goes once its bytes were compared. Should they differ, which takes two texts of one 128-bit
    hash, its windows stay with it.
    """
    known = repeated.select(F.col("h1").alias("c1"), F.col("h2").alias("c2"), F.col("first_id").alias("__first"), F.lit(True).alias("__found"))
    ident = F.coalesce("doc_id", F.lit(_NO_ID))
    gone = F.coalesce(F.col("__found") & (F.col("c_again") | _elsewhere("__first", ident)), F.lit(False))
    found = rows.mapInArrow(_members(True, split), _RANGE + _HOME).join(known, ["c1", "c2"], "left")
    return found.where(~gone).select(*(f.split()[0] for f in _RANGE.split(", ")))


def _apply(schema_names: list[str], text: str, counts: bool, least_words: int):
    def run(batches):
        for part in slices(batches, text):
            values, removed, lines_removed = part.column(text).to_pylist(), part.column("__ranges").to_pylist(), []
            runs = [0] * len(values)
            for i, ranges in enumerate(removed):
                count = 0
                if ranges and values[i] is not None:
                    lines = values[i].split("\n")
                    keep = np.ones(len(lines), bool)
                    for r in ranges:
                        keep[r["a"] : r["b"]] = False
                    edges = np.flatnonzero(np.diff(keep.astype(np.int8), prepend=1, append=1))
                    for a, b in edges.reshape(-1, 2).tolist():
                        if sum(len(line.split()) for line in lines[a:b]) < least_words:
                            keep[a:b] = True
                    count = int((~keep).sum())
                    runs[i] = count and int((np.diff(keep.astype(np.int8), prepend=1) < 0).sum())
                    values[i] = "\n".join(line for line, k in zip(lines, keep) if k)
                lines_removed.append(count)
            columns = []
            for name in schema_names:
                if name == text:
                    columns.append(pa.array(values, pa.string()))
                elif counts and name == "lines_removed":
                    columns.append(pa.array(lines_removed, pa.int64()))
                elif counts and name == "chunks_removed":
                    columns.append(pa.array(runs, pa.int64()))
                else:
                    columns.append(part.column(name))
            yield pa.RecordBatch.from_arrays(columns, schema_names)

    return run


def clean_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", counts: bool = True, least_words: int = LEAST_WORDS) -> DataFrame:
    """The documents without repeated passages; with ``counts`` also ``chunks_removed`` (runs of removed lines) and ``lines_removed``.

    Hashes are counted first, chunks and then windows. Texts go through two shuffles, to the ranges whose
    hash occurs twice, of which alone the bytes are compared, and to their removals. A range that a third of the documents share is one row per slice in the
    comparison, reduced before the shuffle, and a splittable join side in the steps between.
    """
    filled = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), filled.alias("text"), F.xxhash64(filled).alias("text_key"))
    chunks = rows.mapInArrow(_members(False), _RANGE)
    hashes = chunk_hashes(chunks)
    windows = window_members(rows, hashes)
    twice = windows.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1").select("h1", "h2")
    found = chunks.join(hashes.select("h1", "h2"), ["h1", "h2"]).unionByName(windows.join(twice, ["h1", "h2"]))
    likely = stored(found.groupBy(*_owner()).agg(F.collect_set(F.struct("a", "b", "h1", "h2", "again")).alias("ranges")), "line-ranges")
    repeated = stored(repeated_chunks(rows.withColumns(dict(zip(("__id", "__key"), _owner()))).join(likely, ["__id", "__key"])), "line-chunks")
    removed = likely.select("__id", "__key", F.inline("ranges")).join(repeated, ["h1", "h2"])
    removed = removed.where(F.col("again") | _elsewhere("first_id", F.col("__id")))
    removed = removed.groupBy("__id", "__key").agg(F.collect_set(F.struct("a", "b")).alias("__ranges"))
    keyed = docs.withColumn("__id", F.coalesce(F.col(key).cast("long"), F.lit(_NO_ID))).withColumn("__key", F.xxhash64(filled))
    added = ["chunks_removed", "lines_removed"] if counts else []
    columns = [c for c in docs.columns if c.lower() not in added]
    schema = docs.select(*columns, *(F.lit(0).cast("long").alias(c) for c in added)).schema
    joined = keyed.join(removed, ["__id", "__key"], "left").select(*columns, "__ranges")
    return joined.mapInArrow(_apply([*columns, *added], text, counts, least_words), schema)
