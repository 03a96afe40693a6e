"""Quality rules on repetition: characters inside repeated n-grams and lines.

Words are runs without ASCII white space. Of every n-gram length the words inside windows
that occur twice or more in the text are marked, the first occurrence included, and the
characters of marked words are summed; a word under several windows counts once. Windows
are compared by rolling hashes over word numbers; what two equal hashes stand for is
compared word by word for ``exact`` lengths, and 64-bit hashes are trusted for the others.

Defined cases: null and empty texts have no words and fail; long texts are taken whole;
rows with an equal or null id are rows of their own; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from stepwise.llm.common import WORD_SLICE_BYTES, map_slices, slices, text_rows

#: Fixed values of the rule set: n-gram lengths and the largest share of characters inside repeated ones.
NGRAM_LIMITS = {5: 0.15, 7: 0.13, 10: 0.10}
LINE_CHARS_LIMIT = 0.30
LINES_LIMIT = 0.30
SYMBOL_LIMIT = 0.10
MIN_WORDS = 50
REPEAT_WINDOW = 3
REPEAT_PERCENT = 50

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, dup_line_chars long, "
    + ", ".join(f"dup_chars_{n} long" for n in NGRAM_LIMITS)
)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def covered(words: np.ndarray, doc: np.ndarray, n: int, exact: bool = False) -> np.ndarray:
    """Marks the words inside ``n``-word windows that occur twice or more in their document.

    ``words`` are word numbers below 2**32, ``doc`` is ascending. The hash of a window is
    rolled from the hashes of its halves, so that each length takes log2(n) vector steps.
    """
    total = len(words)
    inside = np.zeros(total, bool)
    if total < n:
        return inside
    count = total - n + 1
    whole = doc[:count] == doc[n - 1 :]
    # Hash of the n words from each place, built up from powers of two.
    with np.errstate(over="ignore"):
        level, size, have, done = words.astype(np.uint64) * _MIX ^ (words.astype(np.uint64) >> np.uint64(7)), 1, None, 0
        bits = n
        while bits:
            if bits & 1:
                have = level[:count] if have is None else _roll(have, level[done : done + count])
                done += size
            bits >>= 1
            if bits:
                level = _roll(level[: len(level) - size], level[size:])
                size *= 2
        key = have ^ (doc[:count].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    at = np.flatnonzero(whole)
    if len(at) < 2:
        return inside
    order = at[np.argsort(key[at], kind="stable")]
    a, b = order[:-1], order[1:]
    equal = (key[a] == key[b]) & (doc[a] == doc[b])
    if exact:
        words_equal = equal.copy()
        for i in range(n):
            words_equal &= words[a + i] == words[b + i]
        if (equal & ~words_equal).any():  # two windows share a hash
            return _covered_by_table(words, doc, n, at)
    starts = np.zeros(total + 1, np.int64)
    hit = np.zeros(count, bool)
    hit[a[equal]] = True
    hit[b[equal]] = True
    hits = np.flatnonzero(hit)
    np.add.at(starts, hits, 1)
    np.add.at(starts, hits + n, -1)
    return np.cumsum(starts[:-1]) > 0


def _covered_by_table(words: np.ndarray, doc: np.ndarray, n: int, at: np.ndarray) -> np.ndarray:
    seen: dict[tuple, list[int]] = {}
    for i in at.tolist():
        seen.setdefault((doc[i], *words[i : i + n].tolist()), []).append(i)
    inside = np.zeros(len(words), bool)
    for places in seen.values():
        if len(places) > 1:
            for i in places:
                inside[i : i + n] = True
    return inside


def _roll(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of two adjoining windows."""
    mixed = (left ^ (left >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + right
    return (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)


def _chars(raw: bytes) -> int:
    """Code points of UTF-8."""
    return len(raw.decode())


def measure(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The measurements of one slice of texts."""
    texts = batch.column("text").to_pylist()
    rows = len(texts)
    counts = np.zeros(rows, np.int64)
    numbers: dict[bytes, int] = {}
    words: list[np.ndarray] = []
    symbols, dup_lines, dup_line_chars, n_lines = (np.zeros(rows, np.int64) for _ in range(4))
    word_chars = np.zeros(rows, np.int64)
    number = numbers.setdefault
    for i, text in enumerate(texts):
        found = text.encode().split()
        counts[i] = len(found)
        words.append(np.fromiter((number(w, len(numbers)) for w in found), np.uint32, len(found)))
        word_chars[i] = len(text) - sum(map(text.count, SPACES))
        symbols[i] = sum(map(text.count, SYMBOLS))
        seen: set[str] = set()
        for line in text.split("\n"):
            if line in seen:
                dup_lines[i] += 1
                dup_line_chars[i] += len(line) - sum(map(line.count, SPACES))
            elif line.strip(SPACES):
                seen.add(line)
                n_lines[i] += 1
    flat = np.concatenate(words) if words else np.zeros(0, np.uint32)
    doc = np.repeat(np.arange(rows), counts)
    width = np.fromiter(map(_chars, numbers), np.int64, len(numbers))[flat] if len(flat) else np.zeros(0, np.int64)

    def per_doc(marked: np.ndarray, weight: np.ndarray | None = None) -> np.ndarray:
        picked = doc[marked]
        return np.bincount(picked, None if weight is None else weight[marked], rows).astype(np.int64)

    repeats = per_doc(covered(flat, doc, REPEAT_WINDOW, exact=True))
    failed = (counts < MIN_WORDS) | (100 * repeats > REPEAT_PERCENT * counts)
    chars = np.maximum(word_chars, 1)
    good = ~failed & (symbols <= SYMBOL_LIMIT * np.maximum(counts, 1))
    good &= (dup_line_chars <= LINE_CHARS_LIMIT * chars) & (dup_lines <= LINES_LIMIT * (n_lines + dup_lines))
    grams = {}
    for n, limit in NGRAM_LIMITS.items():
        grams[n] = per_doc(covered(flat, doc, n), width)
        good &= grams[n] <= limit * chars
    columns = [counts, word_chars, symbols, dup_lines, repeats, failed, good, dup_line_chars, *grams.values()]
    names = SCHEMA.replace(",", "").split()[::2]
    return pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, columns)], names)


def repetition(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: counts, characters inside repeated n-grams and lines, and the verdict ``kept``.

    Row-local: no shuffle, and a task holds one slice of texts.
    """
    return map_slices(text_rows(docs, key, text), measure, SCHEMA)


def keep_good(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that pass, with all their columns.

    The rules are measured beside the row and the verdict travels with it, so that rows with
    equal or null ids are judged one by one and nothing is joined or shuffled.
    """
    schema = docs.schema

    def run(batches):
        for part in slices(batches, text, WORD_SLICE_BYTES):
            at, whole = part.schema.get_field_index(text), part
            filled = pc.fill_null(part.column(at), "")
            verdict = measure(pa.RecordBatch.from_arrays([pa.nulls(part.num_rows, pa.int64()), filled], ["doc_id", "text"]))
            yield whole.filter(verdict.column("kept"))

    return docs.mapInArrow(run, schema)
