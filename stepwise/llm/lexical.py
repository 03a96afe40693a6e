"""Ranked lexical search: sharded inverted index, Block-Max MaxScore, merged heaps.

``build_index`` cuts the documents into shards of bounded text. A shard has one row per term, with
its postings in blocks of ``BLOCK``: document numbers as gaps and term counts in one, two or
four bytes each, and per block the first and last document and the greatest impact. ``search`` ships
the postings of the asked terms to tasks that meet a block of items with a group of shards,
one shard at a time. For each item the terms are ordered by the most they can add. While the sum
of the smallest stays below the item's tenth best score so far, their lists are not essential: a
document that stands in no other list is never looked at. A document from the essential lists is
dropped as soon as its score and the block maxima of the other lists together stay below that score;
only blocks that still hold such a document are unpacked. Heaps are kept from shard to shard and
merged at the end. Scores are exact 64-bit integers, so pruning changes no result.

Defined cases: a null text has no term; each row is a document of its own, also when ids repeat; a
null id ranks after the others (and 2**63 - 1 reads as null); items that repeat an id are one item with
the terms of all; an item without terms, or whose terms no document has, has no row; empty tables
give none; equal scores go by document id; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stepwise.llm.common import ragged, slices, text_rows
from stepwise.session import stored

#: Text bytes of a shard; a longer text is a shard of its own.
SHARD_BYTES = 24 << 20
#: Postings of a block.
BLOCK = 128
#: Items that travel together, and shards that they meet in one group, about.
ITEM_BLOCK, GROUP_SHARDS = 256, 4
#: Parts of the score (fixed values): saturation and length shares in hundredths, and its unit.
BASE, PER_LENGTH, UNIT, TF, NORM = 10, 90, 1_000_000_000, 1000, 8
NO_ID = np.iinfo(np.int64).max

#: Per byte the lower-case letter, digit or byte above 127 itself, else 0.
_FOLD = np.array([c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 0 for c in range(256)], np.uint8)
_HEAD = np.dtype([("first", "<u4"), ("last", "<u4"), ("peak", "<u4")])


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array and where its texts begin and end."""
    wide = texts.type in (pa.large_string(), pa.large_binary())
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def _spans(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Folded bytes, text borders, and the start and end of every term."""
    raw, at = _bytes(texts)
    folded = _FOLD[raw]
    inside = np.zeros(len(raw) + 1, bool)
    inside[:-1] = folded != 0
    begins = inside[:-1].copy()
    begins[1:] &= ~inside[:-2]
    borders = at[:-1][at[:-1] < len(raw)]
    begins[borders] = inside[borders]
    stops = inside[:-1] & ~inside[1:]
    ends = at[1:][at[1:] > 0] - 1
    stops[ends] = inside[ends]
    return folded, at, np.flatnonzero(begins), np.flatnonzero(stops) + 1


def terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Document and term number of every term occurrence, and the terms."""
    folded, at, start, stop = _spans(texts)
    doc = np.searchsorted(at, start, "right") - 1
    offsets = np.concatenate([[0], np.cumsum(stop - start)])
    kind, width = (pa.string(), np.int32) if offsets[-1] < 1 << 31 else (pa.large_string(), np.int64)
    packed = pa.Array.from_buffers(kind, len(start), [None, pa.py_buffer(offsets.astype(width)), pa.py_buffer(folded[folded != 0])])
    coded = packed.dictionary_encode()
    return doc, np.asarray(coded.indices).astype(np.int64), coded.dictionary.cast(pa.string())


# -- index ---------------------------------------------------------------------------------


def totals(docs: DataFrame) -> tuple[int, int]:
    """Documents with a term, and all their terms. ``docs`` are ``text_rows``."""

    def run(batches):
        for part in slices(batches, "text"):
            _, at, start, _ = _spans(part.column("text"))
            n = np.diff(np.searchsorted(start, at))
            yield pa.RecordBatch.from_arrays([pa.array([int((n > 0).sum())]), pa.array([int(n.sum())])], ["docs", "terms"])

    row = docs.select("text").mapInArrow(run, "docs long, terms long").agg(F.sum("docs"), F.sum("terms")).first()
    return int(row[0] or 0), int(row[1] or 0)


def impact(tf: np.ndarray, length: np.ndarray, docs: int, all_terms: int) -> np.ndarray:
    norm = BASE + (PER_LENGTH * length.astype(np.int64) * docs) // all_terms
    return (UNIT * tf.astype(np.int64)) // (TF * tf.astype(np.int64) + NORM * norm)


def _width(peak: np.ndarray) -> np.ndarray:
    return np.where(peak < 1 << 8, 1, np.where(peak < 1 << 16, 2, 4)).astype(np.int64)


def _put(out: np.ndarray, at: np.ndarray, width: np.ndarray, values: np.ndarray) -> None:
    for k in range(4):
        own = width > k
        out[at[own] + k] = (values[own] >> (8 * k)) & 255


def shard_rows(ids: np.ndarray, texts: pa.Array, docs: int, all_terms: int) -> pa.RecordBatch:
    """The documents' row (term null) and one row per term: postings in blocks and their heads."""
    doc, code, names = terms(texts)
    rows = len(ids)
    length = np.bincount(doc, minlength=rows)
    key, tf = np.unique(code * rows + doc, return_counts=True)
    term, doc = key // rows, key % rows
    df = np.bincount(term, minlength=len(names))
    first = np.cumsum(df) - df
    place = np.arange(len(key)) - first[term]
    opens = place % BLOCK == 0
    block = np.cumsum(opens) - 1
    begin = np.flatnonzero(opens)
    gap = np.diff(doc, prepend=0)
    gap[opens] = 0
    heads = np.zeros(len(begin), _HEAD)
    heads["first"] = doc[begin]
    heads["last"] = doc[np.append(begin[1:], len(key)) - 1] if len(begin) else 0
    heads["peak"] = np.maximum.reduceat(impact(tf, length[doc], docs, all_terms), begin) if len(begin) else 0
    per_term = lambda values: np.maximum.reduceat(values, first) if len(first) else np.zeros(0, np.int64)
    gap_width, tf_width = _width(per_term(gap)), _width(per_term(tf))
    size = df * (gap_width + tf_width)
    at = np.cumsum(size) - size
    data = np.zeros(int(size.sum()), np.uint8)
    _put(data, at[term] + place * gap_width[term], gap_width[term], gap)
    _put(data, at[term] + df[term] * gap_width[term] + place * tf_width[term], tf_width[term], tf)
    blocks = -(-df // BLOCK)

    def binary(own: bytes, edges: np.ndarray, rest: bytes) -> pa.Array:
        offsets = np.concatenate([[0], len(own) + np.concatenate([[0], np.cumsum(edges)])])
        return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(own + rest)])

    cols = [
        pa.concat_arrays([pa.nulls(1, pa.string()), names]),
        pa.array(np.concatenate([[rows], df])),
        binary(length.astype("<i4").tobytes(), blocks * _HEAD.itemsize, heads.tobytes()),
        binary(ids.astype("<i8").tobytes(), size, data.tobytes()),
        *(pa.array(np.concatenate([[0], w]).astype(np.int32)) for w in (gap_width, tf_width)),
    ]
    return pa.RecordBatch.from_arrays(cols, ["term", "df", "heads", "data", "gap_width", "tf_width"])


_INDEX = "shard long, term string, df long, heads binary, data binary, gap_width int, tf_width int"


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, int, int]:
    """The index of all documents, written to the shared folder; documents with terms; all terms."""
    rows = text_rows(docs, key, text)
    n_docs, n_terms = totals(rows)

    def run(batches):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 24
        held: list[pa.RecordBatch] = []
        room = SHARD_BYTES

        def emit():
            nonlocal number
            whole = pa.Table.from_batches(held).combine_chunks()
            ids = np.asarray(whole.column("doc_id").combine_chunks().fill_null(NO_ID)).astype(np.int64)
            for chunk in pa.Table.from_batches([shard_rows(ids, whole.column("text").combine_chunks(), n_docs, n_terms)]).to_batches(20_000):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(chunk.num_rows, number)), *chunk.columns], ["shard", *chunk.schema.names])
            number += 1

        for part in slices(batches, "text", SHARD_BYTES // 4):
            size = int(_bytes(part.column("text"))[1][-1])
            if held and size > room:
                yield from emit()
                held, room = [], SHARD_BYTES
            held.append(part)
            room -= size
        if held:
            yield from emit()

    made = rows.mapInArrow(run, _INDEX) if n_terms else docs.sparkSession.createDataFrame([], _INDEX)
    return stored(made, "lexical-index"), n_docs, n_terms


# -- search --------------------------------------------------------------------------------


class Postings:
    """One term's list in a shard; blocks are unpacked on demand."""

    def __init__(self, weight: int, df: int, heads: bytes, data: bytes, gap_width: int, tf_width: int):
        self.weight, self.df = weight, df
        self.heads = np.frombuffer(heads, _HEAD)
        self.first, self.last = self.heads["first"].astype(np.int64), self.heads["last"].astype(np.int64)
        self.peak = weight * self.heads["peak"].astype(np.int64)
        self.most = int(self.peak.max())
        self.gaps = np.frombuffer(data, f"<u{gap_width}", df)
        self.counts = np.frombuffer(data, f"<u{tf_width}", df, df * gap_width)
        self.whole: tuple[np.ndarray, np.ndarray] | None = None
        self.unpacked = 0

    def unpack(self, blocks: np.ndarray, shard: Shard) -> tuple[np.ndarray, np.ndarray]:
        """Documents and contributions of some blocks, given in ascending order."""
        if self.whole is not None:
            pass
        elif len(blocks) == len(self.heads):
            self.whole = self._decode(np.arange(self.df), np.arange(len(self.heads)), shard)
        else:
            at = ragged(blocks * BLOCK, np.minimum(BLOCK, self.df - blocks * BLOCK))
            return self._decode(at, blocks, shard)
        return self.whole

    def _decode(self, at: np.ndarray, blocks: np.ndarray, shard: Shard) -> tuple[np.ndarray, np.ndarray]:
        self.unpacked += len(blocks)
        sizes = np.minimum(BLOCK, self.df - blocks * BLOCK)
        run = np.cumsum(self.gaps[at].astype(np.int64))
        base = self.first[blocks] - run[np.cumsum(sizes) - sizes]
        docs = run + np.repeat(base, sizes)
        tf = self.counts[at]
        return docs, self.weight * shard.impact(tf, docs)


class Shard:
    def __init__(self, ids: bytes, lengths: bytes, docs: int, all_terms: int):
        self.ids, self.lengths = np.frombuffer(ids, "<i8"), np.frombuffer(lengths, "<i4")
        self.docs, self.all_terms = docs, all_terms
        self.lists: dict[str, Postings] = {}

    def impact(self, tf: np.ndarray, docs: np.ndarray) -> np.ndarray:
        return impact(tf, self.lengths[docs], self.docs, self.all_terms)


class Heap:
    """The best documents of an item so far."""

    def __init__(self, top: int):
        self.top = top
        self.score, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def least(self) -> int:
        """The least score that can still enter."""
        return int(self.score[-1]) if len(self.score) == self.top else 1

    def offer(self, score: np.ndarray, ids: np.ndarray) -> None:
        score, ids = np.concatenate([self.score, score]), np.concatenate([self.ids, ids])
        order = np.lexsort((ids, -score))[: self.top]
        self.score, self.ids = score[order], ids[order]


def max_score(shard: Shard, asked: list[str], heap: Heap) -> None:
    """Offer a shard's best documents for an item to its heap."""
    lists = sorted((shard.lists[t] for t in asked if t in shard.lists), key=lambda p: p.most)
    least = heap.least()
    sums = np.cumsum([p.most for p in lists])
    essential = int(np.searchsorted(sums, least, "left")) if lists else 0  # lists before it cannot reach the least score together
    if essential == len(lists):
        return
    score = np.zeros(len(shard.ids), np.int64)
    for p in lists[essential:]:
        docs, adds = p.unpack(np.arange(len(p.heads)), shard)
        score[docs] += adds
    others = int(sums[essential - 1]) if essential else 0
    docs = np.flatnonzero(score + others >= least)
    docs = docs[score[docs] > 0] if not essential else docs
    score = score[docs]
    if essential and len(docs):
        # Block maxima of the other lists: a document that they cannot lift is dropped before anything is unpacked.
        homes, bounds = [], np.zeros((essential, len(docs)), np.int64)
        for i, p in enumerate(lists[:essential]):
            home = np.minimum(np.searchsorted(p.last, docs), len(p.last) - 1)
            there = (p.first[home] <= docs) & (docs <= p.last[home])
            bounds[i] = np.where(there, p.peak[home], 0)
            homes.append(home)
        most = score + bounds.sum(axis=0)
        left = np.flatnonzero(most >= least)
        for i in range(essential - 1, -1, -1):
            has = left[bounds[i, left] > 0]
            if len(has):
                found, adds = lists[i].unpack(np.unique(homes[i][has]), shard)
                at = np.minimum(np.searchsorted(found, docs[has]), len(found) - 1)
                gained = np.where(found[at] == docs[has], adds[at], 0)
                score[has] += gained
                most[has] += gained - bounds[i, has]
                left = left[most[left] >= least]
        docs, score = docs[left], score[left]
    good = score >= least
    heap.offer(score[good], shard.ids[docs[good]])


def item_terms(items: DataFrame, key: str, text: str) -> DataFrame:
    """Distinct (item_id, term)."""

    def run(batches):
        for part in slices(batches, "text"):
            doc, code, names = terms(part.column("text"))
            yield pa.RecordBatch.from_arrays([part.column("item_id").take(pa.array(doc)), names.take(pa.array(code))], ["item_id", "term"])

    return text_rows(items, key, text, "item_id").mapInArrow(run, "item_id long, term string").distinct()


_TRAVEL = "block long, group long, shard long, term string, weight long, items array<struct<id:long>>, df long, heads binary, data binary, gap_width int, tf_width int"


def search(
    index: DataFrame, n_docs: int, n_terms: int, items: DataFrame, top: int = 10, key: str = "item_id", text: str = "text"
) -> DataFrame:
    """Each item's best documents with a score above 0: item_id, rank, doc_id, score."""
    asked = stored(item_terms(items, key, text), "lexical-items")
    hits = stored(index.where("term IS NOT NULL").join(asked.select("term").distinct(), "term", "left_semi").select(*index.columns), "lexical-hits")
    weight = F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.sum("df") + 1).cast("double"))).cast("long")
    weights = hits.groupBy("term").agg(weight.alias("weight"))
    shards = index.where("term IS NULL")
    n_shards, n_items = shards.count(), asked.select("item_id").distinct().count()
    blocks = max(1, -(-n_items // ITEM_BLOCK))
    groups = max(1, -(-n_shards // GROUP_SHARDS))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    block = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    wanted = stored(
        asked.withColumn("block", block).join(weights, "term").groupBy("block", "term")
        .agg(F.first("weight").alias("weight"), F.collect_list(F.struct(F.col("item_id").alias("id"))).alias("items")),
        "lexical-wanted",
    )
    group = F.pmod(F.xxhash64("shard"), F.lit(groups)).alias("group")
    none = lambda kind: F.lit(None).cast(kind)
    fields = {f.split()[0]: f.split(" ", 1)[1] for f in _TRAVEL.split(", ")}
    whole = lambda df: df.select(*(F.col(c) if c in df.columns else none(kind).alias(c) for c, kind in fields.items()))
    questions = wanted.withColumn("group", every(groups)).withColumn("shard", F.lit(-1).cast("long"))
    documents = shards.select("*", group).withColumn("block", every(blocks))
    postings = hits.join(wanted.select("block", "term", "weight"), "term").select("*", group)
    rows = whole(questions).unionByName(whole(documents)).unionByName(whole(postings))
    dealt = rows.repartition(blocks * groups, "block", "group").sortWithinPartitions("block", "group", "shard", F.col("term").asc_nulls_first())

    def run(batches):
        now, items_of, heaps, shard, number = None, {}, {}, None, None

        def finish():
            if shard is not None:
                for item, its_terms in items_of.items():
                    max_score(shard, its_terms, heaps[item])

        def best():
            out = [(item, int(i) if i != NO_ID else None, int(s)) for item, h in heaps.items() for i, s in zip(h.ids, h.score)]
            cols = [pa.array([r[k] for r in out], pa.int64()) for k in range(3)]
            return pa.RecordBatch.from_arrays(cols, ["item_id", "doc_id", "score"])

        for batch in batches:
            where = list(zip(*(batch.column(c).to_pylist() for c in ("block", "group"))))
            shard_of, names = (batch.column(c).to_pylist() for c in ("shard", "term"))
            for i in range(batch.num_rows):
                value = lambda c, i=i: batch.column(c)[i].as_py()
                if where[i] != now:
                    if now is not None:
                        finish()
                        yield best()
                    now, items_of, heaps, shard, number = where[i], {}, {}, None, None
                if shard_of[i] == -1:
                    for item in value("items"):
                        items_of.setdefault(item["id"], []).append(names[i])
                        heaps.setdefault(item["id"], Heap(top))
                    continue
                if shard_of[i] != number:
                    finish()
                    number = shard_of[i]
                    shard = Shard(value("data"), value("heads"), n_docs, n_terms)
                    continue
                shard.lists[names[i]] = Postings(*map(value, ("weight", "df", "heads", "data", "gap_width", "tf_width")))
        if now is not None:
            finish()
            yield best()

    found = dealt.mapInArrow(run, "item_id long, doc_id long, score long")
    ranked = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")


def rank_documents(docs: DataFrame, items: DataFrame, top: int = 10) -> DataFrame:
    """Index all documents and rank them for every item."""
    index, n_docs, n_terms = build_index(docs)
    return search(index, n_docs, n_terms, items, top)
