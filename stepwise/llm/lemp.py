"""Hard negatives by exact inner products, with coordinate pruning in length buckets.

Rows are sorted by label and length and cut into buckets. A bucket keeps its vectors, their
lengths, and for every coordinate the list of its rows sorted by the value that the vector has
there after division by its length. For an anchor q and a least score t, a row p of the bucket can
only reach t if cos(q, p) >= t / (|q| * longest row). Within that angle of q, each coordinate
of p lies in a known interval, so a binary search in the sorted list gives the rows that are
feasible there. The rows that are feasible in all focus coordinates (the largest of |q|) are the
candidates, and only their integer inner products are computed.

Anchors travel in blocks. Every block meets every group of buckets once, in one task per block and
group, which holds one block and one bucket at a time. There the best scores found so far raise
the least score of the buckets that follow. A first pass finds each anchor's nearest rows of its
own label, whose scores then bound the second pass.

Defined cases: rows with a null id, label or vector, or with a null, NaN or infinite component take
no part. Shorter vectors count as padded with zeros; a component beyond 2**28 after quantisation
counts as 2**28. Rows that repeat an id stand for themselves; "other" rows are those of another id,
and an anchor id that repeats is answered once, for the row of the least label and vector. An anchor
without positives, and a positive without negatives in its range, give no row. An empty table gives
none; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stepwise.session import stored

#: Numbers in a bucket (rows x dimensions), and rows at most.
BUCKET_NUMBERS, BUCKET_ROWS = 1 << 18, 2048
#: A bucket ends where the label changes or lengths fall below this share of its first, once it has so many rows.
SHORTER, LEAST_ROWS = 0.9, 256
#: Anchors that travel together, and buckets that one task meets them with.
BLOCK_ANCHORS, GROUP_BUCKETS = 512, 8
#: Coordinates in which an anchor asks for feasible rows.
FOCUS = 6
#: Components are held within this, so that 64-bit sums are exact for any dimension in use.
LARGEST = 1 << 28
#: Room for rounding in the cosines of the bounds, far above what 64-bit arithmetic loses.
SLACK = 1e-9
NONE = np.iinfo(np.int64).min


def quantised(df: DataFrame, key: str, vector: str, label: str, scale: int = 256) -> DataFrame:
    """Valid rows: id long, label long, vec array<long> of floor(scale * component)."""
    x = lambda c: c.cast("double")
    bad = lambda c: c.isNull() | F.isnan(x(c)) | (F.abs(x(c)) == F.lit(float("inf")))
    edge = F.lit(float(LARGEST))
    whole = F.transform("vec", lambda c: F.floor(F.greatest(-edge, F.least(edge, x(c) * scale))).cast("long"))
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).alias("vec"))
    return rows.where("id IS NOT NULL AND label IS NOT NULL AND vec IS NOT NULL").where(~F.exists("vec", bad)).withColumn("vec", whole)


def _matrix(column: pa.Array) -> np.ndarray:
    """Lists of integers as one array, short ones padded with zeros."""
    offsets = np.asarray(column.offsets).astype(np.int64)
    flat = np.asarray(column.values).astype(np.int64)[offsets[0] : offsets[-1]]
    size = np.diff(offsets)
    width = int(size.max()) if len(size) else 0
    if len(size) and int(size.min()) == width:
        return flat.reshape(len(size), width)
    out = np.zeros((len(size), width), np.int64)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(flat)) - np.repeat(offsets[:-1] - offsets[0], size)] = flat
    return out


def _narrow(values: np.ndarray) -> np.ndarray:
    """The same integers in the fewest bytes."""
    peak = int(np.abs(values).max()) if values.size else 0
    return values.astype(np.int16 if peak < 1 << 15 else np.int32)


def _pad(matrix: np.ndarray, width: int) -> np.ndarray:
    return matrix if matrix.shape[1] >= width else np.pad(matrix, ((0, 0), (0, width - matrix.shape[1])))


# -- index ---------------------------------------------------------------------------------


def _cut(length: np.ndarray, label: np.ndarray, width: int) -> Iterator[tuple[int, int]]:
    limit = max(1, min(BUCKET_ROWS, BUCKET_NUMBERS // max(width, 1)))
    change = np.flatnonzero(np.diff(label)) + 1
    start = 0
    while start < len(length):
        stop = min(start + limit, len(length))
        ends = [stop]
        border = change[np.searchsorted(change, start + min(LEAST_ROWS, limit)) :][:1]
        ends += border.tolist()
        shorter = np.flatnonzero(length[start + LEAST_ROWS : stop] < SHORTER * length[start])
        if len(shorter):
            ends.append(start + LEAST_ROWS + int(shorter[0]))
        stop = min(ends)
        yield start, stop
        start = stop


def _bucket(ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> dict:
    length = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
    unit = vectors / np.where(length > 0, length, 1)[:, None]
    order = np.argsort(unit, axis=0, kind="stable").astype(np.uint16)
    return {
        "rows": len(ids),
        "least_label": int(labels.min()),
        "most_label": int(labels.max()),
        "ids": ids.astype("<i8").tobytes(),
        "labels": labels.astype("<i8").tobytes(),
        "vectors": _narrow(vectors).tobytes(),
        "lists": np.ascontiguousarray(order.T).tobytes(),
    }


_BUCKET = "bucket long, rows int, least_label long, most_label long, ids binary, labels binary, vectors binary, lists binary"


def build_index(rows: DataFrame) -> DataFrame:
    """One row per length bucket of ``quantised`` rows, written to the shared folder."""

    def run(batches):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def cut(last: bool):
            nonlocal number, held
            width = max(v.shape[1] for _, _, v in held)
            ids, labels = (np.concatenate([h[i] for h in held]) for i in (0, 1))
            vectors = np.concatenate([_pad(h[2], width) for h in held])
            length = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
            spans = list(_cut(length, labels, width))
            if not last:  # the last bucket may go on
                spans, rest = spans[:-1], spans[-1][0]
                held = [(ids[rest:], labels[rest:], vectors[rest:])]
            for a, b in spans:
                one = _bucket(ids[a:b], labels[a:b], vectors[a:b])
                yield pa.RecordBatch.from_pylist([{"bucket": number, **one}], schema=_arrow(_BUCKET))
                number += 1

        for batch in batches:
            if batch.num_rows:
                got = [np.asarray(batch.column(c)).astype(np.int64) for c in ("id", "label")]
                held.append((*got, _matrix(batch.column("vec"))))
                if sum(v.size for _, _, v in held) > 4 * BUCKET_NUMBERS:
                    yield from cut(False)
        if held:
            yield from cut(True)

    square = F.aggregate("vec", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double"))
    dealt = rows.withColumn("square", square).repartitionByRange("label", F.col("square").desc(), "id")
    ordered = dealt.sortWithinPartitions("label", F.col("square").desc(), "id").select("id", "label", "vec")
    return stored(ordered.mapInArrow(run, _BUCKET), "lemp-index")


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (field.split() for field in ddl.split(", "))])


# -- anchors -------------------------------------------------------------------------------


_BLOCK = "block long, q_ids binary, q_labels binary, q_vectors binary, q_low binary, q_high binary, q_rows int"


def pack_blocks(anchors: DataFrame, blocks: int, places: int) -> DataFrame:
    """Anchors (id, label, vec, low and high: arrays of ``places`` scores) as one row per block."""

    def pack(block: int, held: list[pa.RecordBatch]) -> pa.RecordBatch:
        one = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        ids, labels = (np.asarray(one.column(c)).astype("<i8") for c in ("id", "label"))
        vectors = _matrix(one.column("vec")).astype("<i4")
        low, high = (_matrix(one.column(c)).reshape(len(ids), places).astype("<i8") for c in ("low", "high"))
        made = [int(block), *(x.tobytes() for x in (ids, labels, vectors, low, high)), len(ids)]
        return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(made, _arrow(_BLOCK))], schema=_arrow(_BLOCK))

    def run(batches):
        now, held = None, []
        for batch in batches:
            block = np.asarray(batch.column("block"))
            for part in np.split(np.arange(batch.num_rows), np.flatnonzero(np.diff(block)) + 1):
                if not len(part):
                    continue
                if block[part[0]] != now:
                    if held:
                        yield pack(now, held)
                    now, held = block[part[0]], []
                held.append(batch.slice(int(part[0]), len(part)))
        if held:
            yield pack(now, held)

    dealt = anchors.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)))
    return dealt.repartition("block").sortWithinPartitions("block", "id").mapInArrow(run, _BLOCK)


class Anchors:
    """A block of anchors and, per anchor and place, the best scores found so far."""

    def __init__(self, row: dict, places: int, top: int, same_label: bool):
        n = self.n = row["q_rows"]
        self.ids, self.labels = (np.frombuffer(row[c], "<i8") for c in ("q_ids", "q_labels"))
        self.vectors = np.frombuffer(row["q_vectors"], "<i4").reshape(n, -1).astype(np.int64)
        self.low, self.high = (np.frombuffer(row[c], "<i8").reshape(n, places).copy() for c in ("q_low", "q_high"))
        self.length = np.sqrt((self.vectors.astype(np.float64) ** 2).sum(axis=1))
        self.unit = self.vectors / np.where(self.length > 0, self.length, 1)[:, None]
        self.focus = np.argsort(-np.abs(self.unit), axis=1, kind="stable")[:, :FOCUS]
        self.places, self.top, self.same = places, top, same_label
        empty = np.zeros(0, np.int64)
        self.best = [empty] * 3  # (anchor * places + place, score, id)

    def least(self) -> np.ndarray:
        """The least score that still counts, per anchor; places whose range is empty ask for nothing."""
        open_ = self.low <= self.high
        return np.where(open_, self.low, np.iinfo(np.int64).max).min(axis=1)

    def offer(self, anchor: np.ndarray, score: np.ndarray, ident: np.ndarray) -> None:
        slots, scores, idents = [self.best[0]], [self.best[1]], [self.best[2]]
        for place in range(self.places):
            fits = (score >= self.low[anchor, place]) & (score <= self.high[anchor, place])
            slots.append(anchor[fits] * self.places + place)
            scores.append(score[fits])
            idents.append(ident[fits])
        slot, score, ident = map(np.concatenate, (slots, scores, idents))
        order = np.lexsort((ident, -score, slot))
        slot, score, ident = slot[order], score[order], ident[order]
        first = np.flatnonzero(np.concatenate([[True], np.diff(slot) != 0])) if len(slot) else np.zeros(0, np.int64)
        rank = np.arange(len(slot)) - np.repeat(first, np.diff(np.append(first, len(slot))))
        kept = rank < self.top
        self.best = [slot[kept], score[kept], ident[kept]]
        last = np.flatnonzero(rank == self.top - 1)  # places that are full: nothing below their last score counts
        full = slot[last]
        self.low[full // self.places, full % self.places] = np.maximum(self.low[full // self.places, full % self.places], score[last])

    def found(self) -> pa.RecordBatch:
        slot, score, ident = self.best
        cols = [self.ids[slot // self.places], (slot % self.places).astype(np.int32), ident, score]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["anchor_id", "place", "id", "score"])


def feasible(anchor: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Per coordinate of a unit vector, the least and most that a unit vector within the cosine can have there."""
    own, reach = np.arccos(np.clip(anchor, -1, 1)), np.arccos(np.clip(cosine, -1, 1))
    return np.cos(np.minimum(own + reach, np.pi)) - SLACK, np.cos(np.maximum(own - reach, 0)) + SLACK


def search(block: Anchors, row: dict) -> tuple[int, int]:
    """Offer a bucket's rows to the anchors of a block. Returns (candidates, pairs) for tests and tuning."""
    n = row["rows"]
    ids, labels = (np.frombuffer(row[c], "<i8") for c in ("ids", "labels"))
    raw = row["vectors"]
    width = len(row["lists"]) // (2 * n)
    vectors = np.frombuffer(raw, "<i2" if len(raw) == 2 * n * width else "<i4").reshape(n, width).astype(np.float64)
    lists = np.frombuffer(row["lists"], "<u2").reshape(width, n)
    length = np.sqrt((vectors**2).sum(axis=1))
    longest, shortest = float(length.max()), float(length.min())
    least = block.least()
    active = least < np.iinfo(np.int64).max
    if block.same:
        active &= (block.labels >= row["least_label"]) & (block.labels <= row["most_label"])
    elif row["least_label"] == row["most_label"]:
        active &= block.labels != row["least_label"]
    peak = block.length * longest
    active &= ~((least > 0) & (peak * (1 + SLACK) < least))
    wanted = np.flatnonzero(active)
    if not len(wanted):
        return 0, 0
    both = min(width, block.vectors.shape[1])
    # The dot product of a longer vector with a shorter one ends with the shorter.
    rows, anchors = vectors[:, :both], block.vectors[:, :both].astype(np.float64)
    exact = (np.abs(rows).max(initial=0) * np.abs(anchors).max(initial=0) * both) < 2**53
    if not exact:
        rows, anchors = rows.astype(np.int64), block.vectors[:, :both]
    sorted_values: dict[int, np.ndarray] = {}
    everything: list[int] = []
    got: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    looked = 0

    def keep(anchor: np.ndarray, at: np.ndarray, score: np.ndarray) -> None:
        right = (score >= least[anchor]) & ((labels[at] == block.labels[anchor]) == block.same) & (ids[at] != block.ids[anchor])
        got.append((anchor[right], score[right].astype(np.int64), ids[at[right]]))

    for q in wanted.tolist():
        bound = float(least[q])
        scale = block.length[q] * (longest if bound > 0 else shortest)
        cosine = bound / scale if scale > 0 else -1.0
        ranges = []
        if cosine > -1:
            focus = block.focus[q]
            focus = focus[focus < width]
            low, high = feasible(block.unit[q, focus], cosine)
            for c, a, b in zip(focus.tolist(), low.tolist(), high.tolist()):
                if c not in sorted_values:
                    sorted_values[c] = vectors[lists[c], c] / np.where(length[lists[c]] > 0, length[lists[c]], 1)
                values = sorted_values[c]
                i, j = int(np.searchsorted(values, a, "left")), int(np.searchsorted(values, b, "right"))
                if j - i < n:
                    ranges.append((j - i, i, j, c))
        if not ranges:
            everything.append(q)
            continue
        seen = np.zeros(n, np.uint8)
        for _, i, j, c in ranges:
            seen[lists[c, i:j]] += 1
        candidates = np.flatnonzero(seen == len(ranges))
        looked += len(candidates)
        if len(candidates):
            keep(np.full(len(candidates), q), candidates, rows[candidates] @ anchors[q])
    if everything:
        chosen = np.array(everything)
        score = rows @ anchors[chosen].T
        at, q = np.nonzero(score >= least[chosen])
        looked += score.size
        keep(chosen[q], at, score[at, q])
    if got:
        block.offer(*(np.concatenate([g[i] for g in got]) for i in range(3)))
    return looked, n * len(wanted)


def meet(index: DataFrame, anchors: DataFrame, blocks: int, groups: int, places: int, top: int, same_label: bool) -> DataFrame:
    """Per anchor and place the best ``top`` rows of every group: anchor_id, place, id, score."""
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    left = index.withColumn("group", F.pmod(F.xxhash64("bucket"), F.lit(groups))).withColumn("block", every(blocks))
    right = pack_blocks(anchors, blocks, places).withColumn("group", every(groups))
    met = left.join(right.hint("merge"), ["block", "group"]).select(
        "block", "group", *(f.name for f in _arrow(_BUCKET) if f.name != "bucket"), *(f.name for f in _arrow(_BLOCK) if f.name != "block")
    )

    def run(batches):
        now, block = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                where = (batch.column("block")[i].as_py(), batch.column("group")[i].as_py())
                if where != now:
                    if block is not None:
                        yield block.found()
                    now = where
                    block = Anchors({c: batch.column(c)[i].as_py() for c in batch.schema.names if c.startswith("q_")}, places, top, same_label)
                search(block, {c: batch.column(c)[i].as_py() for c in batch.schema.names if not c.startswith("q_")})
        if block is not None:
            yield block.found()

    return met.mapInArrow(run, "anchor_id long, place int, id long, score long")


def hard_negatives(
    df: DataFrame,
    anchor: str = "id % 100 = 0",
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    positives: int = 5,
    negatives: int = 5,
    share: tuple[int, int] = (80, 100),
    scale: int = 256,
) -> DataFrame:
    """Per anchor and positive, the best rows of other labels within ``share`` of the positive's score.

    ``anchor`` is a condition on ``id``. Returns anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score.
    """
    rows = quantised(df, key, vector, label, scale)
    index = build_index(rows)
    known = rows.where(anchor).groupBy("id").agg(F.min(F.struct("label", "vec")).alias("row")).select("id", "row.label", "row.vec")
    known = stored(known, "lemp-anchors")
    counted = index.select(F.count("*")).first()[0], known.select(F.count("*")).first()[0]
    groups, blocks = (max(1, -(-n // each)) for n, each in zip(counted, (GROUP_BUCKETS, BLOCK_ANCHORS)))
    low, high = F.lit(NONE + 1), F.lit(-(NONE + 1))
    near = meet(index, known.withColumn("low", F.array(low)).withColumn("high", F.array(high)), blocks, groups, 1, positives, True)
    best = Window.partitionBy("anchor_id").orderBy(F.col("score").desc(), "id")
    near = near.withColumn("place", F.row_number().over(best)).where(F.col("place") <= positives)
    near = stored(near.select("anchor_id", (F.col("place") - 1).alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "lemp-positives")
    # A place without a positive, or with a negative score, has an empty range.
    part, whole = share
    asked = near.where("positive_score >= 0").groupBy("anchor_id").agg(F.map_from_entries(F.collect_list(F.struct("place", "positive_score"))).alias("by_place"))
    at = lambda p: F.element_at("by_place", F.lit(p))
    ranges = asked.select(
        F.col("anchor_id").alias("id"),
        F.array(*(F.coalesce(F.expr(f"(by_place[{p}] * {part} + {whole - 1}) div {whole}"), F.lit(1)) for p in range(positives))).alias("low"),
        F.array(*(F.coalesce(at(p), F.lit(0)).cast("long") for p in range(positives))).alias("high"),
    )
    far = meet(index, known.join(ranges, "id").select("id", "label", "vec", "low", "high"), blocks, groups, positives, negatives, False)
    joined = far.join(near, ["anchor_id", "place"])
    ranked = Window.partitionBy("anchor_id", "place").orderBy(F.col("score").desc(), "id")
    out = joined.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= negatives)
    return out.select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
