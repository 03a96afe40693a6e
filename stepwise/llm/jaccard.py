"""N-gram Jaccard self-join with multi-match prefixes, as components of linked documents.

A text is the set of its five-word shingles. Shingles are ordered rare first by a counting
sketch over all texts. Two sets whose Jaccard similarity is 0.8 or more share at least ``l`` of
the first ``n - ceil(0.8 n) + l`` shingles of either, for every ``l``; each document picks the
``l`` whose longer prefix costs less than the candidates it saves, and a pair must share as many
prefix shingles as the smaller ``l`` of the two asks for.

Pairs within a group are never written out. Equal sets are one class. First every class is
compared with one hub, the member of its posting lists that comes earliest; what links is one
component. Then, in every posting list, classes outside its largest component are compared
with the rest, components apart, sizes, positions and parities of their hashes allowing. That is exact: a pair that is
not compared is in one component already, or cannot reach the threshold.

Sets are built of 64-bit hashes and compared by their upper 48 bits. Defined cases: null texts and texts without words have an
empty set and no links; fewer than five words are one shingle; rows that repeat an id are one
document with several texts; a null id has no links and a null component; other columns are
ignored.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stepwise.llm.common import slices, text_rows
from stepwise.llm.graph import components
from stepwise.session import shared_dir, stored

WORDS = 5
#: Similarity as a fraction.
NUM, DEN = 4, 5
MOST_LEVEL = 4
#: Work of verifying a candidate, in posting rows read.
VERIFY_COST = 20.0
#: Counters of the sketch: a power of two by the number of documents, within these bounds.
SKETCH_BITS = (20, 26)
SKETCH_BLOCKS = 64

_A = np.uint64(0x9E3779B97F4A7C15)
_B = np.uint64(0xBF58476D1CE4E5B9)


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    numbers: dict[bytes, int] = {}
    rows = []
    for text in texts:
        found = text.encode().lower().split()
        rows.append(np.fromiter((numbers.setdefault(w, len(numbers)) for w in found), np.int64, len(found)))
    values = np.fromiter(map(xxhash.xxh64_intdigest, numbers), np.uint64, len(numbers))
    out = []
    with np.errstate(over="ignore"):
        for row in rows:
            n = min(len(row), WORDS)
            if not n:
                out.append(np.zeros(0, np.uint64))
                continue
            hashed = values[row]
            count = len(row) - n + 1
            total = np.full(count, n, np.uint64)
            for i in range(n):
                total = (total ^ (total >> np.uint64(31))) * _A + hashed[i : i + count]
            total = (total ^ (total >> np.uint64(29))) * _B
            out.append(np.unique(total ^ (total >> np.uint64(32))))
    return out


def needed(n):
    """Smallest overlap of a set of ``n`` with any partner."""
    return -(-NUM * n // DEN)


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets reach the similarity."""
    both = np.concatenate([a, b])
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return common * DEN >= NUM * (len(both) - common) and common > 0


def _digest(shingles: np.ndarray) -> tuple[int, int]:
    value = xxhash.xxh3_128_intdigest(shingles.tobytes())
    return (value >> 64) - (1 << 63), (value & ((1 << 64) - 1)) - (1 << 63)


def parities(shingles: np.ndarray) -> tuple[int, ...]:
    """For each of 256 bits whether an odd number of shingles falls on it, as four numbers.

    Two sets differ in at least as many shingles as these bits differ.
    """
    odd = np.bincount((shingles >> np.uint64(16) & np.uint64(255)).astype(np.int64), minlength=256) & 1
    return tuple(np.packbits(odd.astype(np.uint8)).view(np.int64).tolist())


_FIRST = "kind string, doc_id long, n int, h1 long, h2 long, b1 long, b2 long, b3 long, b4 long, block int, data binary"
_FIRST_NAMES = _FIRST.replace(",", "").split()[::2]
_FIRST_KINDS = [pa.string(), pa.int64(), pa.int32(), *[pa.int64()] * 6, pa.int32(), pa.binary()]
_BITS = ["b1", "b2", "b3", "b4"]


def _sized(kind: str, rows: int, **given) -> pa.RecordBatch:
    """A batch with one kind of rows; columns that are not given are null."""
    kinds = dict(zip(_FIRST_NAMES, _FIRST_KINDS))
    cols = [pa.array([kind] * rows), *(pa.array(given[n], kinds[n]) if n in given else pa.nulls(rows, kinds[n]) for n in _FIRST_NAMES[1:])]
    return pa.RecordBatch.from_arrays(cols, _FIRST_NAMES)


def _members_and_counters(width: int):
    """Per text its set size and digest; per task the counters of its distinct sets, compressed and in blocks."""

    def run(batches):
        counters, seen = np.zeros(width, np.uint32), set()
        for part in slices(batches, "text"):
            fresh, members = [], []
            for ident, shingles in zip(part.column("doc_id").to_pylist(), shingle_sets(part.column("text").to_pylist())):
                key = _digest(shingles)
                members.append((ident, len(shingles), *key, *parities(shingles)))
                if len(shingles) and key not in seen:
                    seen.add(key)
                    fresh.append(shingles)
            if fresh:
                counters += np.bincount((np.concatenate(fresh) & np.uint64(width - 1)).astype(np.int64), minlength=width).astype(np.uint32)
            yield _sized("member", len(members), **dict(zip(("doc_id", "n", "h1", "h2", *_BITS), zip(*members))))
        squeeze = zstandard.ZstdCompressor(level=1).compress
        blocks = range(SKETCH_BLOCKS)
        step = width // SKETCH_BLOCKS
        yield _sized("counter", len(blocks), block=blocks, data=[squeeze(counters[b * step : (b + 1) * step].tobytes()) for b in blocks])

    return run


def add_counters(blocks: DataFrame, width: int) -> np.ndarray:
    """Logarithms (in quarters) of the counts of all tasks: ``width`` bytes, whatever the corpus size."""
    step = width // SKETCH_BLOCKS

    def total(batches):
        sums: dict[int, np.ndarray] = {}
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for block, data in zip(batch.column("block").to_pylist(), batch.column("data").to_pylist()):
                own = np.frombuffer(unpack(data), np.uint32)
                sums[block] = sums[block] + own if block in sums else own.astype(np.uint64)
        for block, counters in sums.items():
            logs = (np.log2(counters + 1.0) * 4).astype(np.uint8).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([logs], pa.binary())], ["block", "data"])

    out = np.zeros(width, np.uint8)
    for row in blocks.repartition(SKETCH_BLOCKS, "block").mapInArrow(total, "block int, data binary").collect():
        out[row["block"] * step : (row["block"] + 1) * step] = np.frombuffer(row["data"], np.uint8)
    return out


def choose_level(costs: np.ndarray, n: int) -> int:
    """The level with the least estimated work; ``costs`` are frequencies in prefix order.

    Level l reads the lists of its prefix; at most a l-th of what they hold shares l shingles.
    """
    first = n - needed(n) + 1
    levels = np.arange(1, max(1, min(MOST_LEVEL, needed(n))) + 1)
    read = np.cumsum(costs)[np.minimum(first + levels - 2, n - 1)]
    return int(levels[(read + VERIFY_COST * read / levels).argmin()])


def _postings(frequency: np.ndarray):
    """The prefix of every distinct set of a task: token, doc_id, and size, place and level in one number."""
    mask = np.uint64(len(frequency) - 1)
    counts = np.exp2(np.arange(256) / 4)

    def run(batches):
        seen = set()
        for part in slices(batches, "text"):
            ids, info, tokens = [], [], []
            for ident, shingles in zip(part.column("doc_id").to_pylist(), shingle_sets(part.column("text").to_pylist())):
                n = len(shingles)
                key = _digest(shingles)
                if ident is None or not n or key in seen:
                    continue
                seen.add(key)
                rare = frequency[(shingles & mask).astype(np.int64)]
                reach = min(n, n - needed(n) + MOST_LEVEL)
                order = np.lexsort((shingles, rare))[:reach]
                level = choose_level(counts[rare[order]], n)
                take = min(n, n - needed(n) + level)
                tokens.append(shingles[order[:take]].view(np.int64))
                info.append((np.int64(n) << 34) + (np.arange(take) << 4) + level)
                ids.append(np.full(take, ident, np.int64))
            if tokens:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (tokens, ids, info)], ["token", "doc_id", "info"])

    return run


def verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (x, y) whose sets are similar; ``sets`` is bucketed by doc_id.

    x may be the hub of many pairs: it is joined first, when a pair is two numbers, against the sets
    of such x alone and so that a hot one can be split. Pairs then carry that set to y.
    """

    def run(batches):
        for whole in batches:
            for part in slices([whole], "xs"):
                a, b = part.column("xs").to_pylist(), part.column("ys").to_pylist()
                mask = pa.array([similar(unpacked(i), unpacked(j)) for i, j in zip(a, b)], pa.bool_())
                yield pa.RecordBatch.from_arrays([part.column(c).filter(mask) for c in ("x", "y")], ["x", "y"])

    left = sets.join(pairs.select(F.col("x").alias("doc_id")).distinct(), "doc_id", "left_semi")
    left = left.select(F.col("doc_id").alias("x"), F.col("shingles").alias("xs"))
    right = sets.select(F.col("doc_id").alias("y"), F.col("shingles").alias("ys"))
    return pairs.join(left, "x").join(right, "y").mapInArrow(run, "x long, y long")


#: Bytes of a shingle hash in stored sets.
KEPT = 6


def packed(shingles: np.ndarray) -> bytes:
    """The upper bytes of sorted hashes."""
    return shingles.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :KEPT].tobytes()


def unpacked(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // KEPT, 8), np.uint8)
    out[:, :KEPT] = np.frombuffer(data, np.uint8).reshape(-1, KEPT)
    return out.view(">u8").ravel().astype(np.uint64)


def _sets(rows: DataFrame, wanted: DataFrame) -> tuple[DataFrame, str]:
    """Sets of the wanted documents, as a table bucketed by doc_id, and its name. Texts are shuffled compressed."""

    def squeeze(batches):
        pack = zstandard.ZstdCompressor(level=3).compress
        for part in slices(batches, "text"):
            data = [pack(t.encode()) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(data, pa.binary())], ["doc_id", "data"])

    def run(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for part in slices(batches, "data", 4 << 20):
            data = [packed(s) for s in shingle_sets([unpack(d).decode() for d in part.column("data").to_pylist()])]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(data, pa.binary())], ["doc_id", "shingles"])

    spark = rows.sparkSession
    texts = rows.where("doc_id IS NOT NULL").mapInArrow(squeeze, "doc_id long, data binary")
    sets = texts.join(wanted, "doc_id", "left_semi").mapInArrow(run, "doc_id long, shingles binary")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"stepwise_sets_{uuid.uuid4().hex}"
    sets.write.bucketBy(buckets, "doc_id").option("path", shared_dir(spark, "sets")).saveAsTable(name)
    return spark.read.table(name), name


def _reach(a: str, b: str):
    """Whether sizes and positions of a shared shingle let a pair reach the threshold.

    One of the first ``least`` shared shingles leaves no more than ``least`` plus what follows it
    in the shorter rest; the overlap must be NUM / (NUM + DEN) of both sizes.
    """
    return (
        f"{DEN} * {a}.n >= {NUM} * {b}.n AND {DEN} * {b}.n >= {NUM} * {a}.n AND "
        f"{NUM} * ({a}.n + {b}.n) <= {NUM + DEN} * (least({a}.level, {b}.level) + least({a}.n - {a}.place, {b}.n - {b}.place) - 1)"
    )


def _depth(t: str) -> str:
    """The level at which a place enters the prefix."""
    return f"greatest(1, {t}.place - ({t}.n - CAST(ceil({NUM} * {t}.n / {DEN}) AS INT)) + 1)"


def _alike(a: str, b: str) -> str:
    """Whether the bits let a pair reach the threshold: sets that do differ in (DEN - NUM) / (DEN + NUM) of both sizes at most."""
    differ = " + ".join(f"bit_count({a}.{c} ^ {b}.{c})" for c in _BITS)
    return f"{DEN + NUM} * ({differ}) <= {DEN - NUM} * ({a}.n + {b}.n)"


def near_groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest id that links reach)."""
    spark = docs.sparkSession
    rows = text_rows(docs, key, text)
    width = 1 << int(np.clip(np.ceil(np.log2(max(docs.count(), 1))) + 4, *SKETCH_BITS))
    folder = shared_dir(spark, "shingles")
    rows.mapInArrow(_members_and_counters(width), _FIRST).write.partitionBy("kind").option("compression", "zstd").parquet(folder)
    both = spark.read.schema(_FIRST).parquet(folder)
    members = both.where("kind = 'member'").select("doc_id", "n", "h1", "h2", *_BITS)
    frequency = add_counters(both.where("kind = 'counter'").select("block", "data"), width)

    # Equal sets: every document and the smallest id that has its set.
    first = members.where("n > 0").groupBy("h1", "h2").agg(F.min("doc_id").alias("rep"))
    classes = stored(members.join(first, ["h1", "h2"], "left").select("doc_id", "n", "rep", *_BITS), "classes")

    # Lists with one entry lead nowhere.
    postings = rows.mapInArrow(_postings(frequency), "token long, doc_id long, info long")
    lists = postings.withColumn("df", F.count("*").over(Window.partitionBy("token"))).where("df > 1")
    lists = lists.selectExpr("token", "doc_id", "CAST(info >> 34 AS INT) n", "CAST((info >> 4) & 1073741823 AS INT) place", "CAST(info & 15 AS INT) level")
    lists = stored(lists, "lists")
    reps = classes.where("doc_id IS NOT NULL AND rep IS NOT NULL").select("doc_id", "n", "rep").distinct()
    posts = stored(
        lists.join(reps, ["doc_id", "n"]).select("token", F.col("rep").alias("doc_id"), "n", "place", "level").distinct(), "posts"
    )
    # Nor do documents with fewer shared shingles than a partner can ask for.
    asked = posts.withColumn("asked", F.min("level").over(Window.partitionBy("token")))
    asked = asked.withColumn("others", F.count("*").over(Window.partitionBy("token"))).where("others > 1")
    able = asked.groupBy("doc_id").agg(F.min("asked").alias("asked"), F.count("*").alias("shared")).where("shared >= asked")
    posts = stored(posts.join(able.select("doc_id"), "doc_id", "left_semi"), "able-posts")
    sets, sets_table = _sets(rows, posts.select("doc_id").distinct())

    # A hub for every class: of the earliest entries of its lists the one met most often.
    early = Window.partitionBy("token").orderBy("place", "doc_id")
    hubs = posts.withColumn("hub", F.first(F.struct("doc_id", "n", "place", "level")).over(early))
    met = hubs.where(f"hub.doc_id <> doc_id AND {_reach('hub', 'own')}".replace("own.", "")).groupBy("doc_id", "hub.doc_id").count()
    met = met.toDF("y", "x", "count")
    best = met.groupBy("y").agg(F.max_by("x", F.struct("count", F.negative("x"))).alias("x")).select("x", "y")
    links = verify(best, sets)
    near = components(links.toDF("u", "v"))

    # Classes of other components in the same lists.
    labelled = posts.join(near, posts["doc_id"] == near["node"], "left").select(posts["*"], F.coalesce("component", "doc_id").alias("comp"))
    labelled = stored(labelled, "labelled")
    by_comp = labelled.groupBy("token", "comp").count()
    major = by_comp.groupBy("token").agg(F.max_by("comp", F.struct("count", "comp")).alias("major"), F.count("*").alias("comps"))
    open_lists = major.where("comps > 1").select("token", "major")
    # A document with several sets of one size has no bits.
    alone = " AND ".join(f"min({c}) = max({c})" for c in _BITS)
    bits = classes.where("rep IS NOT NULL").groupBy(F.col("rep").alias("doc_id"), "n")
    bits = bits.agg(*(F.expr(f"CASE WHEN {alone} THEN min({c}) END").alias(c) for c in _BITS))
    rest = stored(labelled.join(open_lists, "token").join(bits, ["doc_id", "n"], "left"), "open-lists")
    minor = rest.where("comp <> major")
    apart = (
        f"a.token = b.token AND a.comp <> b.comp AND (b.comp = b.major OR a.doc_id < b.doc_id) AND {_reach('a', 'b')} "
        f"AND greatest({_depth('a')}, {_depth('b')}) <= least(a.level, b.level) AND coalesce({_alike('a', 'b')}, true)"
    )
    shared = minor.alias("a").join(rest.alias("b"), F.expr(apart)).select(
        F.least("a.doc_id", "b.doc_id").alias("x"), F.greatest("a.doc_id", "b.doc_id").alias("y"), F.least("a.level", "b.level").alias("asked")
    )
    candidates = shared.groupBy("x", "y").agg(F.count("*").alias("met"), F.max("asked").alias("asked")).where("met >= asked")
    more = verify(candidates.select("x", "y"), sets)

    # A document with several texts is one node.
    texts = reps.groupBy("doc_id").agg(F.max("rep").alias("u"), F.min("rep").alias("v")).where("u <> v")
    several = reps.join(texts.select("doc_id", "v"), "doc_id").select(F.col("rep").alias("u"), "v")
    final = components(near.toDF("u", "v").unionByName(more.toDF("u", "v")).unionByName(several))
    spark.sql(f"DROP TABLE {sets_table}")  # the name alone; the files lie in the shared folder
    return classes.join(final, classes["rep"] == final["node"], "left").select(
        "doc_id",
        F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep", "doc_id")).alias("component_id"),
    )
