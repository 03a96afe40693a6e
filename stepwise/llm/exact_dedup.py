"""Exact duplicates through a cuckoo-filter index over live digests.

Texts are equal when they agree after deleting ASCII white space. Every task keeps an index
of its own: a cuckoo filter of 16-bit fingerprints says that a digest is surely new or may be
there; a hit looks into the bucket of stored content and compares the texts themselves. Each
task folds its rows into one entry per distinct text, so a group of copies of any size
leaves a task as one row; entries then meet by digest bucket and are folded once more.

Defined cases: a null text is empty; empty texts are one group; a null id ranks behind all
others and a group of null ids has a null ``keep_id``; rows that repeat an id and a text count
in ``group_size`` one by one and are kept or dropped together; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepwise.llm.common import slices, text_rows
from stepwise.session import shared_dir

SPACES = b" \t\n\x0b\x0c\r"
BUCKETS = 1 << 16
#: Stored content after which a task hands its entries on and starts a new index.
FLUSH_BYTES = 48 << 20


class CuckooFilter:
    """Fingerprints of digests in buckets of four; supports deletion. ``add`` is false on overflow."""

    SLOTS, KICKS = 4, 200

    def __init__(self, buckets: int = 256):
        self.mask = buckets - 1
        self.table = np.zeros((buckets, self.SLOTS), np.uint16).tolist()
        self.turn = 0

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        mark = int.from_bytes(digest[8:10], "little") or 1
        first = int.from_bytes(digest[:8], "little") & self.mask
        return mark, first, self._other(first, mark)

    def _other(self, place: int, mark: int) -> int:
        return (place ^ mark * 0x5BD1E995) & self.mask

    def may_have(self, digest: bytes) -> bool:
        mark, a, b = self._places(digest)
        return mark in self.table[a] or mark in self.table[b]

    def add(self, digest: bytes) -> bool:
        mark, a, b = self._places(digest)
        for place in (a, b):
            row = self.table[place]
            if 0 in row:
                row[row.index(0)] = mark
                return True
        trail = []
        place = a
        for _ in range(self.KICKS):
            self.turn = slot = (self.turn + 1) % self.SLOTS
            row = self.table[place]
            trail.append((row, slot, row[slot]))
            row[slot], mark = mark, row[slot]
            place = self._other(place, mark)
            row = self.table[place]
            if 0 in row:
                row[row.index(0)] = mark
                return True
        for row, slot, old in reversed(trail):  # leave the table as it was
            row[slot] = old
        return False

    def remove(self, digest: bytes) -> bool:
        mark, a, b = self._places(digest)
        for place in (a, b):
            row = self.table[place]
            if mark in row:
                row[row.index(mark)] = 0
                return True
        return False


class CuckooIndex:
    """Live digests with their content. Entries are ``[digest, check, content, rows, best_length, best_id]``."""

    def __init__(self, buckets: int = 256):
        self.filter = CuckooFilter(buckets)
        self.content: dict[int, list[list]] = {}
        self.size = self.bytes = 0

    @staticmethod
    def _bucket(digest: bytes) -> int:
        return int.from_bytes(digest[10:14], "little")

    def find(self, digest: bytes, content: bytes) -> list | None:
        """The entry of an equal text. A filter hit alone proves nothing: content decides."""
        if not self.filter.may_have(digest):
            return None
        for entry in self.content.get(self._bucket(digest), ()):
            if entry[0] == digest and same_content(entry[2], content):
                return entry
        return None

    def insert(self, digest: bytes, check: int, content: bytes, rows: int, length: int, ident: int | None) -> None:
        entry = self.find(digest, content)
        if entry is not None:
            entry[3] += rows
            if _rank(length, ident) < _rank(entry[4], entry[5]):
                entry[4:] = [length, ident]
            return
        self.content.setdefault(self._bucket(digest), []).append([digest, check, content, rows, length, ident])
        self.size += 1
        self.bytes += len(content)
        if not self.filter.add(digest):
            self._resize()

    def delete(self, digest: bytes, content: bytes, rows: int = 1) -> bool:
        """Take rows off a live text; its fingerprint goes with the last one."""
        entry = self.find(digest, content)
        if entry is None:
            return False
        entry[3] -= rows
        if entry[3] <= 0:
            bucket = self.content[self._bucket(digest)]
            bucket.remove(entry)
            self.filter.remove(digest)
            self.size -= 1
            self.bytes -= len(entry[2])
        return True

    def _resize(self) -> None:
        """Twice the buckets, filled anew from the stored keys."""
        buckets = 2 * (self.filter.mask + 1)
        while True:
            self.filter = CuckooFilter(buckets)
            if all(self.filter.add(entry[0]) for entry in self):
                return
            # More than eight live texts with one digest overflow any table; a bucket count grows for other reasons.
            if buckets > 64 * (self.size + 256):
                raise ValueError("too many live texts share one digest")
            buckets *= 2

    def __iter__(self) -> Iterator[list]:
        for bucket in self.content.values():
            yield from bucket


def _rank(length: int, ident: int | None) -> tuple:
    return -length, ident is None, ident or 0


def same_content(a: bytes, b: bytes) -> bool:
    """Whether two packed texts are equal."""
    if a == b:
        return True
    unpack = zstandard.ZstdDecompressor().decompress
    return unpack(a) == unpack(b)


ENTRY = "bucket int, digest binary, check_hash long, content binary, n_rows long, best_length long, best_id long"
_ENTRY_NAMES = ENTRY.replace(",", "").split()[::2]


def _entry_batch(index: CuckooIndex) -> pa.RecordBatch:
    rows = list(index)
    cols = list(zip(*rows)) if rows else [()] * 6
    bucket = [int.from_bytes(d[14:18], "little") % BUCKETS for d in cols[0]]
    kinds = [pa.int32(), pa.binary(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip([bucket, *cols], kinds)], _ENTRY_NAMES)


def digests(docs: DataFrame, key: str, text: str, digest=None) -> DataFrame:
    """Rows of two kinds from one pass: a member per document, an entry per distinct text of a task."""
    digest = digest or (lambda norm: hashlib.sha256(norm).digest())
    names = ["kind", "doc_id", "length", *_ENTRY_NAMES]
    schema = f"kind string, doc_id long, length long, {ENTRY}"

    def entries(index: CuckooIndex) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches([_entry_batch(index)])
        blank = pa.nulls(table.num_rows, pa.int64())
        full = pa.table([pa.array(["entry"] * table.num_rows), blank, blank, *table.columns], names)
        for batch in full.to_batches():
            yield from slices([batch], "content")

    def run(batches):
        index, pack = CuckooIndex(), zstandard.ZstdCompressor(level=1).compress
        for part in slices(batches, "text"):
            ids, lengths, hashes, checks = [], [], [], []
            for ident, value in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                norm = value.encode().translate(None, SPACES)
                found, check = digest(norm), xxhash.xxh64_intdigest(norm) - (1 << 63)
                index.insert(found, check, pack(norm), 1, len(value), ident)
                ids.append(ident)
                lengths.append(len(value))
                hashes.append(found)
                checks.append(check)
                if index.bytes > FLUSH_BYTES:
                    yield from entries(index)
                    index = CuckooIndex()
            n = len(ids)
            none = [pa.nulls(n, t) for t in (pa.int32(), pa.binary(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())]
            none[1], none[2] = pa.array(hashes, pa.binary()), pa.array(checks, pa.int64())
            columns = [pa.array(["member"] * n), pa.array(ids, pa.int64()), pa.array(lengths, pa.int64()), *none]
            yield pa.RecordBatch.from_arrays(columns, names)
        yield from entries(index)

    return text_rows(docs, key, text).mapInArrow(run, schema)


def _merge(batches):
    index = CuckooIndex()
    for part in slices(batches, "content"):
        rows = part.to_pydict()
        for row in zip(*(rows[n] for n in _ENTRY_NAMES[1:])):
            index.insert(*row)
    whole = _entry_batch(index)
    for start in range(0, max(whole.num_rows, 1), 2000):
        yield from slices([whole.slice(start, 2000)], "content")


def build_index(entries: DataFrame, partitions: int) -> DataFrame:
    """Fold the entries of all tasks; one row per distinct live text, in the columns of ``ENTRY``."""
    return entries.select(*_ENTRY_NAMES).repartition(partitions, "bucket").mapInArrow(_merge, ENTRY)


def update_index(index: DataFrame, changes: DataFrame, partitions: int) -> DataFrame:
    """Apply insertions (``n_rows`` > 0) and deletions (``n_rows`` < 0) to a stored index.

    ``changes`` has the columns of ``ENTRY``. Insertions come before deletions, so that the
    order of rows does not matter; deleting what is not there changes nothing. A change says
    how many rows go, not which, so the best row of a text stays recorded until its last row
    goes; ``delete_documents`` knows the rows and ranks those that are left.
    """

    def run(batches):
        live, gone = CuckooIndex(), []
        for part in slices(batches, "content"):
            rows = part.to_pydict()
            for row in zip(*(rows[n] for n in _ENTRY_NAMES[1:])):
                if row[3] > 0:
                    live.insert(*row)
                else:
                    gone.append((row[0], row[2], -row[3]))
        for found, content, rows in gone:
            live.delete(found, content, rows)
        yield from slices([_entry_batch(live)], "content")

    both = index.select(*_ENTRY_NAMES).unionByName(changes.select(*_ENTRY_NAMES))
    return both.repartition(partitions, "bucket").mapInArrow(run, ENTRY)


def delete_documents(
    index: DataFrame, members: DataFrame, gone: DataFrame, partitions: int, key: str = "doc_id"
) -> tuple[DataFrame, DataFrame]:
    """Take documents out of a stored index: ``(index, members)`` without them.

    ``members`` has the columns doc_id, length, digest and check_hash, a row per live document;
    ``gone`` has the ids to delete. Of a text that loses rows the best one is found anew among the
    members left, as a minimum with partial aggregation, so a group of any size is fine. All rows
    of an id go; ids that are not there, repeated or null change nothing; texts without rows leave
    the index, their fingerprints with them.
    """
    text = ["digest", "check_hash"]
    ids = gone.select(F.col(key).alias("doc_id")).distinct()
    left = members.join(ids, "doc_id", "left_anti").select("doc_id", "length", *text)
    lost = members.join(ids, "doc_id", "left_semi").groupBy(*text).agg((-F.count(F.lit(1))).alias("__lost"))
    changes = index.join(lost, text).drop("n_rows").withColumnRenamed("__lost", "n_rows")
    rest = update_index(index, changes, partitions)
    rank = F.struct((-F.col("length")).alias("l"), F.col("doc_id").isNull().alias("u"), F.col("doc_id").alias("i"))
    ranked = left.join(lost, text, "left_semi").groupBy(*text).agg(F.min(rank).alias("__best"))
    live = rest.join(ranked, text, "left").select(
        *[c for c in _ENTRY_NAMES if not c.startswith("best_")],
        F.when(F.col("__best").isNull(), F.col("best_length")).otherwise(-F.col("__best.l")).alias("best_length"),
        F.when(F.col("__best").isNull(), F.col("best_id")).otherwise(F.col("__best.i")).alias("best_id"),
    )
    return live, left


def exact_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", digest=None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the most code points, then the smallest id stays.
    """
    spark = docs.sparkSession
    folder = shared_dir(spark, "digests")
    partitions = docs.rdd.getNumPartitions()
    digests(docs, key, text, digest).write.partitionBy("kind").option("compression", "zstd").parquet(folder)
    stored = spark.read.schema(f"kind string, doc_id long, length long, {ENTRY}").parquet(folder)
    groups = build_index(stored.where("kind = 'entry'"), partitions).select(
        "digest", "check_hash", "n_rows", "best_length", "best_id"
    )
    members = stored.where("kind = 'member'").select("doc_id", "length", "digest", "check_hash")
    return members.join(groups, ["digest", "check_hash"]).select(
        "doc_id",
        F.col("best_id").alias("keep_id"),
        F.col("n_rows").alias("group_size"),
        (F.col("doc_id").eqNullSafe(F.col("best_id")) & (F.col("length") == F.col("best_length"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
