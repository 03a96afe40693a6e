"""Token ids in binary shards: frequency ranks in byte-aligned variable-length codes, control bytes apart.

The ids of the whole corpus are counted and ranked, most frequent first, so that common ids
take one byte. Four codes share a control byte with two bits each (length less one); control
bytes and code bytes are separate runs, and reading looks both up in tables of 256 rows.

Layout of a folder: ``ranks`` (table: rank, id), ``shards`` (table: shard, path, n_docs,
n_tokens, n_bytes) and the shard files below ``data``. A shard file is ``SVB1`` and blocks:
four unsigned 64-bit numbers (documents, ids, control bytes, code bytes), then per document the
id (int64), a byte that says whether the id is null, the number of ids (int64), then control
bytes and code bytes. Numbers are little-endian. Documents ascend by id through all shards.

Defined cases: a null text is empty and has the end id alone; null document ids come first;
rows that repeat an id stay, ordered by their ids; an empty table gives a folder without
shards; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stepwise.llm.common import WORD_SLICE_BYTES, open_in, open_out, partitions_for, slices, text_rows

MAGIC = b"SVB1"
#: Ids of a block, but for a longer document, and of a shard.
BLOCK_IDS = 1 << 18
SHARD_IDS = 1 << 25

_CODES = np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3
#: Of each control byte: code lengths, offsets of the codes, all bytes.
LENGTHS = (_CODES + 1).astype(np.int64)
OFFSETS = np.cumsum(LENGTHS, axis=1) - LENGTHS
TOTALS = LENGTHS.sum(axis=1)
MASKS = np.array([0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and code bytes of unsigned 32-bit numbers."""
    n = len(values)
    padded = np.zeros(-(-n // 4) * 4, np.uint32)
    padded[:n] = values
    code = (padded > 0xFF).astype(np.uint8) + (padded > 0xFFFF) + (padded > 0xFFFFFF)
    control = (code.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1).astype(np.uint8)
    keep = np.arange(4) <= code[:, None]
    return control.tobytes(), padded.astype("<u4").view(np.uint8).reshape(-1, 4)[keep].tobytes()


def unpack(control: bytes, codes: bytes, n: int) -> np.ndarray:
    """The ``n`` numbers that :func:`pack` took."""
    groups = np.frombuffer(control, np.uint8)
    data = np.frombuffer(codes + bytes(3), np.uint8)
    ends = np.cumsum(TOTALS[groups])
    at = ((ends - TOTALS[groups])[:, None] + OFFSETS[groups]).ravel()
    value = data[at].astype(np.uint32)
    for i in (1, 2, 3):
        value |= data[at + i].astype(np.uint32) << np.uint32(8 * i)
    return (value & MASKS[_CODES[groups].ravel()])[:n]


def tokenize(docs: DataFrame, tokenizer: str, end: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of two kinds from one pass: ``ids`` per document (raw little-endian), ``counts`` per task."""
    schema = "kind string, doc_id long, n_tokens long, ids binary, counts binary"
    names = ["kind", "doc_id", "n_tokens", "ids", "counts"]

    def run(batches):
        from stepwise.llm.words import encoder, with_end

        library = encoder(tokenizer)
        width = np.uint16 if max(library.vocabulary, end + 1) <= 1 << 16 else np.uint32
        seen = np.zeros(max(library.vocabulary, end + 1), np.int64)
        for part in slices(batches, "text", WORD_SLICE_BYTES):
            ids, counts = with_end(*library.encode(part.column("text")), end)
            seen += np.bincount(ids, minlength=len(seen))
            raw = ids.astype(width).tobytes()
            stops = np.concatenate([[0], np.cumsum(counts)]) * width().itemsize
            blobs = [raw[a:b] for a, b in zip(stops[:-1].tolist(), stops[1:].tolist())]
            n = part.num_rows
            cols = [pa.array(["ids"] * n), part.column("doc_id"), pa.array(counts), pa.array(blobs, pa.binary()), pa.nulls(n, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, names)
        used = np.flatnonzero(seen)
        one = [["counts"], [None], [int(seen.sum())], [used.astype("<u4").tobytes()], [seen[used].astype("<i8").tobytes()]]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(one, kinds)], names)

    return text_rows(docs, key, text).mapInArrow(run, schema)


def _spread_counts(batches):
    for batch in batches:
        for ids, counts in zip(batch.column("ids").to_pylist(), batch.column("counts").to_pylist()):
            pair = [pa.array(np.frombuffer(ids, "<u4").astype(np.int64)), pa.array(np.frombuffer(counts, "<i8"))]
            yield pa.RecordBatch.from_arrays(pair, ["id", "n"])


def write_tokens(
    docs: DataFrame, folder: str, tokenizer: str, end: int, shard_ids: int = SHARD_IDS, key: str = "doc_id", text: str = "text"
) -> None:
    """Encode all texts and write the folder. ``folder`` lies in the shared storage.

    Texts are encoded once; the ids wait in a table next to the result. Only the counts of the
    vocabulary reach the driver, whose number the vocabulary bounds.
    """
    spark = docs.sparkSession
    tokenize(docs, tokenizer, end, key, text).write.partitionBy("kind").option("compression", "zstd").parquet(f"{folder}/encoded")
    schema = "kind string, doc_id long, n_tokens long, ids binary, counts binary"
    encoded = spark.read.schema(schema).parquet(f"{folder}/encoded")
    counts = encoded.where("kind = 'counts'").select("ids", "counts").mapInArrow(_spread_counts, "id long, n long")
    ranked = counts.groupBy("id").agg(F.sum("n").alias("n")).toPandas().sort_values(["n", "id"], ascending=[False, True])
    order = ranked["id"].to_numpy(np.int64)
    spark.createDataFrame([(int(r), int(i)) for r, i in enumerate(order)], "rank long, id long").write.parquet(f"{folder}/ranks")
    rank = np.zeros(int(order.max()) + 1 if len(order) else 1, np.uint32)
    rank[order] = np.arange(len(order))
    wide = len(rank) > 1 << 16
    shards = partitions_for(docs, int(ranked["n"].sum()), shard_ids)
    rows = encoded.where("kind = 'ids'").select("doc_id", "ids")
    dealt = rows.repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id", "ids")

    def write(batches):
        from pyspark import TaskContext

        out = None
        docs_all = ids_all = bytes_all = 0
        for block in _blocks(batches, np.uint32 if wide else np.uint16):
            if out is None:
                out, path = open_out(f"{folder}/data", "shard")
                bytes_all += out.write(MAGIC)
            doc_ids, nulls, lengths, ids = block
            control, codes = pack(rank[ids])
            head = np.array([len(doc_ids), len(ids), len(control), len(codes)], "<u8").tobytes()
            for piece in (head, doc_ids.tobytes(), nulls.tobytes(), lengths.tobytes(), control, codes):
                bytes_all += out.write(piece)
            docs_all, ids_all = docs_all + len(doc_ids), ids_all + len(ids)
        if out is not None:
            out.close()
            number = TaskContext.get().partitionId()
            one = {"shard": [number], "path": [path], "n_docs": [docs_all], "n_tokens": [ids_all], "n_bytes": [bytes_all]}
            yield pa.RecordBatch.from_pydict(one)

    dealt.mapInArrow(write, "shard long, path string, n_docs long, n_tokens long, n_bytes long").write.parquet(f"{folder}/shards")


def _blocks(batches, width) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Whole documents, about ``BLOCK_IDS`` ids together."""
    docs, blobs, size = [], [], 0

    def block():
        ids = np.frombuffer(b"".join(blobs), width)
        lengths = np.array([len(b) for b in blobs], "<i8") // np.dtype(width).itemsize
        return np.array([d or 0 for d in docs], "<i8"), np.array([d is None for d in docs], np.uint8), lengths, ids

    for part in slices(batches, "ids"):
        for doc, blob in zip(part.column("doc_id").to_pylist(), part.column("ids").to_pylist()):
            docs.append(doc)
            blobs.append(blob)
            size += len(blob)
            if size >= BLOCK_IDS * np.dtype(width).itemsize:
                yield block()
                docs, blobs, size = [], [], 0
    if docs:
        yield block()


def read_tokens(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """Documents of a folder from its files: doc_id, start, n_tokens, ids_crc32, and on demand the ids.

    ``start`` counts the ids of all documents before, from the shards' totals.
    """
    order = [r["id"] for r in spark.read.parquet(f"{folder}/ranks").orderBy("rank").collect()]
    ids_of = np.array(order or [0], np.uint32)
    shards = spark.read.schema("shard long, path string, n_docs long, n_tokens long, n_bytes long").parquet(f"{folder}/shards")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = shards.select("shard", "path", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("start"))
    files = max(shards.count(), 1)
    names = ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids

    def read(batches):
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
                with open_in(f"{folder}/data", path) as file:
                    if file.read(4) != MAGIC:
                        raise ValueError(f"{path} is no shard file")
                    while head := file.read(32):
                        n, ids, n_control, n_codes = np.frombuffer(head, "<u8").tolist()
                        doc_ids, nulls = np.frombuffer(file.read(8 * n), "<i8"), np.frombuffer(file.read(n), np.uint8)
                        lengths = np.frombuffer(file.read(8 * n), "<i8")
                        raw = ids_of[unpack(file.read(n_control), file.read(n_codes), ids)].astype("<u4").tobytes()
                        stops = np.cumsum(lengths)
                        cuts = zip((4 * (stops - lengths)).tolist(), (4 * stops).tolist())
                        blobs = [raw[a:b] for a, b in cuts]
                        cols = [
                            pa.array(doc_ids, pa.int64(), mask=nulls.astype(bool)),
                            pa.array(start + stops - lengths),
                            pa.array(lengths),
                            pa.array([zlib.crc32(b) for b in blobs], pa.int64()),
                        ]
                        if with_ids:
                            cols.append(pa.array([np.frombuffer(b, "<u4").astype(np.int64) for b in blobs], pa.list_(pa.int64())))
                        yield pa.RecordBatch.from_arrays(cols, names)
                        start += ids

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    return starts.repartition(files).mapInArrow(read, schema)
