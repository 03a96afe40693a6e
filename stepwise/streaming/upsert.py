"""A keyed table that a change stream updates in place, on plain parquet.

The rows lie in buckets by a hash of their keys, each bucket in a folder of its own. A micro-batch
is reduced to one row per key, and only the buckets it touches are read, merged and written, to new
folders. A commit file then names the current folder of every bucket. Readers take the newest commit,
so that they see a batch whole or not at all, and a batch whose commit exists is not applied
again. The driver sees bucket numbers and folder names, at most one each per bucket; rows stay on the
executors. Deleted keys stay in their bucket as remembered rows, so that a late change
older than the deletion loses.

Defined cases: null keys are a key like any other; of the changes of one key the one with the highest
sequence wins, whatever batch brings it; an empty batch leaves a commit and no folder; columns that
appear later are null in older rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stepwise.operators.ordering import as_list
from stepwise.streaming.changes import apply_changes, live_rows

BUCKET = "__bucket"


@dataclass(frozen=True)
class KeyedTable:
    """``buckets`` is fixed when the table is made: about its final size over what one task may rewrite."""

    path: str
    keys: Sequence[str] | str
    sequence_by: Sequence[str] | str
    delete_when: Column | str | None = None
    buckets: int = 64

    # -- commits -----------------------------------------------------------------------

    def _files(self, spark: SparkSession):
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        root = hadoop.Path(f"{self.path}/commits")
        return hadoop, root, root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def batches(self, spark: SparkSession) -> list[int]:
        """Batch ids that were committed, in order."""
        _, root, files = self._files(spark)
        if not files.exists(root):
            return []
        names = [s.getPath().getName() for s in files.listStatus(root)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def commit(self, spark: SparkSession, batch: int | None = None) -> dict:
        """What a commit says (the newest one unless told): folder of every bucket, and the schema."""
        known = self.batches(spark)
        if not known:
            return {"folders": {}, "schema": None, "buckets": self.buckets}
        name = f"{self.path}/commits/{known[-1] if batch is None else batch}.json"
        said = json.loads("\n".join(r[0] for r in spark.read.text(name, wholetext=True).collect()))
        if said["buckets"] != self.buckets:
            raise ValueError(f"the table has {said['buckets']} buckets, not {self.buckets}")
        return said

    def _write_commit(self, spark: SparkSession, batch: int, said: dict) -> None:
        """The file appears under its name once it is whole."""
        hadoop, root, files = self._files(spark)
        files.mkdirs(root)
        part = hadoop.Path(f"{self.path}/commits/.{batch}-{uuid.uuid4().hex}")
        out = files.create(part)
        out.write(bytearray(json.dumps(said).encode()))
        out.close()
        files.rename(part, hadoop.Path(f"{self.path}/commits/{batch}.json"))

    # -- rows --------------------------------------------------------------------------

    def _state(self, spark: SparkSession, said: dict, buckets: Sequence[int] | None = None) -> DataFrame | None:
        """Rows of some buckets, remembered deletions included."""
        folders = [f for b, f in said["folders"].items() if buckets is None or int(b) in set(buckets)]
        if said["schema"] is None:
            return None
        schema = T.StructType.fromJson(said["schema"])
        if not folders:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(*(f"{self.path}/{f}" for f in folders))

    def read(self, spark: SparkSession, batch: int | None = None) -> DataFrame:
        """The table after the newest batch, or as it was after an earlier one that is still kept."""
        state = self._state(spark, self.commit(spark, batch))
        if state is None:
            raise ValueError(f"no batch was applied to {self.path} yet")
        return state if self.delete_when is None else live_rows(state, self.delete_when)

    def apply(self, changes: DataFrame, batch: int) -> None:
        """Merge a batch of changes. Does nothing when this batch was committed before."""
        spark = changes.sparkSession
        known = self.batches(spark)
        if known and batch <= known[-1]:
            return
        said = self.commit(spark)
        keys = as_list(self.keys)
        latest = apply_changes(None, changes, keys, self.sequence_by)
        folder = f"data/{batch}-{uuid.uuid4().hex}"
        numbered = latest.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(self.buckets)).cast("int"))
        # The reduced batch is kept for the length of the merge: its buckets are asked for, then its rows.
        numbered.write.parquet(f"{self.path}/{folder}/changes")
        reduced = spark.read.schema(numbered.schema).parquet(f"{self.path}/{folder}/changes")
        touched = sorted(r[0] for r in reduced.select(BUCKET).distinct().collect())
        old = self._state(spark, said, touched)
        merged = apply_changes(old, reduced.drop(BUCKET), keys, self.sequence_by)
        schema = merged.schema if old is not None else latest.schema
        if touched:
            placed = merged.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(self.buckets)).cast("int"))
            placed.repartition(BUCKET).write.partitionBy(BUCKET).parquet(f"{self.path}/{folder}/rows")
        folders = said["folders"] | {str(b): f"{folder}/rows/{BUCKET}={b}" for b in touched}
        self._write_commit(spark, batch, {"folders": folders, "schema": schema.jsonValue(), "buckets": self.buckets})
        hadoop, _, files = self._files(spark)
        files.delete(hadoop.Path(f"{self.path}/{folder}/changes"), True)

    def forget(self, spark: SparkSession, keep: int = 2) -> None:
        """Remove commits before the last ``keep``, and folders that no kept commit names."""
        hadoop, _, files = self._files(spark)
        known = self.batches(spark)
        kept = {f.split("/")[1] for b in known[-keep:] for f in self.commit(spark, b)["folders"].values()}
        for batch in known[:-keep]:
            files.delete(hadoop.Path(f"{self.path}/commits/{batch}.json"), False)
        data = hadoop.Path(f"{self.path}/data")
        for status in files.listStatus(data) if files.exists(data) else []:
            name = status.getPath().getName()
            if name not in kept and known and int(name.partition("-")[0]) <= known[-1]:
                files.delete(status.getPath(), True)


def upsert_stream(stream: DataFrame, table: KeyedTable, checkpoint: str) -> StreamingQuery:
    """Apply a change stream to a keyed table, each micro-batch once, and stop when caught up."""
    writer = stream.writeStream.foreachBatch(table.apply).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def first_rows(path: str, keys: Sequence[str] | str, order: Sequence[str], buckets: int = 64) -> KeyedTable:
    """A keyed table that keeps each key's first row by ``order``, however far apart the rows arrive."""
    turned = [k.removesuffix(" desc") if k.endswith(" desc") else f"{k.removesuffix(' asc')} desc" for k in as_list(order)]
    return KeyedTable(path, keys, turned, None, buckets)
