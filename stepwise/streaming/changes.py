"""Keyed change application and incremental refresh on plain parquet."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stepwise.operators.bygroup import keep_last
from stepwise.operators.ordering import as_list
from stepwise.session import stored

#: Folder column of a change log: the micro-batch that brought the row.
LOG_BATCH = "__batch"


def apply_changes(
    target: DataFrame | None,
    changes: DataFrame,
    keys: Sequence[str] | str,
    sequence_by: Sequence[str] | str,
    delete_when: Column | str | None = None,
    keep_deleted: bool = False,
) -> DataFrame:
    """State after applying changes: per key the row with the highest sequence.

    ``sequence_by`` ends in a tie-breaker. A late change with an older sequence loses, so
    applying the same changes again, or in another order, gives the same state. Keys whose
    last change meets ``delete_when`` disappear. A state that later changes are applied to
    must remember deletions: write it with ``keep_deleted`` and read it through ``live_rows``,
    or a late change older than a deletion brings its row back.
    """
    keys = as_list(keys)
    rows = changes if target is None else target.unionByName(changes, allowMissingColumns=True)
    latest = keep_last(rows, keys, sequence_by)
    return latest if delete_when is None or keep_deleted else live_rows(latest, delete_when)


def live_rows(state: DataFrame, delete_when: Column | str) -> DataFrame:
    """A state without its deleted rows."""
    gone = F.expr(delete_when) if isinstance(delete_when, str) else delete_when
    return state.filter(~F.coalesce(gone, F.lit(False)))


def log_changes(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write a change stream to its log, one folder per micro-batch, and stop when caught up.

    The log keeps every change; ``upsert.KeyedTable`` is the form that keeps the table itself. A batch that
    is repeated after a failure replaces its own folder, so no change is written twice.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{LOG_BATCH}={number}")

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def last_batch(spark: SparkSession, log_path: str) -> int:
    """The newest batch of a log."""
    return spark.read.parquet(log_path).agg(F.max(LOG_BATCH)).first()[0]


def current_state(
    spark: SparkSession,
    log_path: str,
    keys: Sequence[str] | str,
    sequence_by: Sequence[str] | str,
    delete_when: Column | str | None = None,
    snapshot_path: str | None = None,
    after: int | None = None,
) -> DataFrame:
    """The table behind a change log, on top of a snapshot if one was written.

    ``after`` is the last batch that the snapshot holds; only folders of later ones are read.
    """
    base = spark.read.parquet(snapshot_path) if snapshot_path else None
    log = spark.read.parquet(log_path)
    if LOG_BATCH in log.columns:
        log = (log if after is None else log.where(F.col(LOG_BATCH) > after)).drop(LOG_BATCH)
    return apply_changes(base, log, keys, sequence_by, delete_when)


def write_snapshot(state: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Keep the state in a new folder; readers move to it once it is complete.

    ``state`` comes from ``apply_changes(..., keep_deleted=True)`` where rows can be deleted.
    """
    state.repartition(*keys).write.mode("errorifexists").parquet(path)


def refresh_partitions(
    compute: Callable[[DataFrame], DataFrame], source: DataFrame, path: str, date_col: str, since: str
) -> None:
    """Recompute the dates from ``since`` on and replace only their partition folders.

    A date that had a partition and has no result any more loses it. The result is derived from
    the source, never from itself, so a broken run is repaired by running it again.
    """
    spark = source.sparkSession
    start = F.lit(since).cast("date")
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def days() -> set[str]:
        """Partition dates in the folder; one entry per date."""
        if not files.exists(root):
            return set()
        names = [s.getPath().getName() for s in files.listStatus(root)]
        return {n.partition("=")[2] for n in names if n.startswith(f"{date_col}=")}

    fresh = compute(source.filter(F.col(date_col) >= start))
    written = stored(fresh, "refresh")
    (
        written.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(date_col)
        .parquet(path)
    )
    have = {str(r[0]) for r in written.select(F.col(date_col).cast("string")).distinct().collect()}
    for day in days():
        if day >= since and day not in have and day[:1].isdigit():
            files.delete(hadoop.Path(f"{path}/{date_col}={day}"), True)
