"""Structured Streaming forms of the batch operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stepwise.operators.quality import Rules, keep_ok, write_checked


def stream_files(
    spark: SparkSession,
    path: str,
    fmt: str,
    schema: T.StructType | str,
    max_files: int | None = None,
    glob: str | None = None,
    **options,
) -> DataFrame:
    """Incremental file source. The schema is fixed; progress lives in the query's checkpoint."""
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if fmt == "csv":
        reader = reader.option("header", options.get("header", True))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


def stream_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.readStream.table(name)


def append_files(
    stream: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = (), fmt: str = "parquet"
) -> StreamingQuery:
    """Exactly-once append to files: process what is there, then stop."""
    writer = stream.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.trigger(availableNow=True).start(path)


def bronze_stream(stream: DataFrame, rules: Rules) -> DataFrame:
    """Row expectations with action drop, as a stream transformation."""
    return keep_ok(stream, rules)


def write_checked_stream(
    stream: DataFrame, rules: Rules, path: str, log: str, checkpoint: str, run: str, drop: bool = False
) -> StreamingQuery:
    """Write a stream in a folder per micro-batch and log every batch's rule outcomes, see ``write_checked``.

    A batch that is sent again after a failure replaces its folder and its log entry.
    """

    def batch(rows: DataFrame, batch_id: int) -> None:
        write_checked(rows, rules, f"{path}/batch={batch_id}", log, run, batch_id, drop)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def enrich_stream(stream: DataFrame, dims: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """Left joins of a stream with stored dimension tables, read again for every micro-batch."""
    out = stream
    for dim, key in dims:
        out = out.join(dim, key, "left")
    return out


def weekly_totals(
    stream: DataFrame,
    ts: str,
    aggs: Mapping[str, Column],
    delay: str = "1 day",
    width: str = "1 week",
    offset: str = "4 days",
) -> DataFrame:
    """Tumbling totals with a watermark.

    The default offset makes weeks start on Monday (the epoch was a Thursday). In append
    mode a week is emitted once, when the watermark has passed its end. Windows are aligned
    to UTC, so event times are moved to the session's wall clock and the result back.
    """
    zone = stream.sparkSession.conf.get("spark.sql.session.timeZone")
    timed = stream.withColumn("__local", F.from_utc_timestamp(F.col(ts).cast("timestamp"), zone))
    grouped = timed.withWatermark("__local", delay).groupBy(F.window("__local", width, width, offset))
    out = grouped.agg(*[e.alias(n) for n, e in aggs.items()])
    return out.select(F.to_date(F.to_utc_timestamp("window.start", zone)).alias("week"), *aggs)


def first_per_key(stream: DataFrame, keys: Sequence[str], ts: str, delay: str) -> DataFrame:
    """One row per key; state for a key is dropped ``delay`` after its event time."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def join_streams(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_ts: str,
    right_ts: str,
    within: str,
    delay: str,
    how: str = "left",
) -> DataFrame:
    """Stream-stream join with a time bound on both sides, which keeps the state finite.

    Rows older than the watermark (the smaller of both sides' latest times less ``delay``) are late
    and dropped. With ``how="left"`` an unmatched left row comes out once the watermark has passed
    its time by more than ``within``: no partner can arrive any more.
    """
    l = left.withWatermark(left_ts, delay)
    r = right.withColumnRenamed(key, "__rkey").withWatermark(right_ts, delay)
    bound = (F.col(right_ts) >= F.col(left_ts) - F.expr(f"INTERVAL {within}")) & (
        F.col(right_ts) <= F.col(left_ts) + F.expr(f"INTERVAL {within}")
    )
    return l.join(r, (F.col(key) == F.col("__rkey")) & bound, how).drop("__rkey")
