"""Streaming queries. Each reads the events file as a stream, writes to the shared folder
with a checkpoint, and returns what was written."""

from __future__ import annotations

from pyspark.sql import functions as F

from stepwise.queries.base import money, query
from stepwise.session import shared_dir
from stepwise.streaming import changes as ch
from stepwise.streaming import streams as st
from stepwise.streaming import upsert as up
from stepwise.plans.medallion import add_audit
from stepwise.sources import writers as wr


def _stream(t):
    return st.stream_files(t.spark, t.folder, "parquet", t.events.schema, glob="events.parquet")


def _run(t, stream, name, partition_by=()):
    """Run the stream to its end and read the files it wrote."""
    root = shared_dir(t.spark, name)
    st.append_files(stream, f"{root}/data", f"{root}/checkpoint", partition_by).awaitTermination()
    return t.spark.read.schema(stream.schema).parquet(f"{root}/data")


@query("stream_bronze", "SELECT event_id, user_id, event_type, value FROM events WHERE event_type <> 'error' AND value > 5")
def stream_bronze(t):
    good = st.bronze_stream(_stream(t), {"no_error": "event_type <> 'error'", "value": "value > 5"})
    return _run(t, good.select("event_id", "user_id", "event_type", "value"), "bronze")


@query(
    "stream_enrich",
    """
    SELECT event_id, c_mktsegment, n_name, CASE WHEN event_type = 'error' THEN 'high' WHEN value > 200 THEN 'high' WHEN value > 50 THEN 'medium'
      ELSE 'low' END AS severity FROM events LEFT JOIN customer ON user_id = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
    """,
)
def stream_enrich(t):
    customers = t.customer.select(F.col("c_custkey").alias("user_id"), "c_mktsegment", F.col("c_nationkey").alias("n_nationkey"))
    out = st.enrich_stream(_stream(t), [(customers, "user_id"), (t.nation.select("n_nationkey", "n_name"), "n_nationkey")])
    level = F.when(F.col("event_type") == "error", "high").when(F.col("value") > 200, "high").when(F.col("value") > 50, "medium")
    return _run(t, out.select("event_id", "c_mktsegment", "n_name", level.otherwise("low").alias("severity")), "enrich")


@query(
    "stream_gold",
    """
    SELECT CAST(ts AS DATE) AS day, c_mktsegment AS segment, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM events LEFT JOIN customer ON user_id = c_custkey WHERE value > 1 GROUP BY 1, 2
    """,
)
def stream_gold(t):
    """A batch summary over a streamed and enriched table."""
    customers = t.customer.select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("segment"))
    rows = st.enrich_stream(st.bronze_stream(_stream(t), {"positive": "value > 1"}), [(customers, "user_id")])
    silver = _run(t, rows.select("event_id", "ts", "value", "segment"), "silver")
    return silver.groupBy(F.to_date("ts").alias("day"), "segment").agg(
        F.count(F.lit(1)).alias("n"), F.sum(money("value")).cast("double").alias("total")
    )


@query(
    "stream_weekly",
    """
    SELECT CAST(date_trunc('week', ts) AS DATE) AS week, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM events
    GROUP BY 1 HAVING CAST(date_trunc('week', ts) AS DATE) + 7 <= (SELECT max(ts) - INTERVAL 1 DAY FROM events)
    """,
)
def stream_weekly(t):
    """Append mode: a week appears once the watermark, a day behind, has passed its end."""
    timed = _stream(t)
    aggs = {"n": F.count(F.lit(1)), "total": F.sum(money("value")).cast("double")}
    return _run(t, st.weekly_totals(timed, "ts", aggs), "weekly")


@query("stream_first_key", "SELECT DISTINCT user_id, event_type FROM events")
def stream_first_key(t):
    timed = _stream(t).withColumn("ts", F.col("ts").cast("timestamp"))
    return _run(t, st.first_per_key(timed, ["user_id", "event_type"], "ts", "60 days").select("user_id", "event_type"), "first")


_LATE = "event_id % 20 = 0 AND ts < TIMESTAMP '2024-01-12'"
_NEW = "ts >= TIMESTAMP '2024-01-15'"


@query(
    "stream_join_left",
    f"""
    WITH e AS (SELECT * FROM events WHERE NOT ({_LATE})),
      p AS (SELECT event_id, user_id, ts FROM e WHERE event_type = 'purchase'), c AS (SELECT event_id AS click_id, user_id, ts AS click_ts FROM e WHERE event_type = 'click'),
      m AS (SELECT least((SELECT max(ts) FROM p), (SELECT max(click_ts) FROM c)) - INTERVAL '49 hours' AS passed)
    SELECT event_id, p.user_id, click_id FROM p LEFT JOIN c ON p.user_id = c.user_id AND click_ts BETWEEN ts - INTERVAL 1 HOUR AND ts + INTERVAL 1 HOUR
    WHERE click_id IS NOT NULL OR ts < (SELECT passed FROM m)
    """,
)
def stream_join_left(t):
    """Purchases with the user's clicks within an hour, both as streams with two days of delay. The second wave
    also brings rows that are late by then; unmatched purchases come out when two days and an hour have passed."""
    root = shared_dir(t.spark, "join")
    rows = t.events.select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    first = f"NOT ({_LATE}) AND NOT ({_NEW})"
    for wave in (first, f"NOT ({first})"):
        for kind, folder in (("purchase", "left"), ("click", "right")):
            rows.where(f"event_type = '{kind}' AND ({wave})").drop("event_type").write.mode("append").parquet(f"{root}/{folder}")
        left, right = (st.stream_files(t.spark, f"{root}/{d}", "parquet", "event_id bigint, user_id bigint, ts timestamp") for d in ("left", "right"))
        right = right.select(F.col("event_id").alias("click_id"), "user_id", F.col("ts").alias("click_ts"))
        joined = st.join_streams(left, right, "user_id", "ts", "click_ts", "1 hour", "2 days").select("event_id", "user_id", "click_id")
        st.append_files(joined, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return t.spark.read.schema("event_id bigint, user_id bigint, click_id bigint").parquet(f"{root}/out")


_CHANGES = """
    SELECT user_id, event_type, event_id, value, ts FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
"""


@query("apply_changes", f"SELECT * FROM ({_CHANGES}) WHERE event_type <> 'error'")
def apply_changes(t):
    """Early events are the stored table, all events the change feed: repeats and late rows lose. Errors delete."""
    rows = t.events.select("user_id", "event_type", "event_id", "value", "ts")
    stored = ch.apply_changes(None, rows.filter("ts < TIMESTAMP_NTZ '2024-01-15'"), "user_id", ["ts", "event_id"])
    return ch.apply_changes(stored, rows, "user_id", ["ts", "event_id"], "event_type = 'error'")


def _feed(t, root, waves):
    """The events as a growing folder: yields after each wave of files. Rows of one user come in no order of time."""
    rows = t.events.select("user_id", "event_type", "event_id", "value", "ts")
    for wave in range(waves):
        rows.where(f"pmod(event_id * 7919, {waves}) = {wave}").write.mode("append").parquet(f"{root}/feed")
        yield st.stream_files(t.spark, f"{root}/feed", "parquet", rows.schema)


@query("apply_changes_stream", f"SELECT * FROM ({_CHANGES}) WHERE event_type <> 'error'")
def apply_changes_stream(t):
    """A streamed change log; a snapshot after its first half, and only later batches on top of it."""
    root = shared_dir(t.spark, "changes")
    after = None
    for stream in _feed(t, root, 2):
        ch.log_changes(stream, f"{root}/log", f"{root}/checkpoint").awaitTermination()
        if after is None:
            after = ch.last_batch(t.spark, f"{root}/log")
            logged = t.spark.read.parquet(f"{root}/log").drop(ch.LOG_BATCH)
            ch.write_snapshot(ch.apply_changes(None, logged, "user_id", ["ts", "event_id"], keep_deleted=True), f"{root}/snapshot", ["user_id"])
    return ch.current_state(
        t.spark, f"{root}/log", "user_id", ["ts", "event_id"], "event_type = 'error'", f"{root}/snapshot", after
    )


@query("upsert_stream", f"SELECT * FROM ({_CHANGES}) WHERE event_type <> 'error'")
def upsert_stream(t):
    """Three waves of changes into a keyed table: late changes and late deletions among them, and a batch sent twice."""
    root = shared_dir(t.spark, "upsert")
    table = up.KeyedTable(f"{root}/table", "user_id", ["ts", "event_id"], "event_type = 'error'", 16)
    for stream in _feed(t, root, 3):
        up.upsert_stream(stream, table, f"{root}/checkpoint").awaitTermination()
    table.apply(t.spark.read.parquet(f"{root}/feed"), table.batches(t.spark)[0])
    return table.read(t.spark)


@query(
    "stream_first_all",
    "SELECT user_id, event_type, event_id, ts FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1",
)
def stream_first_all(t):
    """The first event of every user and type, with no horizon: waves bring rows of any age."""
    root = shared_dir(t.spark, "first")
    table = up.first_rows(f"{root}/table", ["user_id", "event_type"], ["ts", "event_id"], 16)
    for stream in _feed(t, root, 2):
        up.upsert_stream(stream.select("user_id", "event_type", "event_id", "ts"), table, f"{root}/checkpoint").awaitTermination()
    return table.read(t.spark)


@query(
    "refresh_partitions",
    """
    SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n, CASE WHEN CAST(ts AS DATE) >= DATE '2024-01-20' THEN 'second' ELSE 'first' END AS run
    FROM events GROUP BY 1, 2
    """,
)
def refresh_partitions(t):
    """All days, then only the days from the 20th on are replaced."""
    root = shared_dir(t.spark, "refresh")
    source = t.events.select(F.to_date("ts").alias("day"), "event_type")

    def totals(run):
        return lambda df: df.groupBy("day", "event_type").agg(F.count(F.lit(1)).alias("n")).withColumn("run", F.lit(run)).repartition("day")

    ch.refresh_partitions(totals("first"), source, root, "day", "2024-01-01")
    ch.refresh_partitions(totals("second"), source, root, "day", "2024-01-20")
    return t.spark.read.parquet(root).select("day", "event_type", "n", "run")


@query("write_bronze", "SELECT o_orderkey, o_totalprice, 'orders' AS bronze_source_file, 'bronze' AS medallion_layer FROM orders WHERE o_orderdate >= DATE '2000-01-01'")
def write_bronze(t):
    """Audit columns, date folders, and a read that touches only the folders it needs."""
    root = shared_dir(t.spark, "bronze")
    rows = add_audit(t.orders.select("o_orderkey", "o_totalprice", F.trunc("o_orderdate", "month").alias("order_month")), "orders")
    wr.write_bronze(rows.repartition("order_month"), root, "order_month", "overwrite")
    back = t.spark.read.parquet(root).filter("order_month >= DATE '2000-01-01'")
    return back.select("o_orderkey", "o_totalprice", "bronze_source_file", "medallion_layer")


@query("write_clustered", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_totalprice BETWEEN 100000 AND 110000")
def write_clustered(t):
    root = shared_dir(t.spark, "clustered")
    wr.write_clustered(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), root, "o_totalprice")
    return t.spark.read.parquet(root).filter("o_totalprice BETWEEN 100000 AND 110000")


@query("append_force", "SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer UNION ALL SELECT s_suppkey, NULL, s_acctbal FROM supplier")
def append_force(t):
    base = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    new = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").cast("string").alias("balance"), "s_nationkey")
    return wr.append(base, new, force=True)


@query("evolve", "SELECT c_custkey AS id, c_acctbal AS balance, c_mktsegment AS segment, NULL::INTEGER AS nation FROM customer UNION ALL SELECT s_suppkey, s_acctbal, NULL, s_nationkey FROM supplier")
def evolve(t):
    old = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    new = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance"), F.col("s_nationkey").alias("nation"))
    return wr.evolve(old, new)[0]


@query("csv_round_trip", "SELECT n_nationkey, n_name, c FROM nation JOIN (SELECT c_nationkey, count(*) AS c FROM customer GROUP BY 1) ON n_nationkey = c_nationkey")
def csv_round_trip(t):
    """CSV export in parts, read back with a schema."""
    root = shared_dir(t.spark, "csv")
    n = t.customer.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("c"))
    wr.export_csv(t.nation.select("n_nationkey", "n_name").join(n, "n_nationkey"), root)
    return t.spark.read.option("header", True).schema("n_nationkey int, n_name string, c bigint").csv(root)
