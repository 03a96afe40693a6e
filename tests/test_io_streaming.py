"""Readers, writers, streams and keyed changes."""

import random

import pytest
from pyspark.sql import functions as F

from stepwise.operators import quality as ql
from stepwise.operators.skew import salted_join
from stepwise.session import shared_dir
from stepwise.sources import readers as rd
from stepwise.sources import writers as wr
from stepwise.streaming import changes as ch
from stepwise.streaming import streams as st


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_files_round_trip(spark, tmp_path):
    df = spark.range(20).withColumn("s", F.concat(F.lit("v,"), "id"))
    wr.export_csv(df, str(tmp_path / "csv"))
    assert rows(rd.read_files(spark, str(tmp_path / "csv"), "csv", "id bigint, s string")) == rows(df)
    for fmt in ("json", "parquet", "orc"):
        assert wr.save_files(df, str(tmp_path / fmt), fmt) == 20
        assert rows(rd.read_files(spark, str(tmp_path / fmt), fmt, "id bigint, s string")) == rows(df)


def test_tables(spark):
    spark.sql("DROP TABLE IF EXISTS part_table")
    df = spark.range(10).withColumn("p", F.col("id") % 3)
    assert wr.save_table(df, "part_table", ["p"]) == 10
    assert rd.read_table(spark, "part_table").filter("p = 1").count() == 3
    names = {r.name for r in rd.contents_all(spark, "default").filter("table_name = 'part_table'").collect()}
    assert names == {"id", "p"}
    spark.sql("DROP TABLE part_table")


def test_contents_profile(spark):
    df = spark.createDataFrame([(1, "ab", [1]), (2, None, None)], "i int, s string, a array<int>")
    got = {r.name: (r.type, r.n, r.nmiss, r.min, r.max, r.max_length) for r in rd.contents(df).collect()}
    assert got == {"i": ("int", 2, 0, "1", "2", None), "s": ("string", 1, 1, "ab", "ab", 2), "a": ("array<int>", 1, 1, None, None, None)}


def test_jdbc_options():
    split = rd.jdbc_options("jdbc:x", "SELECT 1", "id", 0, 100, 8)
    assert split["dbtable"] == "(SELECT 1) AS t" and split["numPartitions"] == "8" and split["partitionColumn"] == "id"
    assert "partitionColumn" not in rd.jdbc_options("jdbc:x", "SELECT 1")
    with pytest.raises(ValueError):
        rd.jdbc_options("jdbc:x", "SELECT 1", "id")


def test_append_and_evolve(spark):
    base = spark.createDataFrame([(1, 2.0)], "id int, v double")
    new = spark.createDataFrame([("7", "x", 1), ("bad", "y", 1)], "id string, w string, z int")
    with pytest.raises(ValueError):
        wr.append(base, new)
    assert rows(wr.append(base, new, force=True)) == rows(spark.createDataFrame([(1, 2.0), (7, None), (None, None)], "id int, v double"))
    merged, report = wr.evolve(base, new)
    assert sorted(report) == [("id", "type_changed", "int -> string"), ("v", "dropped", "double"), ("w", "added", "string"), ("z", "added", "int")]
    assert merged.columns == ["id", "v", "id_string", "w", "z"] and merged.count() == 3
    assert merged.where("id_string IS NOT NULL").count() == new.where("id IS NOT NULL").count()


def test_partition_pruning_and_clustering(spark, tmp_path):
    df = spark.range(100).withColumn("day", F.expr("date_add(DATE '2024-01-01', CAST(id % 5 AS INT))"))
    wr.write_bronze(df, str(tmp_path / "b"), "day")
    back = spark.read.parquet(str(tmp_path / "b")).filter("day = DATE '2024-01-03'")
    assert back.count() == 20 and "PartitionFilters: [isnotnull(day" in back._jdf.queryExecution().toString()
    wr.write_clustered(df, str(tmp_path / "c"), "id", 4)
    ranges = spark.read.parquet(str(tmp_path / "c")).groupBy(F.input_file_name().alias("f")).agg(F.min("id").alias("lo"), F.max("id").alias("hi"))
    spans = sorted((r.lo, r.hi) for r in ranges.collect())
    assert len(spans) == 4 and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_stream_csv_incremental(spark, tmp_path):
    src, out, cp = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")
    spark.range(5).selectExpr("id", "'a' AS s").write.option("header", True).csv(src)

    def run():
        stream = st.stream_files(spark, src, "csv", "id bigint, s string", max_files=1)
        st.append_files(st.bronze_stream(stream, {"big": "id > 1"}), out, cp).awaitTermination()
        return spark.read.parquet(out).count()

    assert run() == 3
    assert run() == 3
    spark.range(10, 12).selectExpr("id", "'b' AS s").write.mode("append").option("header", True).csv(src)
    assert run() == 5


def test_stream_from_table(spark, tmp_path):
    spark.sql("DROP TABLE IF EXISTS bronze_ids")
    wr.save_table(spark.range(7), "bronze_ids")
    st.append_files(st.stream_table(spark, "bronze_ids").filter("id > 2"), str(tmp_path / "o"), str(tmp_path / "c")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "o")).count() == 4
    spark.sql("DROP TABLE bronze_ids")


def test_weekly_stream_late_rows(spark, tmp_path):
    src = str(tmp_path / "in")
    schema = "id int, ts timestamp, v int"

    def put(data):
        spark.createDataFrame(data, "id int, ts string, v int").withColumn("ts", F.to_timestamp("ts")).coalesce(1).write.mode("append").parquet(src)

    def run():
        stream = st.stream_files(spark, src, "parquet", schema, max_files=1)
        totals = st.weekly_totals(stream, "ts", {"n": F.count(F.lit(1)), "v": F.sum("v")})
        st.append_files(totals, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
        return sorted((str(r.week), r.n, r.v) for r in spark.read.parquet(str(tmp_path / "out")).collect())

    put([(1, "2024-01-03 00:00:00", 1), (2, "2024-01-07 23:59:59", 2), (3, "2024-01-08 00:00:00", 4)])
    assert run() == []
    put([(4, "2024-01-20 00:00:00", 8)])
    assert run() == [("2024-01-01", 2, 3), ("2024-01-08", 1, 4)]
    put([(5, "2024-01-02 00:00:00", 100), (6, "2024-02-20 00:00:00", 16)])
    assert run() == [("2024-01-01", 2, 3), ("2024-01-08", 1, 4), ("2024-01-15", 1, 8)]


def test_first_per_key_and_stream_join(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.createDataFrame([(1, "2024-01-01 00:00:00"), (1, "2024-01-01 00:05:00"), (2, "2024-01-01 00:01:00")], "k int, ts string").withColumn(
        "ts", F.to_timestamp("ts")
    ).coalesce(1).write.parquet(src)
    stream = st.stream_files(spark, src, "parquet", "k int, ts timestamp")
    st.append_files(st.first_per_key(stream, ["k"], "ts", "1 hour"), str(tmp_path / "o1"), str(tmp_path / "c1")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "o1")).count() == 2
    right = st.stream_files(spark, src, "parquet", "k int, ts timestamp").withColumnRenamed("ts", "rts")
    joined = st.join_streams(stream, right, "k", "ts", "rts", "1 minute", "10 minutes", "inner")
    st.append_files(joined, str(tmp_path / "o2"), str(tmp_path / "c2")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "o2")).count() == 3


def change_rows(seed, n=80):
    rnd = random.Random(seed)
    return [(rnd.randrange(8), rnd.randrange(20), i, rnd.choice(["put", "put", "del"]), rnd.randrange(100)) for i in range(n)]


SCHEMA = "k int, seq int, tie int, op string, v int"


def expected(data):
    last = {}
    for r in data:
        if r[0] not in last or last[r[0]][1:3] < r[1:3]:
            last[r[0]] = r
    return sorted([r for r in last.values() if r[3] != "del"], key=str)


def test_changes_any_order(spark, tmp_path):
    data = change_rows(3)
    want = expected(data)
    df = spark.createDataFrame(data, SCHEMA)
    assert rows(ch.apply_changes(None, df, "k", ["seq", "tie"], "op = 'del'")) == want
    random.Random(1).shuffle(data)
    first, second = data[:30], data[30:]
    stored = ch.apply_changes(None, spark.createDataFrame(first, SCHEMA), "k", ["seq", "tie"])
    again = ch.apply_changes(stored, spark.createDataFrame(second + first, SCHEMA), "k", ["seq", "tie"], "op = 'del'")
    assert rows(again) == want


def test_changes_streamed(spark, tmp_path):
    data = change_rows(4)
    feed, log, cp = (str(tmp_path / x) for x in ("feed", "log", "cp"))
    for part in (data[50:], data[:50]):
        spark.createDataFrame(part, SCHEMA).write.mode("append").parquet(feed)
        ch.log_changes(st.stream_files(spark, feed, "parquet", SCHEMA), log, cp).awaitTermination()
    assert spark.read.parquet(log).count() == len(data)
    assert rows(ch.current_state(spark, log, "k", ["seq", "tie"], "op = 'del'")) == expected(data)


def test_refresh_touches_only_new_days(spark, tmp_path):
    path = str(tmp_path / "gold")
    src = spark.range(30).select(F.expr("date_add(DATE '2024-01-01', CAST(id % 10 AS INT))").alias("day"), "id")
    count = lambda df: df.groupBy("day").agg(F.count(F.lit(1)).alias("n"))
    ch.refresh_partitions(count, src, path, "day", "2024-01-01")
    ch.refresh_partitions(lambda df: count(df).withColumn("n", F.col("n") * 10), src, path, "day", "2024-01-09")
    got = {str(r.day): r.n for r in spark.read.parquet(path).collect()}
    assert got == {f"2024-01-{i:02d}": 30 if i >= 9 else 3 for i in range(1, 11)}


class Session:
    """Just the settings ``shared_dir`` looks at."""

    def __init__(self, conf, checkpoint=None):
        self.conf, self.sparkContext, self._dir = conf, self, checkpoint

    def getCheckpointDir(self):
        return self._dir

    def setCheckpointDir(self, path):
        self._dir = path


def test_shared_dir_follows_the_session(tmp_path):
    assert shared_dir(Session({"spark.checkpoint.dir": "/cluster/cp"}, "/other"), "x").startswith("/cluster/cp/stepwise/x-")
    assert shared_dir(Session({}, "/set/by/hand/"), "x").startswith("/set/by/hand/stepwise/x-")
    own = Session({})
    first = shared_dir(own, "x")
    assert first.startswith(own.getCheckpointDir()) and first != shared_dir(own, "x")


def test_plain_join_without_heavy_keys(spark):
    left, right = spark.range(10).withColumnRenamed("id", "k"), spark.range(10).withColumnRenamed("id", "k")
    plan = salted_join(left, right, ["k"], "full")._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and plan.count("Join") == 1


def test_a_late_change_does_not_undo_a_deletion(spark):
    early = spark.createDataFrame([(1, 1, 0, "put", 7), (1, 5, 0, "del", 7), (2, 1, 0, "put", 7)], SCHEMA)
    late = spark.createDataFrame([(1, 3, 0, "put", 7)], SCHEMA)
    state = ch.apply_changes(None, early, "k", ["seq", "tie"], "op = 'del'", keep_deleted=True)
    after = ch.apply_changes(state, late, "k", ["seq", "tie"], "op = 'del'")
    assert [r["k"] for r in after.collect()] == [2]
    assert ch.live_rows(state, "op = 'del'").count() == 1


def test_refresh_drops_days_without_rows(spark, tmp_path):
    path = str(tmp_path / "days")
    count = lambda df: df.groupBy("day").agg(F.count("*").alias("n"))
    source = spark.sql("SELECT DATE'2024-01-01' + CAST(id AS INT) AS day FROM range(5)")
    ch.refresh_partitions(count, source, path, "day", "2024-01-01")
    ch.refresh_partitions(count, source.where("day <> '2024-01-04'"), path, "day", "2024-01-03")
    days = sorted(str(r["day"]) for r in spark.read.parquet(path).collect())
    assert days == ["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-05"]


def test_no_shared_folder_on_a_cluster(spark, monkeypatch):
    from types import SimpleNamespace

    from stepwise.session import shared_dir

    context = SimpleNamespace(master="yarn", getCheckpointDir=lambda: None)
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: None), sparkContext=context)
    with pytest.raises(ValueError):
        shared_dir(session, "x")


def test_stream_left_join_with_late_rows(spark, tmp_path):
    """Unmatched rows come out when their range has passed, late rows never, each pair once."""
    left, right, out = (str(tmp_path / n) for n in ("l", "r", "o"))

    def put(path, data):
        frame = spark.createDataFrame(data, "k int, name string, ts string").withColumn("ts", F.to_timestamp("ts"))
        frame.coalesce(1).write.mode("append").parquet(path)

    def run():
        l, r = (st.stream_files(spark, p, "parquet", "k int, name string, ts timestamp") for p in (left, right))
        r = r.select("k", F.col("name").alias("other"), F.col("ts").alias("rts"))
        st.append_files(st.join_streams(l, r, "k", "ts", "rts", "10 minutes", "1 hour").select("name", "other"), out, str(tmp_path / "c")).awaitTermination()
        return rows(spark.read.schema("name string, other string").parquet(out))

    put(left, [(1, "a", "2024-01-01 00:00:00"), (1, "b", "2024-01-01 05:00:00"), (2, "c", "2024-01-01 00:00:00"), (None, "n", "2024-01-01 00:00:00")])
    put(right, [(1, "x", "2024-01-01 00:10:00"), (1, "y", "2024-01-01 00:10:01"), (1, "z", "2024-01-01 05:00:00"), (None, "w", "2024-01-01 00:00:00")])
    first = [("a", "x"), ("b", "z"), ("c", None), ("n", None)]
    assert run() == first
    # "late" is older than the watermark; "d" still meets its partner; "e" waits.
    put(left, [(2, "late", "2024-01-01 00:01:00"), (1, "d", "2024-01-01 05:09:00"), (3, "e", "2024-01-01 09:00:00")])
    put(right, [(2, "late", "2024-01-01 00:01:00"), (9, "v", "2024-01-01 09:00:00")])
    assert run() == sorted([*first, ("d", "z")], key=str)
    put(left, [(9, "f", "2024-01-02 00:00:00")])
    put(right, [(9, "u", "2024-01-02 00:00:00")])
    assert run() == sorted([*first, ("d", "z"), ("e", None), ("f", "u")], key=str)


def test_stream_rule_log(spark, tmp_path):
    rules, path, log = {"small": "id < 7"}, str(tmp_path / "o"), str(tmp_path / "log")
    for wave in range(2):
        spark.range(wave * 5, wave * 5 + 5).write.mode("append").parquet(str(tmp_path / "in"))
        stream = st.stream_files(spark, str(tmp_path / "in"), "parquet", "id bigint")
        st.write_checked_stream(stream, rules, path, log, str(tmp_path / "c"), "s", drop=True).awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == list(range(7))
    assert rows(ql.read_log(spark, log).select("batch", "violations", "rows")) == [(0, 0, 5), (1, 3, 5)]
