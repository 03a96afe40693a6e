"""Order-dependent operators against a plain Python loop, with and without splitting."""

import random

import pytest
from pyspark.sql import functions as F

from stepwise.operators import bygroup as bg
from stepwise.operators.skew import heavy_keys, salted_join, split_groups
from stepwise.session import HOT_ROWS_CONF

SCHEMA = "k string, k2 int, t int, id int, v int"


def make(seed, n=120):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        k = rnd.choice(["a", "a", "a", "b", "c", None])
        rows.append((k, rnd.choice([1, 2, None]), rnd.choice([None, 1, 2, 3, 4, 5, 6, 7]), i, rnd.choice([None, 1, 2, 3])))
    rnd.shuffle(rows)
    return rows


def low(x):
    """Sort key with missing first."""
    return (x is not None, x if x is not None else 0)


def lows(x):
    return (x is not None, x or "")


def groups(rows, key):
    out = {}
    for r in rows:
        out.setdefault(key(r), []).append(r)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_retain_sum_reset(spark, skew_mode, seed):
    rows = make(seed)
    df = spark.createDataFrame(rows, SCHEMA)
    got = bg.retain_sum(df, "k", ["t", "id"], {"s": "v", "n": 1}, reset_on="k")
    want = {}
    for g in groups(rows, lambda r: r[0]).values():
        s = n = 0
        for r in sorted(g, key=lambda r: (low(r[2]), r[3])):
            s, n = s + (r[4] or 0), n + 1
            want[r[3]] = (s, n)
    assert {r.id: (r.s, r.n) for r in got.collect()} == want


def test_retain_sum_descending(spark, skew_mode):
    rows = make(7)
    df = spark.createDataFrame(rows, SCHEMA)
    got = bg.retain_sum(df, "k", ["t desc", "id"], {"s": "v"}, reset_on="k", init=5)
    want = {}
    for g in groups(rows, lambda r: r[0]).values():
        s = 5
        for r in sorted(g, key=lambda r: (-(r[2] if r[2] is not None else -99), r[3])):
            s += r[4] or 0
            want[r[3]] = s
    assert {r.id: r.s for r in got.collect()} == want


def test_retain_sum_whole_table(spark, skew_mode):
    rows = make(3)
    df = spark.createDataFrame(rows, SCHEMA)
    got = bg.retain_sum(df, ["k"], ["t", "id"], {"s": "v"})
    s, want = 0, {}
    for r in sorted(rows, key=lambda r: (lows(r[0]), low(r[2]), r[3])):
        s += r[4] or 0
        want[r[3]] = s
    assert {r.id: r.s for r in got.collect()} == want


@pytest.mark.parametrize("seed", [4, 5])
def test_retain_last(spark, skew_mode, seed):
    rows = make(seed)
    df = spark.createDataFrame(rows, SCHEMA)
    got = bg.retain_last(df, "k", ["t", "id"], {"c": "v"})
    want = {}
    for g in groups(rows, lambda r: r[0]).values():
        c = None
        for r in sorted(g, key=lambda r: (low(r[2]), r[3])):
            c = r[4] if r[4] is not None else c
            want[r[3]] = c
    assert {r.id: r.c for r in got.collect()} == want


def test_neighbours(spark, skew_mode):
    rows = make(6)
    df = spark.createDataFrame(rows, SCHEMA)
    got = bg.neighbours(df, "k", ["t", "id"], {"p1": ("id", 1), "p3": ("id", 3), "n2": ("id", -2)})
    want = {}
    for g in groups(rows, lambda r: r[0]).values():
        g = sorted(g, key=lambda r: (low(r[2]), r[3]))

        def at(i):
            return g[i][3] if 0 <= i < len(g) else None

        for i, r in enumerate(g):
            want[r[3]] = (at(i - 1), at(i - 3), at(i + 2))
    assert {r.id: (r.p1, r.p3, r.n2) for r in got.collect()} == want
    assert got.count() == len(rows)


def test_by_flags_prefixes(spark, skew_mode):
    rows = make(8)
    df = spark.createDataFrame(rows, SCHEMA)
    got = bg.by_flags(df, ["k", "k2"], ["t", "id"])
    seq = sorted(rows, key=lambda r: (lows(r[0]), low(r[1]), low(r[2]), r[3]))
    want = {}
    for i, r in enumerate(seq):
        p = seq[i - 1] if i else None
        n = seq[i + 1] if i + 1 < len(seq) else None
        want[r[3]] = (
            p is None or p[0] != r[0],
            p is None or p[:2] != r[:2],
            n is None or n[0] != r[0],
            n is None or n[:2] != r[:2],
        )
    assert {r.id: (r.first_k, r.first_k2, r.last_k, r.last_k2) for r in got.collect()} == want


def test_sizes_and_index(spark, skew_mode):
    rows = make(9)
    df = spark.createDataFrame(rows, SCHEMA)
    sizes = {k: len(g) for k, g in groups(rows, lambda r: r[0]).items()}
    assert {r.id: r.group_size for r in bg.group_size(df, "k").collect()} == {r[3]: sizes[r[0]] for r in rows}
    dup = bg.dup_flag(df, ["k", "k2", "t"])
    cnt = {k: len(g) for k, g in groups(rows, lambda r: r[:3]).items()}
    assert {r.id: r.dup_flag for r in dup.collect()} == {r[3]: "Y" if cnt[r[:3]] > 1 else "N" for r in rows}
    got = bg.row_index(df, None, ["t", "id"])
    want = {r[3]: i for i, r in enumerate(sorted(rows, key=lambda r: (low(r[2]), r[3])))}
    assert {r.id: r.row_index for r in got.collect()} == want


def test_keep_first_last(spark):
    rows = make(10)
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r.k, r.id) for r in bg.keep_last(df, "k", ["t", "id"], 2).collect()}
    want = set()
    for k, g in groups(rows, lambda r: r[0]).items():
        want |= {(k, r[3]) for r in sorted(g, key=lambda r: (low(r[2]), r[3]))[-2:]}
    assert got == want
    plan = bg.keep_first(df, "k", ["t", "id"])._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan


def test_string_order_key_is_split(spark):
    spark.conf.set("stepwise.skew.hotRows", "3")
    try:
        df = spark.createDataFrame([("a", f"n{i:03d}", i) for i in range(50)], "k string, s string, v int")
        split = split_groups(df, ["k"], ["s"])
        assert split.hot and split.df.select("__chunk").distinct().count() > 5
        got = bg.retain_sum(df, "k", "s", {"t": "v"}, "k")
        assert got.filter("s = 'n049'").first().t == sum(range(50))
    finally:
        spark.conf.unset("stepwise.skew.hotRows")


def test_constant_leading_key_is_split_by_the_next(spark):
    spark.conf.set("stepwise.skew.hotRows", "20")
    try:
        df = spark.range(400).select(F.lit("a").alias("k"), F.lit(None).cast("date").alias("d"), F.lit("2024-01-01 10:00:00.123456").cast("timestamp").alias("t"), "id")
        split = split_groups(df, ["k"], ["d", "t", "id"])
        assert split.df.select("__chunk").distinct().count() > 5
        down = split_groups(df, ["k"], ["d desc", "t desc", "id desc"])
        ends = down.df.groupBy("__chunk").agg(F.max("id").alias("hi")).orderBy("__chunk").collect()
        assert len(ends) > 5 and [r.hi for r in ends] == sorted((r.hi for r in ends), reverse=True)
        got = bg.retain_sum(df, "k", ["d desc", "t desc", "id desc"], {"s": F.lit(1)}, "k")
        assert all(r.s == 400 - r.id for r in got.collect())
    finally:
        spark.conf.unset("stepwise.skew.hotRows")


@pytest.mark.parametrize("how", ["inner", "left", "right", "full", "left_semi", "left_anti"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_salted_join(spark, skew_mode, how, null_safe):
    left = spark.createDataFrame([(k, i) for i, k in enumerate([1] * 9 + [2, 3, None, 7, 7])], "k int, a int")
    right = spark.createDataFrame([(k, i) for i, k in enumerate([1, 1, 3, None, 4] + [7] * 8)], "k int, b int")
    got = salted_join(left, right, ["k"], how, null_safe)
    r2 = right.withColumnRenamed("k", "rk")
    cond = F.col("k").eqNullSafe(F.col("rk")) if null_safe else F.col("k") == F.col("rk")
    want = left.join(r2, cond, how)
    if how in ("right", "full"):
        want = want.withColumn("k", F.coalesce("k", "rk"))
    want = want.drop("rk")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(got.columns).collect()))


def test_heavy_keys_found_in_a_sample(spark):
    k = F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 5 == 0, F.lit(-1)).otherwise(F.col("id"))
    df = spark.range(300_000).select(k.alias("k"), "id")
    found = lambda limit: {(r.k, r["__group_rows"]) for r in heavy_keys(df, ["k"], limit).collect()}
    assert found(50_000) == {(None, 100_000)}
    assert found(20_000) == {(None, 100_000), (-1, 40_000)}
    assert heavy_keys(df, ["k"], 150_000) is None


def test_split_frames_spread_over_tasks(spark):
    """The chunks of a heavy group end up in several partitions, also after a join on the group."""
    spark.conf.set("stepwise.skew.hotRows", "200")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        other = spark.range(3).select(F.col("id").cast("int").alias("k")).distinct()
        df = spark.range(5000).select(F.lit(1).alias("k"), "id").join(other, "k")
        out = bg.retain_sum(df, "k", ["id"], {"s": F.lit(1)}, "k").withColumn("p", F.spark_partition_id())
        sizes = [r["count"] for r in out.groupBy("p").count().collect()]
        assert len(sizes) >= 3 and max(sizes) < 3500
    finally:
        spark.conf.unset("stepwise.skew.hotRows")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_whole_table_total_has_no_single_partition(spark):
    spark.conf.set("stepwise.skew.hotRows", "100")
    try:
        plan = bg.row_index(spark.range(2000), None, ["id"])._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(__chunk" in plan
    finally:
        spark.conf.unset("stepwise.skew.hotRows")


def test_order_is_required(spark):
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    with pytest.raises(ValueError):
        bg.retain_sum(df, "k", [], {"s": "v"}, "k")


def test_thousands_of_heavy_groups_and_mixed_directions(spark):
    """More heavy keys than any list would hold, and one huge group whose leading order key is constant."""
    spark.conf.set(HOT_ROWS_CONF, "200")
    try:
        many = spark.range(1200 * 250).selectExpr("CAST(id % 1200 AS STRING) AS k", "0 AS t", "CAST(id AS INT) AS id", "1 AS v")
        huge = spark.range(30_000).selectExpr("'x' AS k", "0 AS t", "CAST(-id AS INT) AS id", "CAST(id % 3 AS INT) AS v")
        df = many.unionByName(huge)
        assert heavy_keys(df, ["k"]).count() == 1201
        split = split_groups(df, ["k"], ["t desc", "id", "v desc"])
        sizes = [r["n"] for r in split.df.groupBy("k", "__chunk").agg(F.count("*").alias("n")).collect()]
        chunks = [r["n"] for r in split.df.where("k = 'x'").groupBy("__chunk").agg(F.count("*").alias("n")).collect()]
        assert max(chunks) < 2 * sum(chunks) / len(chunks) and len(chunks) > 100 and max(sizes) < 500
        got = bg.retain_sum(df, "k", ["t desc", "id", "v desc"], {"n": 1, "s": "v"}, reset_on="k")
        checked = got.where("k = 'x'").select("id", "n", "s").collect()
        running, want = 0, {}
        for n, i in enumerate(range(29_999, -1, -1), 1):
            running += i % 3
            want[-i] = (n, running)
        assert {r["id"]: (r["n"], r["s"]) for r in checked} == want
        assert got.where("k <> 'x'").groupBy("k").agg(F.max("n").alias("n"), F.countDistinct("n").alias("d")).where("n <> 250 OR d <> 250").count() == 0
    finally:
        spark.conf.unset(HOT_ROWS_CONF)
