"""Joins, aggregates, metrics, set operators and checks on small tables."""

import datetime as dt
import itertools
import math
import random
import statistics
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stepwise.operators import agg as ag
from stepwise.operators import joins as jn
from stepwise.operators import quality as ql
from stepwise.operators import sortset as ss
from stepwise.operators.metrics import Measure, MetricView
from stepwise.sources.readers import with_options


def d(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_prior_within_equals_self_join(spark, skew_mode):
    rnd = random.Random(5)
    data = [(i, rnd.choice("aab"), d(rnd.randrange(25))) for i in range(60)] + [(99, "a", None)]
    df = spark.createDataFrame(data, "id int, k string, day date")
    got = {r.id: (r.prior_id, r.prior_day) for r in jn.prior_within(df, ["k"], "day", "id", 7).collect()}
    want = {}
    for i, k, day in data:
        hits = [(q, j) for j, k2, q in data if day and q and k2 == k and 0 < (day - q).days <= 7]
        want[i] = (min(hits)[1], min(hits)[0]) if hits else (None, None)
    assert got == want


def test_span_join_statuses(spark, skew_mode):
    df = spark.createDataFrame([(1, "m", d(0)), (2, "m", d(10)), (3, "m", d(50)), (4, "x", d(0)), (5, "o", d(5000)), (6, "m", d(30))], "id int, k string, day date")
    spans = spark.createDataFrame([("m", d(5), d(20), "A"), ("m", d(25), d(30), "B"), ("o", d(1), None, "C")], "k string, lo date, hi date, plan string")
    full = jn.span_join(df, spans, "k", "day", "lo", "hi")
    assert full.count() == 2 * 4 + 2
    best = jn.span_join(df, spans, "k", "day", "lo", "hi", best_by=["id"])
    assert {r.id: (r.span_status, r.plan) for r in best.collect()} == {
        1: ("NOT_YET_EFFECTIVE", "B"), 2: ("ELIGIBLE", "A"), 3: ("COVERAGE_TERMINATED", "B"), 4: ("NOT_FOUND", None), 5: ("ELIGIBLE", "C"), 6: ("ELIGIBLE", "B"),
    }


def test_bands(spark, skew_mode):
    bands = [(s, lo, hi) for s, lo, hi in jn.make_bands([("x", 1), ("y", 3)])]
    assert bands == [("x", 0.0, 0.25), ("y", 0.25, 1.0)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate([-0.1, 0.0, 0.2499, 0.25, 0.99, 1.0, None])], "id int, v double")
    got = {r.id: r.band for r in jn.band_assign(df, bands, "v", "band").collect()}
    want = {0: None, 1: "x", 2: "x", 3: "y", 4: "y", 5: None, 6: None}
    assert got == want
    table = spark.createDataFrame(bands, "label string, lo double, hi double")
    assert {r.id: r.label for r in jn.band_join(df, table, "v", "lo", "hi").collect()} == want
    many = [(f"b{i}", float(i), float(i + 1)) for i in range(100)]
    out = jn.band_assign(spark.range(100).withColumn("v", F.col("id") + 0.5), many, "v", "band")
    assert all(r.band == f"b{r.id}" for r in out.collect())


def test_picks(spark, skew_mode):
    pool = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "name string, id int")
    out = jn.index_pick(spark.range(-2, 5), pool, F.col("id"), ["id"], ["name"])
    assert {r.id: r.name for r in out.collect()} == {i: "abc"[i % 3] for i in range(-2, 5)}
    top = jn.pick_top_join(pool, spark.createDataFrame([("a", 5), ("b", 9), ("c", 9)], "name string, n int"), "name", ["n desc", "name"])
    assert rows(top) == [("b", 2)]
    both = jn.cross_small(spark.range(3), pool)
    assert both.count() == 9 and "CartesianProduct" not in both._jdf.queryExecution().toString()
    with pytest.raises(ValueError):
        jn.cross_small(pool, spark.range(50), limit=10)
    parent = spark.createDataFrame([(1,), (3,)], "pid int")
    assert rows(jn.orphans(pool, parent, {"id": "pid"})) == [(2, "b")]
    assert rows(jn.covered(pool, parent, {"id": "pid"})) == [(1, "a"), (3, "c")]


def test_summary_type_bits(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("a", "y", 3.0), ("b", "x", None), (None, "x", 9.0)], "p string, q string, v double")
    out = {(r["_TYPE_"], r.p, r.q): (r["_FREQ_"], r.v_n, r.v_sum, r.v_std) for r in ag.summary(df, ["p", "q"], "v", ["n", "sum", "std"]).collect()}
    assert out[(0, None, None)] == (3, 2, 4.0, pytest.approx(2**0.5))
    assert out[(1, None, "x")] == (2, 1, 1.0, None)
    assert out[(2, "a", None)] == (2, 2, 4.0, pytest.approx(2**0.5))
    assert out[(3, "b", "x")] == (1, 0, None, None)
    assert len(out) == 1 + 2 + 2 + 3


def test_means_missing_class(spark, skew_mode):
    df = spark.createDataFrame([(k, v) for k, v in itertools.product(["a", None], [1.0, 2.0, 4.0, None])] + [("a", 8.0)], "k string, v double")
    assert [r.k for r in ag.means(df, "k", "v").collect()] == ["a"]
    got = {r.k: (r.v_n, r.v_nmiss, r.v_median) for r in ag.means(df, "k", "v", ["n", "nmiss", "median"], missing=True).collect()}
    assert got == {"a": (4, 1, 3.0), None: (3, 1, 2.0)}


def test_quantile_without_class(spark, skew_mode):
    df = spark.range(1, 12).withColumn("v", F.col("id").cast("double"))
    assert ag.exact_quantile(df, [], "v", 0.25, "q").first().q == 3.5


def test_freq_tables(spark, skew_mode):
    df = spark.createDataFrame([(x,) for x in "aabcccc"] + [(None,)], "k string")
    assert rows(ag.freq(df, "k").select("k", "count", "cum_count", F.round("cum_percent", 3))) == [
        ("a", 2, 2, 28.571), ("b", 1, 3, 42.857), ("c", 4, 7, 100.0)
    ]
    two = spark.createDataFrame([("a", "x"), ("a", "x"), ("a", "y"), ("b", "y")], "p string, q string")
    assert rows(ag.crosstab_freq(two, "p", "q")) == [("a", "x", 2, 50.0, 200 / 3, 100.0), ("a", "y", 1, 25.0, 100 / 3, 50.0), ("b", "y", 1, 25.0, 100.0, 50.0)]
    assert ag.crosstab_freq(two, "p", "q", nocol=True, nopercent=True).columns == ["p", "q", "count", "row_pct"]


def test_transposes(spark):
    df = spark.createDataFrame([(1, "A", 100), (1, "B", 200), (2, "A", 150)], "id int, product string, amount int")
    wide = ag.transpose_wide(df, "id", "product", "amount")
    assert rows(wide) == [(1, 100, 200), (2, 150, None)]
    assert rows(ag.transpose_long(wide, "id", ["A", "B"])) == [(1, "A", 100), (1, "B", 200), (2, "A", 150), (2, "B", None)]
    twice = df.union(df)
    with pytest.raises(PySparkException):
        ag.transpose_wide(twice, "id", "product", "amount").collect()
    assert rows(ag.transpose_wide(twice, "id", "product", "amount", on_duplicate="max")) == rows(wide)


def test_tabulate_total(spark):
    df = spark.createDataFrame([("e", "A", 1.0), ("e", "B", 2.0), ("w", "A", 5.0)], "region string, product string, v double")
    out = ag.tabulate(df, "region", "product", "v", ["sum", "mean"], ["A", "B"], "ALL")
    assert rows(out) == [("ALL", 6.0, 3.0, 2.0, 2.0), ("e", 1.0, 1.0, 2.0, 2.0), ("w", 5.0, 5.0, None, None)]


def test_totals_and_others(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 1.0, 2.0), ("b", 6.0, 8.0)], "k string, x double, y double")
    out = ag.with_total(df, "k", {"sx": "x", "sy": "y"}, "n", {"rate": lambda: F.col("sx") / F.col("sy")})
    assert rows(out) == [("TOTAL", 3, 8.0, 12.0, 8 / 12), ("a", 2, 2.0, 4.0, 0.5), ("b", 1, 6.0, 8.0, 0.75)]
    many = spark.createDataFrame([(x,) for x in "aaabbcd"] + [(None,)], "k string")
    top = ag.top_n_other(many, "k", 2).groupBy("k").count()
    assert {r.k: r["count"] for r in top.collect()} == {"a": 3, "b": 2, "Other": 3}


def test_obs_ranges(spark, skew_mode):
    df = spark.range(1, 31).withColumn("v", F.col("id") * 10)
    got = with_options(df, where="v > 50", firstobs=3, obs=5, order=["id"], keep=["id"], rename={"id": "n"})
    assert got.columns == ["n"] and sorted(r.n for r in got.collect()) == [8, 9, 10]
    assert ag.index_window(df, ["id desc"], 28).count() == 3
    with pytest.raises(ValueError):
        with_options(df, obs=3)


def test_metric_view_grain(spark):
    df = spark.createDataFrame([("a", "x", 1.0, 10.0), ("a", "y", 9.0, 10.0), ("b", "x", 1.0, 1.0)], "k string, q string, num double, den double")
    view = MetricView(df, {"k": F.col("k")}, {"rate": Measure(F.sum("num") / F.sum("den")), "n": Measure(F.count(F.lit(1)))})
    assert rows(view.query(["k"], ["rate"])) == [("a", 0.5), ("b", 1.0)]
    assert view.query(measures=["rate"]).first().rate == 11 / 21
    assert rows(view.query(["k"], {"count": "n"}, where="q = 'x'", having="count > 0")) == [("a", 1), ("b", 1)]


def test_checks(spark):
    df = spark.createDataFrame([(1, 5.0), (2, -1.0), (3, None)], "id int, v double")
    rule = {"positive": "v > 0"}
    kept, seen = ql.expect(df, rule)
    assert kept.count() == 3 and seen.get == {"rows": 3, "positive": 2}
    kept, seen = ql.expect_or_drop(df, rule)
    assert len(kept.collect()) == 1 and seen.get["positive"] == 2
    with pytest.raises(PySparkException):
        ql.expect_or_fail(df, rule).collect()
    good, bad = ql.quarantine(df, {**rule, "small": "v < 3"})
    assert good.count() == 0 and {r.id: r.edit_reason for r in bad.collect()} == {1: "small", 2: "positive", 3: "positive; small"}
    assert rows(ql.validate(df, {**rule, "id": "id IS NOT NULL"})) == [("id", 0, 3, True), ("positive", 2, 3, False)]
    assert rows(ql.duplicate_keys(df.union(df), "id")) == [(1, 2), (2, 2), (3, 2)]
    assert rows(ql.unresolved(df, spark.createDataFrame([(1,)], "pk int"), "id", "pk")) == [(2, 1), (3, 1)]


def test_parity(spark):
    a = spark.createDataFrame([(1, 5.0, "x"), (2, 7.0, "y")], "id int, v double, s string")
    same = ql.parity(a, a.orderBy(F.desc("id")), ["v"])
    assert all(r.passed for r in same.collect())
    b = spark.createDataFrame([(1, 5.05, "x"), (3, 7.0, "y")], "id int, v double, t string")
    report = {r.check: r.passed for r in ql.parity(a, b, ["v"]).collect()}
    assert report == {"row_count": True, "schema_differences": False, "checksum_match": False, "sum_v": True}
    assert rows(ss.diff(a, b, "id", 0.1)) == [(2, "removed", None), (3, "added", None)]
    assert rows(ss.diff(a, b, "id"))[0] == (1, "changed", "v")
    assert rows(ss.diff_rows(a.union(a), a)) == [(1, 5.0, "x", "only_a", 1), (2, 7.0, "y", "only_a", 1)]


def test_empty_inputs(spark):
    empty = spark.createDataFrame([], "k string, v double, id int")
    assert ag.summary(empty, ["k"], "v").count() == 0
    assert ag.freq(empty, "k").count() == 0
    assert ag.fail_rate(empty.withColumn("f", F.lit(1)), "f").first().fail_rate is None
    assert ag.share_of_total(empty, "v").count() == 0
    assert [r.passed for r in ql.validate(empty, {"x": "v > 0"}).collect()] == [True]


def test_quantiles_of_several_variables(spark, skew_mode):
    rnd = random.Random(1)
    data = [
        (rnd.choice(["a", "a", "b", None]), rnd.choice([None, 1, 2, 2, 9, -4]), rnd.choice([None, 0.5, -0.0, 3.25, 1e6]), Decimal(rnd.randrange(50)) / 4)
        for _ in range(60)
    ] + [("c", None, None, None), ("d", 5, None, Decimal("1.25"))]
    df = spark.createDataFrame(data, "k string, i int, x double, m decimal(9,2)")

    def quantile(values, q):
        values = sorted(float(v) for v in values if v is not None)
        if not values:
            return None
        at = (len(values) - 1) * q
        lo, hi = values[math.floor(at)], values[math.ceil(at)]
        return lo + (hi - lo) * (at - math.floor(at))

    def spread(values):
        values = [float(v) for v in values if v is not None]
        return statistics.stdev(values) if len(values) > 1 else None

    groups = {}
    for k, *rest in data:
        groups.setdefault(k, []).append(rest)
    got = {r.k: r[1:] for r in ag.exact_quantiles(df, "k", {"a": ("i", 0.5), "b": ("x", 0.9), "c": ("i", 0.0), "d": ("m", 0.33)}).collect()}
    assert set(got) == set(groups)
    for k, rows_ in groups.items():
        i, x, m = zip(*rows_)
        assert got[k] == pytest.approx((quantile(i, 0.5), quantile(x, 0.9), quantile(i, 0), quantile(m, 0.33)))
    stats = ["n", "nmiss", "sum", "min", "max", "range", "mean", "std", "var", "median"]
    for class_, var in (("k", ["i", "x"]), ([], ["i"]), ("k", ["m"])):
        plain = ag.means(df, class_, var, [s for s in stats if s != "median"], missing=True)
        full = ag.means(df, class_, var, stats, missing=True)
        kinds = dict(full.dtypes)
        assert all(kinds[n] == t for n, t in plain.dtypes)
        want = {(r.k if class_ else 0): r.asDict() for r in plain.collect()}
        for r in full.collect():
            key = r.k if class_ else 0
            mine = [row for k, row in groups.items() if k == key] if class_ else list(groups.values())
            for n, value in want.pop(key).items():
                assert r[n] == (pytest.approx(value) if isinstance(value, float) else value), (key, n)
            for v in var:
                column = [row["ixm".index(v)] for g in mine for row in g]
                assert r[f"{v}_median"] == pytest.approx(quantile(column, 0.5))
                if r[f"{v}_std"] is not None:
                    assert r[f"{v}_std"] == pytest.approx(spread(column), abs=1e-9)
        assert not want


def test_quantiles_read_their_table_once(spark, tmp_path):
    spark.range(100).selectExpr("id % 3 AS k", "id AS i", "id * 0.5D AS x").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    plan = ag.means(df, "k", ["i"], ["n", "std", "median"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1
    both = ag.exact_quantiles(df, "k", {"a": ("i", 0.5), "b": ("x", 0.5)})._jdf.queryExecution().optimizedPlan().toString()
    assert both.count("Relation [") == 1


def test_rule_log(spark, tmp_path):
    df = spark.createDataFrame([(1, 5.0), (2, -1.0), (3, None)], "id int, v double")
    rules, log = {"positive": "v > 0", "id": "id IS NOT NULL"}, str(tmp_path / "log")
    for _ in range(2):  # the repeated run replaces itself
        ql.write_checked(df, rules, str(tmp_path / "a"), log, "first", drop=True)
    ql.write_checked(df.filter("id > 5"), rules, str(tmp_path / "b"), log, "none")
    ql.write_checked(df.limit(0), rules, str(tmp_path / "c"), log, "nothing", batch=7)
    assert rows(spark.read.parquet(str(tmp_path / "a"))) == [(1, 5.0)]
    assert rows(ql.read_log(spark, log).select("run", "batch", "check", "violations", "rows", "passed")) == [
        ("first", 0, "id", 0, 3, True), ("first", 0, "positive", 2, 3, False), ("none", 0, "id", 0, 0, True), ("none", 0, "positive", 0, 0, True),
        ("nothing", 7, "id", 0, 0, True), ("nothing", 7, "positive", 0, 0, True),
    ]
