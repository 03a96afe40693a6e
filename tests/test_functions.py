"""Scalar functions, formats, text parsing and row operators on edge values."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from stepwise.functions import formats as fm
from stepwise.functions import scalars as sc
from stepwise.functions.missing import is_missing, missing_ge, missing_gt, missing_le, missing_lt
from stepwise.operators import project as pj
from stepwise.sources.lines import Field, LineSpec, infer_numeric, parse_lines


def one(spark, col, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]) if values else spark.range(1)
    return row.select(col.alias("x")).first().x


def day(text):
    return F.lit(text).cast("date")


@pytest.mark.parametrize(
    "unit, a, b, want",
    [
        ("day", "2024-01-01", "2024-03-01", 60), ("week", "2024-01-06", "2024-01-07", 1), ("week", "2024-01-07", "2024-01-13", 0),
        ("week", "2024-01-14", "2024-01-13", -1), ("month", "2024-01-31", "2024-02-01", 1), ("month", "2024-02-01", "2024-02-29", 0),
        ("month", "2024-03-01", "2023-12-31", -3), ("qtr", "2023-12-31", "2024-01-01", 1), ("year", "2023-12-31", "2024-01-01", 1),
    ],
)
def test_intck(spark, unit, a, b, want):
    assert one(spark, sc.intck(unit, day(a), day(b))) == want


@pytest.mark.parametrize(
    "unit, d, n, align, want",
    [
        ("month", "2024-01-31", 1, "b", "2024-02-01"), ("month", "2024-01-31", 1, "e", "2024-02-29"), ("month", "2024-01-31", 1, "s", "2024-02-29"),
        ("month", "2024-03-10", -1, "m", "2024-02-15"), ("qtr", "2024-05-10", 0, "b", "2024-04-01"), ("year", "2024-05-10", -1, "e", "2023-12-31"),
        ("week", "2024-01-10", 0, "b", "2024-01-07"), ("week", "2024-01-07", -1, "e", "2024-01-06"), ("day", "2024-02-28", 2, "b", "2024-03-01"),
    ],
)
def test_intnx(spark, unit, d, n, align, want):
    assert str(one(spark, sc.intnx(unit, day(d), n, align))) == want


def test_text(spark):
    assert one(spark, sc.scan(F.lit("  one, two;three "), 2)) == "two"
    assert one(spark, sc.scan(F.lit("a-b-c"), -1)) == "c"
    assert one(spark, sc.scan(F.lit("a-b"), 5)) is None and one(spark, sc.scan(F.lit("abc"), 2)) is None
    assert one(spark, sc.scan(F.lit("abc"), -1)) == "abc" and one(spark, sc.scan(F.lit(" é, ñü. "), -2)) == "é"
    assert one(spark, sc.scan(F.lit("x|y z"), 2, "|")) == "y z" and one(spark, sc.scan(F.lit(" .. "), 1)) is None
    assert one(spark, sc.catx("; ", F.lit(" a "), F.lit("  "), F.lit(None).cast("string"), F.lit("b"))) == "a; b"
    assert one(spark, sc.cats(F.lit(" a "), F.lit(None).cast("string"), F.lit(" b"))) == "ab"
    assert one(spark, sc.length(F.lit("ab   "))) == 2 and one(spark, sc.length(F.lit("  "))) == 0
    assert one(spark, sc.substr(F.lit("abcdef"), -2)) == "ef" and one(spark, sc.substr(F.lit("abcdef"), 2, 3)) == "bcd"
    assert one(spark, sc.pick(F.lit(-1), ["a", "b", "c"])) == "c"
    assert one(spark, sc.truncate(F.lit("abcdef"), 4)) == "abcd"
    assert one(spark, sc.yes_no(F.lit(None).cast("boolean"))) == "N"


def test_put_and_input(spark):
    assert one(spark, sc.put_as(F.lit(7), "z3.")) == "007"
    assert one(spark, sc.put_as(F.lit(1234567.5), "dollar12.2")) == "$1,234,567.50"
    assert one(spark, sc.put_as(F.lit(-1234.5), "dollar12.2")) == "-$1,234.50"
    assert one(spark, sc.put_as(F.lit(0.1234), "percent8.2")) == "12.34%"
    assert one(spark, sc.put_as(F.lit(-0.5), "percent8.2")) == "(50.00%)"
    assert one(spark, sc.put_as(day("2024-03-05"), "date9.")) == "05MAR2024"
    assert one(spark, sc.put_as(day("2024-03-05"), "mmddyy10.")) == "03/05/2024"
    assert str(one(spark, sc.input_as(F.lit("2024-03-05"), "yymmdd10."))) == "2024-03-05"
    assert str(one(spark, sc.input_as(F.lit("05MAR2024"), "date9."))) == "2024-03-05"
    assert one(spark, sc.input_as(F.lit("02/30/2024"), "mmddyy10.")) is None
    assert one(spark, sc.input_as(F.lit("$1,234.5"), "comma12.2")) == 1234.5
    assert one(spark, sc.input_as(F.lit("."), "best12.")) is None
    assert one(spark, sc.input_as(F.lit("abc"), "best12.")) is None
    assert str(one(spark, sc.date_literal("31DEC9999"))) == "9999-12-31"
    with pytest.raises(ValueError):
        sc.put_as(F.lit(1), "roman5.")


def test_missing_order(spark):
    none = F.lit(None).cast("int")
    assert one(spark, missing_gt(F.lit(-5), none)) is True
    assert one(spark, missing_gt(none, none)) is False and one(spark, missing_ge(none, none)) is True
    assert one(spark, missing_lt(none, F.lit(-5))) is True and one(spark, missing_le(F.lit(1), none)) is False
    assert one(spark, is_missing(F.lit("  "))) is True and one(spark, is_missing(F.lit(0))) is False


def test_formats(spark):
    age = fm.ValueFormat("age", ranges=(fm.Range(None, 17, "Child"), fm.Range(18, 64, "Adult"), fm.Range(65, None, "Senior")), other="?")
    got = [one(spark, age.label(F.lit(v).cast("double"))) for v in (-1, 17, 17.5, 18, 65, None)]
    assert got == ["Child", "Child", "?", "Adult", "Senior", "?"]
    rows = [
        dict(fmtname="$GENDER", start="M", end="", label="Male", type="C"), dict(fmtname="$GENDER", start="F", end="F", label="Female", type="C"),
        dict(fmtname="SEVERITY", start="1", end="", label="Minor", type="N"), dict(fmtname="SEVERITY", start="2", end="HIGH", label="Worse", type="N"),
        dict(fmtname="SEVERITY", start=".", end="", label="None", type="N"), dict(fmtname="SEVERITY", start="OTHER", end="", label="Odd", type="N"),
    ]
    reg = fm.build_formats(rows)
    assert reg.names() == ["$gender", "severity"] and "severity." in reg
    assert [one(spark, reg.put(F.lit(v).cast("double"), "SEVERITY.")) for v in (1, 2, 9, None, 0)] == ["Minor", "Worse", "Worse", "None", "Odd"]
    assert one(spark, reg.put(F.lit("X"), "$gender")) == "X"


def test_load_formats_and_big_lookup(spark, tmp_path):
    (tmp_path / "f.csv").write_text("FMTNAME,START,END,LABEL,TYPE\n$G,M,,Male,C\n$G,F,,Female,C\n")
    reg = fm.load_formats(spark, str(tmp_path / "f.csv"))
    assert one(spark, reg.put(F.lit("F"), "$g")) == "Female"
    big = fm.ValueFormat("big", {i: f"v{i}" for i in range(200)}, other="none")
    out = fm.put_format(spark.range(198, 202), "id", big, "label")
    assert [r.label for r in out.orderBy("id").collect()] == ["v198", "v199", "none", "none"]


def parse(spark, text, spec):
    good, bad = parse_lines(spark.createDataFrame([(x,) for x in text], "value string"), spec)
    return [tuple(r) for r in good.collect()], [tuple(r) for r in bad.collect()]


def test_lines_blank_separated(spark):
    spec = LineSpec([Field("id"), Field("name"), Field("n", "number")])
    good, bad = parse(spark, ['001 "John Smith" 5', "002  Jane .", "", "* note", "003 too many values 1", "004 Al x"], spec)
    assert good == [("001", "John Smith", 5.0), ("002", "Jane", None)]
    assert bad == [("003 too many values 1", "expected 3 values, found 5"), ("004 Al x", "n is not a valid number")]


def test_lines_delimited(spark):
    spec = LineSpec([Field("a"), Field("d", "mmddyy10"), Field("b", length=3)], delimiter=",")
    good, bad = parse(spark, ['"x, y",01/02/2024,abcdef', ",.,", "a,13/13/2024,b", "a|b"], spec)
    assert [(a, str(x) if x else None, b) for a, x, b in good] == [("x, y", "2024-01-02", "abc"), (None, None, None)]
    assert [r for _, r in bad] == ["d is not a valid mmddyy10", "expected 3 values, found 1"]
    pipe = LineSpec([Field("a"), Field("b")], delimiter="|")
    assert parse(spark, ["1|2", "3|"], pipe)[0] == [("1", "2"), ("3", None)]


def test_lines_fixed_width(spark):
    spec = LineSpec([Field("id", "text", 1, 5), Field("name", "text", 6, 20), Field("n", "number", 26, 6)])
    good, bad = parse(spark, ["00001John Smith              12", "00002Jane"], spec)
    assert good == [("00001", "John Smith", 12.0), ("00002", "Jane", None)] and bad == []


def test_infer_numeric(spark):
    df = spark.createDataFrame([(1.0, 1.5, 3e9, None), (2.0, 2.0, 1.0, None)], "a double, b double, c double, d double")
    assert [t for _, t in infer_numeric(df).dtypes] == ["int", "double", "bigint", "double"]


def test_case_block_keeps_unset(spark):
    df = spark.createDataFrame([(1, "old"), (2, "old"), (3, "old")], "i int, s string")
    out = pj.case_block(df, [("i = 1", {"s": "new", "t": 1}), ("i = 2", {"t": 2})])
    assert sorted(tuple(r) for r in out.collect()) == [(1, "new", 1), (2, "old", 2), (3, "old", None)]


def test_rows_from_rows(spark):
    df = spark.createDataFrame([(1, 3), (2, 0)], "id int, n int")
    assert sorted((r.id, r.i) for r in pj.expand(df, 1, "n", "i").collect()) == [(1, 1), (1, 2), (1, 3)]
    loan = pj.iterate(
        spark.range(1), 3, {"interest": 0.0, "principal": 100000.0},
        lambda s, i: {"interest": s["principal"] * 0.05, "principal": s["principal"] * 1.05}, "year",
    )
    got = [(r.year, round(r.interest, 2), round(r.principal, 2)) for r in loan.orderBy("year").collect()]
    assert got == [(1, 5000.0, 105000.0), (2, 5250.0, 110250.0), (3, 5512.5, 115762.5)]
    months = spark.createDataFrame([(10.0, 20.0, 40.0)], "jan double, feb double, total double")
    out = pj.array_map(months, ["jan", "feb"], lambda c: c / F.col("total"), ["jan_norm", "feb_norm"]).first()
    assert (out.jan_norm, out.feb_norm, out.jan) == (0.25, 0.5, 10.0)


def test_delete_and_routes(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 50)], "id int, v int")
    assert sorted(r.id for r in pj.delete_where(df, "v > 10").collect()) == [1, 2]
    assert sorted(r.id for r in pj.subset(df, "v > 10").collect()) == [3]
    parts = pj.route(df, [("big", "v > 10")], tee="all")
    assert {k: sorted(r.id for r in p.collect()) for k, p in parts.items()} == {"big": [3], "all": [1, 2, 3]}


@pytest.mark.parametrize("size", [50, 51, 120])
def test_formats_of_any_size_agree(spark, size):
    fmt = fm.ValueFormat("n", {float(i): f"label {i}" for i in range(size)}, (), None, "other")
    out = fm.put_format(spark.range(-1, size + 1).selectExpr("CAST(id AS INT) AS v"), "v", fmt, "label").collect()
    assert {r["v"]: r["label"] for r in out} == {i: f"label {i}" if 0 <= i < size else "other" for i in range(-1, size + 1)}


@pytest.mark.parametrize(
    "value, fmt, want",
    [(3.7, "z5.", "00004"), (0.125, "dollar8.2", "$0.13"), (2.5, "comma8.", "3"), (2.5, "8.", "3"), (1234.565, "8.2", "1234.57"), (-0.125, "percent8.", "(13%)")],
)
def test_numbers_round_half_up(spark, value, fmt, want):
    assert one(spark, sc.put_as(F.lit(value), fmt)) == want


def test_more_informats(spark):
    assert one(spark, sc.input_as(F.lit(" 12.50"), "8.2")) == 12.5
    assert str(one(spark, sc.input_as(F.lit("03/05/24"), "mmddyy8."))) == "2024-03-05"
    assert str(one(spark, sc.input_as(F.lit("05MAR2024:13:45:10"), "datetime20."))) == "2024-03-05 13:45:10"
    assert one(spark, sc.put_as(sc.input_as(F.lit("05mar2024:13:45:10"), "datetime18."), "datetime20.")) == "05MAR2024:13:45:10"
    assert one(spark, sc.input_as(F.lit("05XXX2024:13:45:10"), "datetime20.")) is None


def first_match(fmt, v):
    if v is None:
        return fmt.missing if fmt.missing is not None else fmt.other
    if v in fmt.values:
        return fmt.values[v]
    for r in fmt.ranges:
        low = r.low is None or (v > r.low if r.low_open else v >= r.low)
        high = r.high is None or (v < r.high if r.high_open else v <= r.high)
        if low and high:
            return r.label
    return fmt.other


@pytest.mark.parametrize("how", ["search", "merge", None])
@pytest.mark.parametrize("seed", [1, 2])
def test_range_index_with_overlaps(spark, skew_mode, how, seed):
    r = random.Random(seed)
    ranges = []
    for i in range(80):
        a, b = sorted(r.choice([None, r.randrange(60) / 2]) or r.randrange(60) / 2 for _ in range(2))
        low, high = (None if r.random() < 0.04 else a), (None if r.random() < 0.04 else b)
        ranges.append(fm.Range(low, high, f"r{i}", r.random() < 0.5, r.random() < 0.5))
    fmt = fm.ValueFormat("f", {3.0: "three", 40.0: "forty"}, tuple(ranges[:20] if seed == 1 else ranges), "none", "?")
    values = [None, None, *[x / 4 for x in range(-8, 140)], 5.0, 5.0, 5.0, 5.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v double")
    out = {x["id"]: x["label"] for x in fm.put_format(df, "v", fmt, "label", how).collect()}
    assert out == {i: first_match(fmt, v) for i, v in enumerate(values)}


@pytest.mark.parametrize("how", ["search", "merge"])
def test_text_and_date_ranges(spark, how):
    text = fm.ValueFormat("t", ranges=(fm.Range("B", "D", "b-d", high_open=True), fm.Range("D", None, "d-")), other="a")
    df = spark.createDataFrame([("A",), ("B",), ("CZ",), ("D",), ("é",), (None,)], "v string")
    assert [r[0] for r in fm.put_format(df, "v", text, "x", how).orderBy("v").select("x").collect()] == ["a", "a", "b-d", "b-d", "d-", "d-"]
    day = dt.date(2024, 1, 10)
    days = fm.ValueFormat("d", ranges=(fm.Range(None, day, "old", high_open=True), fm.Range(day, day, "that")), missing="-", other="new")
    df = spark.sql("SELECT explode(array(DATE'2023-01-01', DATE'2024-01-10', DATE'2025-01-01', NULL)) AS v")
    assert {str(r["v"]): r["x"] for r in fm.put_format(df, "v", days, "x", how).collect()} == {
        "2023-01-01": "old", "2024-01-10": "that", "2025-01-01": "new", "None": "-",
    }


@pytest.mark.parametrize("how", ["search", "merge"])
def test_range_tables(spark, how):
    ranges = spark.createDataFrame([(None, 0.0, "neg"), (0.0, 5.0, "low"), (5.0, 5.0, "five"), (7.0, None, "high"), (9.0, 8.0, "empty")], "low double, high double, label string")
    ranges = ranges.selectExpr("*", "label = 'low' AS low_open", "label = 'low' AS high_open")
    values = [-3.0, 0.0, 0.1, 4.9, 5.0, 6.0, 7.0, 1e9, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = {r["v"]: r["x"] for r in fm.classify_ranges(df, "v", ranges, "x", "gap", "none", how).collect()}
    assert got == dict(zip(values, ["neg", "neg", "low", "low", "five", "gap", "high", "high", "none"]))
    with pytest.raises(ValueError, match="overlap"):
        fm.classify_ranges(df, "v", ranges.unionByName(spark.sql("SELECT 4D AS low, 6D AS high, 'x' AS label, false AS low_open, false AS high_open")), "x")
    assert fm.classify_ranges(df, "v", ranges.limit(0), "x", "gap", how=how).where("x <> 'gap'").count() == 0


def _widest(node):
    """Names of the array and struct columns of a plan's nodes, subqueries apart."""
    found = {a.name() for a in (node.output().apply(i) for i in range(node.output().size())) if a.dataType().typeName() in ("array", "struct")}
    return found.union(*(_widest(node.children().apply(i)) for i in range(node.children().size())))


def test_searched_index_is_no_column(spark):
    # A column with the index copies it into every row: 36 million rows with 8 MB each.
    ranges = spark.range(0, 3000).selectExpr("CAST(id * 3 AS DOUBLE) AS low", "CAST(id * 3 + 1 AS DOUBLE) AS high", "'r' || id AS label", "id % 2 = 0 AS low_open")
    df = spark.range(-10, 9100).selectExpr("CAST(id AS DOUBLE) AS v")
    got = fm.classify_ranges(df, "v", ranges, "x", "gap", how="search")
    assert not _widest(got._jdf.queryExecution().optimizedPlan())
    want = {float(v): f"r{v // 3}" for v in range(9000) if v % 3 == 1 or v % 6 == 3}
    assert {r["v"]: r["x"] for r in got.where("x <> 'gap'").collect()} == want
    assert got.count() == 9110


def test_lines_values_of_several_words(spark):
    spec = LineSpec([Field("id"), Field("name", words=True), Field("balance", "number")])
    good, bad = parse(spark, ["M0001 John Smith 120.50", "M0002 . 0", "M0003  Ann   van  Dyk .", "M0004 5", 'M0005 "A  B" C 1', "M6 x y"], spec)
    assert good == [
        ("M0001", "John Smith", 120.5), ("M0002", None, 0.0), ("M0003", "Ann van Dyk", None), ("M0005", "A  B C", 1.0)
    ]
    assert bad == [("M0004 5", "expected at least 3 values, found 2"), ("M6 x y", "balance is not a valid number")]
    two = LineSpec([Field("who", words=True), Field("sex"), Field("age", "number"), Field("town", words=True)])
    good, bad = parse(
        spark, ["John Smith Male 40 New York", "Jane F . Rome", "Al M 7 Route 66", "Bo M 1 2 3", "12 M 5 Oslo", "Al Bo M x Rome", "M 5 Oslo"], two
    )
    assert good == [
        ("John Smith", "Male", 40.0, "New York"), ("Jane", "F", None, "Rome"), ("Al", "M", 7.0, "Route 66"), ("12", "M", 5.0, "Oslo")
    ]
    assert bad == [
        ("Bo M 1 2 3", "several places for age"), ("Al Bo M x Rome", "no place for age"), ("M 5 Oslo", "expected at least 4 values, found 3")
    ]
    with pytest.raises(ValueError):
        LineSpec([Field("a", words=True), Field("b"), Field("c", words=True)])
    with pytest.raises(ValueError):
        LineSpec([Field("a", words=True)], delimiter=",")


def test_stored_routes(spark, tmp_path):
    df = spark.createDataFrame([(1, 5), (2, 20), (3, None)], "id int, v int")
    rules = [("big", "v > 10"), ("odd", "v = 77")]
    for frame in (df, df.limit(0), df):
        parts = pj.route_stored(frame, rules, str(tmp_path / "r"), default="rest", tee=["all", "rest"])
        plain = pj.route(frame, rules, default="rest", tee=["all", "rest"])
        assert list(parts) == list(plain) == ["big", "odd", "rest", "all"]
        for name in parts:
            assert parts[name].columns == ["id", "v"]
            assert sorted(map(tuple, parts[name].collect()), key=str) == sorted(map(tuple, plain[name].collect()), key=str)
    assert sorted(r.id for r in parts["rest"].collect()) == [1, 1, 2, 3, 3]
