"""Merges against a record-by-record Python merge."""

import random

import pytest

from stepwise.operators.merge import KEEP, merge_by, merge_many


def py_merge(left, right, keep):
    """Sequential merge of (k, i, x, a) with (k, i, x, b) rows; x is common."""
    keys = {r[0] for r in left} | {r[0] for r in right}
    out = []
    for k in keys:
        ls = sorted([r for r in left if r[0] == k], key=lambda r: r[1])
        rs = sorted([r for r in right if r[0] == k], key=lambda r: r[1])
        ina, inb = bool(ls), bool(rs)
        if not keep(ina, inb):
            continue
        x = a = b = None
        for i in range(max(len(ls), len(rs))):
            if i < len(ls):
                x, a = ls[i][2], ls[i][3]
            if i < len(rs):
                x, b = rs[i][2], rs[i][3]
            out.append((k, x, a, b, int(ina), int(inb)))
    return sorted(out, key=str)


KEEPS = {
    None: lambda a, b: True,
    "a": lambda a, b: a,
    "b": lambda a, b: b,
    "a and b": lambda a, b: a and b,
    "a and not b": lambda a, b: a and not b,
    "not a and b": lambda a, b: b and not a,
}


@pytest.mark.parametrize("keep", list(KEEPS))
def test_sequential(spark, skew_mode, keep):
    rnd = random.Random(11)

    def side(keys, tag, n):
        return [(rnd.choice(keys), i, rnd.choice([None, f"{tag}x{i}"]), f"{tag}{i}") for i in range(n)]

    left = side([1, 1, 1, 2, 3, None], "l", 16)
    right = side([1, 2, 2, 2, 4, None], "r", 16)
    l = spark.createDataFrame(left, "k int, i int, x string, a string")
    r = spark.createDataFrame(right, "k int, j int, x string, b string")
    got = merge_by(l, r, "k", keep, ("ina", "inb"), "sequential", ["i"], ["j"])
    rows = sorted([(g.k, g.x, g.a, g.b, g.ina, g.inb) for g in got.collect()], key=str)
    assert rows == py_merge(left, right, KEEPS[keep])


@pytest.mark.parametrize("keep", list(KEEPS))
def test_one_to_many_join(spark, skew_mode, keep):
    left = [(k, i, f"lx{i}", f"l{i}") for i, k in enumerate([1, 1, 1, 1, 1, 2, 3, None, None])]
    right = [(1, 0, None, "r1"), (2, 0, "rx2", "r2"), (None, 0, "rxn", "rn"), (9, 0, "rx9", "r9")]
    l = spark.createDataFrame(left, "k int, i int, x string, a string")
    r = spark.createDataFrame(right, "k int, j int, x string, b string")
    got = merge_by(l, r, "k", keep, ("ina", "inb"))
    want = []
    for k in {1, 2, 3, 9, None}:
        ls, rs = [q for q in left if q[0] == k], [q for q in right if q[0] == k]
        if not KEEPS[keep](bool(ls), bool(rs)):
            continue
        for a in ls or [None]:
            b = rs[0] if rs else None
            want.append((k, b[2] if b else a[2], a[3] if a else None, b[3] if b else None, int(bool(ls)), int(bool(rs))))
    rows = [(g.k, g.x, g.a, g.b, g.ina, g.inb) for g in got.collect()]
    assert sorted(rows, key=str) == sorted(want, key=str)


def test_three_tables(spark):
    a = spark.createDataFrame([(1, "a1"), (2, "a2"), (3, "a3")], "k int, a string")
    b = spark.createDataFrame([(2, "b2"), (3, "b3"), (4, "b4")], "k int, b string")
    c = spark.createDataFrame([(3, "c3"), (5, "c5")], "k int, c string")
    got = merge_many([a, b, c], "k", lambda x, y, z: x & ~z, ["ia", "ib", "ic"])
    assert sorted(map(tuple, got.collect())) == [(1, "a1", None, None, 1, 0, 0), (2, "a2", "b2", None, 1, 1, 0)]
    assert merge_many([a, b, c], "k").count() == 5


def test_plan_narrows(spark):
    a = spark.createDataFrame([(1, "a1")], "k int, a string")
    plan = merge_by(a, a.withColumnRenamed("a", "b"), "k", "a and b")._jdf.queryExecution().optimizedPlan().toString()
    assert "FullOuter" not in plan


def test_unknown_keep(spark):
    a = spark.createDataFrame([(1,)], "k int")
    with pytest.raises(ValueError):
        merge_by(a, a, "k", "a xor b")


@pytest.mark.parametrize("keep", sorted(KEEP, key=str))
def test_profile_wider_than_its_frame(spark, skew_mode, keep):
    """Heavy keys of a profile that the frame itself lacks lose no rows."""
    wide = spark.createDataFrame([(1, i) for i in range(6)] + [(2, 9), (None, 1)] + [(3, i) for i in range(5)], "k long, v long")
    left = wide.where("k IS NULL OR k <> 1")
    right = spark.createDataFrame([(1, 1), (1, 2), (2, 3), (4, 4), (None, 5)] + [(3, i) for i in range(4)], "k long, w long")
    got = merge_by(left, right, "k", keep, ("a", "b"), profile_left=wide)
    rows = lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
    both = [(k, v, w, 1, 1) for k, v in rows(left) for q, w in rows(right) if k == q]
    keys = [{r[0] for r in rows(df)} for df in (left, right)]
    only = [[(k, v, None, 1, 0) for k, v in rows(left) if k not in keys[1]], [(k, None, w, 0, 1) for k, w in rows(right) if k not in keys[0]]]
    parts = {None: both + only[0] + only[1], "a or b": both + only[0] + only[1], "a": both + only[0], "b": both + only[1], "a and b": both, "a and not b": only[0], "not a and b": only[1], "b and not a": only[1]}
    assert rows(got.select("k", "v", "w", "a", "b")) == sorted(parts[keep], key=repr)


def test_group_size_counts_the_frame(spark, skew_mode):
    from stepwise.operators.bygroup import group_size

    wide = spark.createDataFrame([(1, i) for i in range(10)] + [(2, 1), (None, 1)], "k long, v long")
    got = group_size(wide.where("v < 5"), "k", profile=wide).collect()
    assert sorted(((r["k"], r["group_size"]) for r in got), key=repr) == sorted([(1, 5)] * 5 + [(2, 1), (None, 1)], key=repr)


@pytest.mark.parametrize("unique", [False, True, (True, False, True, True)])
def test_many_tables_in_one_pass(spark, unique):
    rnd = random.Random(4)
    tables, plain = [], []
    for i in range(4):
        rows = {k: (rnd.choice([None, i * 10 + 1]), f"{i}{k}") for k in [None, *range(8)] if rnd.random() < 0.6}
        plain.append(rows)
        tables.append(spark.createDataFrame([(k, *v) for k, v in rows.items()], f"k int, x int, y{i} string"))
    got = merge_many(tables, "k", lambda a, b, c, d: a | ~d, ["a", "b", "c", "d"], unique)
    want = []
    for k in {k for p in plain for k in p}:
        here = [k in p for p in plain]
        if here[0] or not here[3]:
            x = [p[k][0] for p in plain if k in p][-1]
            ys = [p[k][1] if k in p else None for p in plain]
            want.append((k, x, *ys, *map(int, here)))
    rows = [(g.k, g.x, g.y0, g.y1, g.y2, g.y3, g.a, g.b, g.c, g.d) for g in got.collect()]
    assert sorted(rows, key=str) == sorted(want, key=str)


def test_repeated_key_of_a_unique_table(spark):
    once = spark.createDataFrame([(1, "a")], "k int, x string")
    twice = spark.createDataFrame([(1, "b"), (1, "c")], "k int, y string")
    with pytest.raises(Exception, match="repeats"):
        merge_many([once, twice], "k", unique=True).collect()
    assert sorted(r.y for r in merge_many([once, twice], "k", unique=(True, False)).collect()) == ["b", "c"]


def test_one_scan_and_one_shuffle_per_sequential_merge(spark, tmp_path):
    for name in ("l", "r"):
        spark.range(50).selectExpr("id % 7 AS k", f"id AS {name}").write.parquet(str(tmp_path / name))
    l, r = (spark.read.parquet(str(tmp_path / n)) for n in ("l", "r"))
    plan = merge_by(l, r, "k", pairing="sequential", order_left=["l"], order_right=["r desc"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 and plan.count("Exchange ") == 1
    many = merge_many([l.groupBy("k").count(), r.groupBy("k").max("r")], "k", unique=True)
    assert many.count() == 7
