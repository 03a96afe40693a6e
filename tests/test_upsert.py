"""The keyed table under change streams, against a plain dictionary."""

import random
import re

import pytest

from stepwise.streaming import changes as ch
from stepwise.streaming import streams as st
from stepwise.streaming import upsert as up

SCHEMA = "k int, seq int, tie int, op string, v int"


def feed(seed, n=60, keys=9):
    r = random.Random(seed)
    return [(r.choice([None, *range(keys)]), r.randrange(20), i, r.choice(["put", "put", "del"]), r.randrange(100)) for i in range(n)]


def plain(rows):
    best = {}
    for row in rows:
        if row[0] not in best or row[1:3] > best[row[0]][1:3]:
            best[row[0]] = row
    return sorted((r for r in best.values() if r[3] != "del"), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_waves_in_any_order_with_repeats(spark, tmp_path, seed):
    rows = feed(seed)
    table = up.KeyedTable(str(tmp_path / "t"), "k", ["seq", "tie"], "op = 'del'", 4)
    waves = [rows[20:40], rows[:20], rows[40:], rows[10:30]]
    done = []
    for number, wave in enumerate(waves):
        table.apply(spark.createDataFrame(wave, SCHEMA), number)
        done += wave
        assert got(table.read(spark)) == plain(done)
    table.apply(spark.createDataFrame([(1, 99, 0, "put", 5)], SCHEMA), 2)  # a batch id that was committed
    assert got(table.read(spark)) == plain(rows)
    assert got(table.read(spark, 0)) == plain(waves[0])
    assert table.batches(spark) == [0, 1, 2, 3]


def test_only_touched_buckets_move(spark, tmp_path):
    table = up.KeyedTable(str(tmp_path / "t"), "k", ["seq", "tie"], None, 8)
    table.apply(spark.createDataFrame([(k, 0, 0, "put", k) for k in range(200)], SCHEMA), 0)
    before = table.commit(spark)["folders"]
    table.apply(spark.createDataFrame([(7, 1, 0, "put", -1), (7, 2, 0, "put", -2)], SCHEMA), 1)
    after = table.commit(spark)["folders"]
    assert len(before) == 8 and sum(before[b] != after[b] for b in before) == 1
    assert {r["k"]: r["v"] for r in table.read(spark).collect()} == {k: -2 if k == 7 else k for k in range(200)}
    table.apply(spark.createDataFrame([], SCHEMA), 2)
    assert table.commit(spark)["folders"] == after


def test_a_broken_batch_is_applied_again(spark, tmp_path, monkeypatch):
    table = up.KeyedTable(str(tmp_path / "t"), "k", ["seq", "tie"], "op = 'del'", 3)
    rows = feed(5)
    table.apply(spark.createDataFrame(rows[:30], SCHEMA), 0)

    def broken(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(up.KeyedTable, "_write_commit", broken)
        with pytest.raises(OSError):
            table.apply(spark.createDataFrame(rows[30:], SCHEMA), 1)
    assert got(table.read(spark)) == plain(rows[:30])
    table.apply(spark.createDataFrame(rows[30:], SCHEMA), 1)
    assert got(table.read(spark)) == plain(rows)
    table.apply(spark.createDataFrame([(1, 50, 0, "put", 1)], SCHEMA), 2)
    table.forget(spark, 1)
    assert got(table.read(spark)) == plain([*rows, (1, 50, 0, "put", 1)])
    assert table.batches(spark) == [2]


def test_later_columns(spark, tmp_path):
    table = up.KeyedTable(str(tmp_path / "t"), ["k"], ["seq"], None, 2)
    table.apply(spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], "k int, seq int, x string"), 0)
    table.apply(spark.createDataFrame([(2, 2, "c", 5)], "k int, seq int, x string, y int"), 1)
    assert {(r["k"], r["x"], r["y"]) for r in table.read(spark).select("k", "x", "y").collect()} == {(1, "a", None), (2, "c", 5)}


def test_streamed_upsert_and_first_rows(spark, tmp_path):
    rows = [r for r in feed(7, 90) if r[0] is not None]
    folder = str(tmp_path / "feed")
    table = up.KeyedTable(str(tmp_path / "t"), "k", ["seq", "tie"], "op = 'del'", 4)
    first = up.first_rows(str(tmp_path / "f"), "k", ["seq", "tie"], 4)
    for part in (rows[50:], rows[:50]):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        for target, place in ((table, "c1"), (first, "c2")):
            up.upsert_stream(st.stream_files(spark, folder, "parquet", SCHEMA), target, str(tmp_path / place)).awaitTermination()
    assert got(table.read(spark)) == plain(rows)
    want = {}
    for row in sorted(rows, key=lambda r: r[1:3]):
        want.setdefault(row[0], row)
    assert got(first.read(spark)) == sorted(want.values(), key=repr)


def test_the_log_is_read_past_the_snapshot_only(spark, tmp_path):
    rows = feed(8)
    log, place, snap = (str(tmp_path / x) for x in ("log", "cp", "snap"))
    for part in (rows[30:], rows[:30]):
        spark.createDataFrame(part, SCHEMA).write.mode("append").parquet(str(tmp_path / "feed"))
        ch.log_changes(st.stream_files(spark, str(tmp_path / "feed"), "parquet", SCHEMA), log, place).awaitTermination()
        if part is not rows[:30] and ch.last_batch(spark, log) == 0:
            state = ch.current_state(spark, log, "k", ["seq", "tie"])
            ch.write_snapshot(state, snap, ["k"])
    now = ch.current_state(spark, log, "k", ["seq", "tie"], "op = 'del'", snap, after=0)
    assert got(now) == plain(rows)
    plan = now._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"__batch#\d+ > 0", plan)
