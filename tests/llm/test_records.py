"""Preference formatting, WARC archives and the pipeline."""

import hashlib
import os
from collections import defaultdict

import pytest

from stepwise.llm import preference, warc
from stepwise.llm.queries import ORACLES, QUERIES
from stepwise.session import shared_dir

from helpers import frame, prose, rows_of, table
from test_texts import plain_clean, plain_near

TURNS = "p long, turn long, role string, text string, prompt string, side int, c string"


def conversations(spark, rows):
    return preference.turns(table(spark, [(*r, "x", 7, "y") for r in rows], TURNS), "p")


CHOSEN = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "good"), (1, 2, "user", "more"), (1, 3, "assistant", "yes"),
    (2, 0, "user", "same"), (2, 1, "assistant", "same"),
    (3, 1, None, None), (3, 0, "system", "be ä\n日"), (3, 2, "assistant", ""), (3, 2, "assistant", ""),
    (None, 0, "user", "lost"), (5, None, "user", "first"), (5, 0, "assistant", "then"),
]
REJECTED = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "good"), (1, 2, "user", "more"), (1, 3, "assistant", "no"), (1, 4, "user", "?"),
    (2, 0, "user", "same"), (2, 1, "assistant", "same"),
    (4, 0, "user", "only here"), (5, 0, "assistant", "then"),
]


def plain_pairs(chosen, rejected):
    sides = [defaultdict(list), defaultdict(list)]
    for side, rows in zip(sides, (chosen, rejected)):
        for p, turn, role, text in rows:
            if p is not None:
                side[p].append((turn is not None, turn or 0, role or "user", text or ""))
    show = lambda turns: "".join(f"<|{r}|>\n{t}<|end|>\n" for *_, r, t in turns)
    out = {}
    for p in {*sides[0], *sides[1]}:
        a, b = sorted(sides[0][p]), sorted(sides[1][p])
        n = 0
        while n < min(len(a), len(b)) and a[n][2:] == b[n][2:]:
            n += 1
        spans = []
        for rest in (a[n:], b[n:]):
            at, own = 0, []
            for *_, r, t in rest:
                if r == "assistant":
                    own.append((at + len(r) + 5, at + len(r) + 5 + len(t) + 7))
                at += len(f"<|{r}|>\n{t}<|end|>\n")
            spans.append(own)
        out[p] = (n, show(a[:n]), show(a[n:]), show(b[n:]), *spans)
    return out


def test_preferences(spark):
    got = preference.format_preferences(conversations(spark, CHOSEN), conversations(spark, REJECTED)).collect()
    plain = lambda spans: [(s["start"], s["stop"]) for s in spans]
    rows = {r["pair_id"]: (*r[1:5], plain(r["chosen_spans"]), plain(r["rejected_spans"])) for r in got}
    assert rows == plain_pairs(CHOSEN, REJECTED)
    first = next(r for r in got if r["pair_id"] == 1)
    assert [first["chosen"][a:b] for a, b in plain(first["chosen_spans"])] == ["yes<|end|>"]
    empty = conversations(spark, [])
    assert preference.format_preferences(empty, empty).count() == 0


def test_preferences_run_no_python(spark):
    plan = preference.format_preferences(conversations(spark, CHOSEN), conversations(spark, REJECTED))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


def plain_spliced(rows):
    """Each conversation's first turns, continued by the next one of its block of ids."""
    talks = defaultdict(list)
    for p, turn, role, text in rows:
        if p is not None:
            talks[p].append((turn is not None, turn or 0, role or "user", text or ""))
    talks = {p: [t[2:] for t in sorted(turns)] for p, turns in talks.items()}
    out = {}
    for p, own in talks.items():
        block = sorted(q for q in talks if q // 1024 == p // 1024)
        partner = block[(block.index(p) + 1) % len(block)]
        kept = int(hashlib.md5(str(p).encode()).hexdigest()[:4], 16) % len(own)
        out[p] = own[:kept] + (talks[partner][kept:] if partner != p else [])
    return {(p, i + 1, *turn) for p, turns in out.items() for i, turn in enumerate(turns)}


def test_spliced_conversations(spark):
    rows = [(p, t, ("user", "assistant")[t % 2], f"{p} says {t}") for p in (0, 3, 4, 9, 1023, 1024, 1030, 5000, -2) for t in range(1 + abs(p) * 7 % 6)]
    rows += [(4, 0, "user", "another first"), (9, None, None, None), (None, 0, "user", "lost"), (3, 1, "user", "tie"), (3, 1, "user", "tie")]
    got = preference.spliced(conversations(spark, rows)).collect()
    assert len(got) == len({*got})
    assert {tuple(r) for r in got} == plain_spliced(rows)
    chosen = conversations(spark, rows)
    pairs = preference.format_preferences(chosen, preference.spliced(chosen))
    assert len({r["prompt_turns"] for r in pairs.collect()}) > 2
    assert not any(word in pairs._jdf.queryExecution().executedPlan().toString() for word in ("Python", "Arrow", "Pandas"))
    assert preference.spliced(conversations(spark, [])).count() == 0


LONG = "x" * 150
PAGES = [(3, "http://a/\r\nInjected: 1", LONG), (1, "http://b/é", LONG), (2, None, LONG), (2, None, LONG), (4, "u", "short"), (5, "u", "short"), (6, "u", None), (7, "u", "a\r\n\r\nb"), (None, "u", LONG), (8, "u", "é" * 60)]


def pages(spark, rows):
    return table(spark, rows, "page_id long, url string, html string").selectExpr("*", "'c' AS digest", "1 AS header", "2 AS payload", "3 AS record_type")


def test_warc_round_trip(spark):
    folder = shared_dir(spark, "warc")
    warc.write_archive(pages(spark, PAGES), folder)
    bodies = {(t or "").encode() for *_, t in PAGES}
    stored = spark.read.parquet(f"{folder}/payloads").collect()
    assert sorted(bytes(r["payload"]) for r in stored) == sorted(bodies)
    records = warc.read_records(spark, folder)
    want = []
    first = {}
    for i, _, t in PAGES:
        if i is not None:
            body = (t or "").encode()
            first[body] = min(first.get(body, i), i)
    for i, _, t in PAGES:
        body = (t or "").encode()
        again = len(body) >= 100 and i != first[body]
        want.append((i, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", first[body] if again else None))
    assert rows_of(warc.parse_records(records)) == sorted(want, key=repr)
    for r in records.collect():
        head, _, body = bytes(r["record"]).partition(b"\r\n\r\n")
        assert b"Injected: 1" not in head.split(b"\r\n") and body.endswith(b"\r\n\r\n")
        size = int(next(x for x in head.split(b"\r\n") if x.startswith(b"Content-Length: ")).split()[1])
        assert len(body) == size + 4


def test_warc_files(spark):
    folder = shared_dir(spark, "warc")
    warc.write_archive(pages(spark, PAGES), folder)
    records = warc.read_records(spark, folder)
    out = shared_dir(spark, "files")
    manifest = warc.export_files(records, out, 2).collect()
    root = out.removeprefix("file:")
    data = b"".join(open(os.path.join(root, r["path"]), "rb").read() for r in manifest)
    assert sum(r["records"] for r in manifest) == len(PAGES) and len(data) == sum(len(r["record"]) for r in records.collect())


def test_warc_damage_is_seen(spark):
    folder = shared_dir(spark, "warc")
    warc.write_archive(pages(spark, PAGES), folder)
    spark.read.parquet(f"{folder}/payloads").selectExpr("digest", "CAST(concat(payload, 'y') AS BINARY) AS payload").write.parquet(f"{folder}/bad/payloads")
    spark.read.parquet(f"{folder}/headers").write.parquet(f"{folder}/bad/headers")
    with pytest.raises(Exception, match="damaged"):
        warc.parse_records(warc.read_records(spark, f"{folder}/bad")).collect()


def test_warc_of_an_empty_table(spark):
    folder = shared_dir(spark, "warc")
    warc.write_archive(pages(spark, []), folder)
    assert warc.parse_records(warc.read_records(spark, folder)).count() == 0


def test_pipeline_stages(spark):
    import corpus_pipeline

    rows = [(i, prose(i, 90, 6)) for i in range(20)] + [(100 + i, prose(i, 90, 6) + " end") for i in range(5)]
    rows += [(200, None), (201, "too short"), (202, prose(300, 120, 8)), (203, prose(300, 120, 8)), (203, prose(300, 120, 8)), (None, prose(301, 90, 6))]
    docs = frame(spark, rows, extra=True)
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        out = shared_dir(spark, name)
        stage(spark, docs, "").write.parquet(out)
        before, docs = docs, spark.read.parquet(out)
        seen.append((name, before, docs))
    (_, raw, good), (_, _, clean), (_, _, apart), (_, last, packed) = seen
    assert good.columns == clean.columns == apart.columns == raw.columns
    kept = {i for i, t in rows if t and len(t.split()) >= 50}
    assert {r["doc_id"] for r in good.collect()} == kept
    assert rows_of(clean, "doc_id", "text") == [(i, t) for i, t, _ in plain_clean(rows_of(good, "doc_id", "text"))]
    near = {i for i, _, c in plain_near(rows_of(clean, "doc_id", "text")) if i == c}
    assert {r["doc_id"] for r in apart.collect()} == near | {None}
    assert {r["doc_id"] for r in packed.collect()} == {r["doc_id"] for r in last.collect()}


FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no driver tables")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_with_sql(spark, name):
    from oracle import compare, connect

    assert compare(spark, connect(FOLDER), name, QUERIES[name], ORACLES[name], FOLDER) is None


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no driver tables")
def test_pipeline_query(spark):
    import corpus_pipeline

    got = corpus_pipeline.run(spark, FOLDER)
    assert got.count() > 0 and {"doc_id", "sequence_id", "offset"} <= set(got.columns)
