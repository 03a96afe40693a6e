"""Hard negatives, ranked search and language prediction against plain versions."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stepwise.llm import langid, lemp, lexical

from helpers import frame, odd_rows, prose, rows_of, table

VECTORS = "vec_id long, label int, embedding array<float>"


def clustered(seed, n, width=16, hot=0, spread=0.15):
    r = np.random.default_rng(seed)
    centers = r.normal(size=(6, width))
    rows = []
    for i in range(n):
        x = centers[i % 6] * (0.3 + (i % 11) / 7) + spread * r.normal(size=width)
        rows.append((i, int(r.integers(0, 4)), [float(c) for c in x.astype(np.float32)]))
    rows += [(n + i, i % 3, rows[0][2]) for i in range(hot)]
    return rows


ODD_VECTORS = [
    (None, 1, [0.5] * 16),
    (100, None, [0.5] * 16),
    (10_000, 1, None),
    (10_100, 1, [0.5, None] + [0.1] * 14),
    (10_200, 2, [float("nan")] * 16),
    (10_300, 2, [float("inf")] * 16),
    (10_400, 2, []),
    (10_500, 2, [0.0] * 16),
    (10_600, 1, [0.7, 0.7]),
    (10_601, 2, [0.7, 0.6]),
    (10_700, 3, [-9.0] * 16),
    (10_701, 3, [-0.5] * 16),
    (10_702, 3, [1e30] * 16),
    (0, 3, [0.25] * 16),
    (10_701, 3, [-0.5] * 16),
]


def plain_negatives(rows):
    valid = []
    for ident, label, vec in rows:
        if ident is None or label is None or vec is None or any(x is None or not math.isfinite(x) for x in vec):
            continue
        valid.append((ident, label, [int(max(-(2**28), min(2**28, math.floor(256 * float(np.float32(x)))))) for x in vec]))
    anchors = {}
    for row in valid:
        if row[0] % 100 == 0:
            anchors[row[0]] = min(anchors.get(row[0], row), row, key=lambda x: x[1:])
    out = []
    for a, label, vec in anchors.values():
        scored = [(-sum(x * y for x, y in zip(vec, v)), i, other) for i, other, v in valid if i != a]
        same = sorted((s, i) for s, i, other in scored if other == label)[:5]
        others = sorted((s, i) for s, i, other in scored if other != label)
        for p_score, p in same:
            fit = [(s, i) for s, i in others if -80 * p_score <= -100 * s <= -100 * p_score][:5]
            out += [(a, p, k + 1, i, -p_score, -s) for k, (s, i) in enumerate(fit)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("case", ["odd", "hot", "far"])
def test_hard_negatives(spark, monkeypatch, case):
    monkeypatch.setattr(lemp, "BUCKET_ROWS", 64)
    monkeypatch.setattr(lemp, "LEAST_ROWS", 16)
    monkeypatch.setattr(lemp, "BLOCK_ANCHORS", 3)
    monkeypatch.setattr(lemp, "GROUP_BUCKETS", 3)
    rows = {"odd": clustered(1, 700) + ODD_VECTORS, "hot": clustered(2, 600, hot=500), "far": clustered(3, 900, spread=0.02)}[case]
    df = table(spark, rows, VECTORS).repartition(5).selectExpr("*", "'x' AS id", "1 AS block", "2 AS score", "'y' AS vec")
    assert rows_of(lemp.hard_negatives(df)) == plain_negatives(rows)


def test_hard_negatives_of_empty_tables(spark):
    assert lemp.hard_negatives(table(spark, [], VECTORS)).count() == 0
    assert lemp.hard_negatives(table(spark, [(1, 1, [1.0])], VECTORS)).count() == 0
    assert lemp.hard_negatives(table(spark, [(100, 1, [1.0])], VECTORS)).count() == 0


def test_coordinate_ranges_prune_and_lose_nothing():
    r = np.random.default_rng(4)
    centers = r.normal(size=(8, 32))
    rows = np.floor(256 * (centers[np.arange(800) % 8] + 0.05 * r.normal(size=(800, 32)))).astype(np.int64)
    bucket = lemp._bucket(np.arange(800), np.arange(800) % 2, rows)
    queries = rows[:20]
    best = np.sort(queries @ rows.T, axis=1)[:, -40]
    packed = {"q_rows": 20, "q_ids": np.arange(20) - 100, "q_labels": np.zeros(20, np.int64), "q_vectors": queries.astype("<i4")}
    packed |= {"q_low": best, "q_high": np.full(20, 1 << 60)}
    block = lemp.Anchors({k: v if k == "q_rows" else v.tobytes() if k == "q_vectors" else v.astype("<i8").tobytes() for k, v in packed.items()}, 1, 1000, False)
    looked, pairs = lemp.search(block, bucket)
    assert looked < pairs / 2
    want = Counter(int(q) for q, p in zip(*np.nonzero(queries @ rows.T >= best[:, None])) if p % 2)
    assert Counter((block.best[0]).tolist()) == want


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = {c: c + 32 for c in range(65, 91)}


def plain_terms(text):
    return TERM.findall((text or "").translate(FOLD))


def plain_search(docs, items, top=10):
    bags = [(i, Counter(plain_terms(t))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n_docs, n_terms = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(plain_terms(t))
    out = []
    for item, its in asked.items():
        scored = []
        for i, b in bags:
            m = 10 + 90 * sum(b.values()) * n_docs // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * b[t] // (1000 * b[t] + 8 * m)) for t in its if t in b
            )
            if score > 0:
                scored.append((-score, i is None, i if i is not None else 0))
        for rank, (score, null, i) in enumerate(sorted(scored)[:top], 1):
            out.append((item, rank, None if null else i, -score))
    return sorted(out, key=repr)


ITEMS = [(1, "the haus RIVER stone7 light"), (2, "Señal über naïve12 日本語"), (3, None), (4, "zzz nowhere"), (5, "the"), (5, "der und"), (None, "la que river3"), (7, "")]


@pytest.mark.parametrize("case", ["odd", "many"])
def test_ranked_search(spark, monkeypatch, case):
    monkeypatch.setattr(lexical, "SHARD_BYTES", 6000)
    monkeypatch.setattr(lexical, "BLOCK", 4)
    monkeypatch.setattr(lexical, "ITEM_BLOCK", 3)
    r = random.Random(8)
    docs = odd_rows() if case == "odd" else [(n, prose(n % 400, r.randrange(1, 60))) for n in range(900)]
    docs.append((77, "Mixed\x00CASE it's 0x1F_под\x7fx"))
    got = lexical.rank_documents(frame(spark, docs, extra=True), table(spark, ITEMS, "item_id long, text string").selectExpr("*", "1 AS term"))
    assert rows_of(got) == plain_search(docs, ITEMS)


def test_ranked_search_of_empty_tables(spark):
    items = table(spark, ITEMS, "item_id long, text string")
    assert lexical.rank_documents(frame(spark, []), items).count() == 0
    assert lexical.rank_documents(frame(spark), items.limit(0)).count() == 0


@pytest.mark.parametrize("texts", [[""], ["", "a", ""], ["a", "b c"], [" x-y ", "Ä1", "\x00"], []])
def test_terms_do_not_run_over_text_borders(texts):
    doc, code, names = lexical.terms(pa.array(texts, pa.string()))
    assert [(d, names[c].as_py()) for d, c in zip(doc.tolist(), code.tolist())] == [(d, t) for d, x in enumerate(texts) for t in plain_terms(x)]
    sliced = pa.array(["skip me", *texts, "and me"]).slice(1, len(texts))
    assert len(lexical.terms(sliced)[0]) == len(doc)


def test_block_maxima_leave_blocks_packed():
    r = random.Random(3)
    texts = [" ".join(["common"] * (1 + n % 3) + ["often"] * (n % 2) + [f"w{r.randrange(20000)}" for _ in range(30)]) for n in range(6000)]
    bags = [Counter(plain_terms(t)) for t in texts]
    total = sum(sum(b.values()) for b in bags)
    batch = lexical.shard_rows(np.arange(6000), pa.array(texts), 6000, total)
    rows = batch.to_pylist()
    shard = lexical.Shard(rows[0]["data"], rows[0]["heads"], 6000, total)
    asked = ["common", "often", "w5", "w17"]
    for row in rows[1:]:
        if row["term"] in asked:
            weight = math.floor(1000 * math.log(12002 / (2 * row["df"] + 1)))
            shard.lists[row["term"]] = lexical.Postings(weight, row["df"], row["heads"], row["data"], row["gap_width"], row["tf_width"])
    heap = lexical.Heap(5)
    lexical.max_score(shard, ["w5", "w17"], heap)  # a full heap: the common lists cannot reach its last score
    assert len(heap.score) == 5
    heap.ids = heap.ids + 100_000
    lexical.max_score(shard, asked, heap)
    for t in ("common", "often"):
        assert shard.lists[t].unpacked < len(shard.lists[t].heads) * 0.8
    found = {int(i) for i in heap.ids if i < 100_000}
    assert found and all(bags[i]["w5"] or bags[i]["w17"] for i in found)


def plain_grams(text):
    body = re.sub(rb"[^a-z\x80-\xff]+", b" ", b" " + text.translate(FOLD).encode() + b" ")
    out = Counter()
    for n in langid.GRAMS:
        for i in range(len(body) - n + 1):
            key = int.from_bytes(body[i : i + n], "little")
            mixed = (key ^ (n * 0x9E3779B1 & 0xFFFFFFFF)) * 0x85EBCA6B & 0xFFFFFFFF
            mixed ^= mixed >> 15
            out[(mixed * 0xC2B2AE35 & 0xFFFFFFFF) >> 16 & 0xFFFF] += 1
    return out


@pytest.mark.parametrize("piece", [1, 2, 3, 7, 1 << 20])
@settings(max_examples=30, deadline=None)
@given(texts=st.lists(st.text(alphabet="aB z-1\né日\x00", max_size=12), max_size=5))
def test_grams(piece, texts):
    whole, langid.PIECE = langid.PIECE, piece
    try:
        got = [Counter() for _ in texts]
        for text, places in langid.grams(pa.array(["x", *texts], pa.string()).slice(1)):
            assert (np.diff(text) >= 0).all()
            for t, h in zip(text.tolist(), places.tolist()):
                got[t][h] += 1
    finally:
        langid.PIECE = whole
    assert got == [plain_grams(t) for t in texts]


@pytest.mark.parametrize("languages", [1, 2, 3, 4, 5, 6, 7, 8, 9, 40])
def test_codewords(languages):
    code = langid.codewords(languages)
    assert code.shape == (languages, langid.code_bits(languages))
    assert len({(c * c[0]).tobytes() for c in code.T}) == code.shape[1]
    if languages > 1:
        assert all(set(c.tolist()) == {1, -1} for c in code.T)
        apart = (code.shape[1] - code.astype(int) @ code.T) // 2 + np.eye(languages, dtype=int) * 99
        assert apart.min() >= max(1, code.shape[1] // 4)
    assert (code == langid.codewords(languages)).all()


SPOKEN = {"en": "the and with river stone house over light", "de": "der und haus über straße nicht eine zeit", "fr": "le les été avec dans maison où jour", "xx": "zug vek lom prat dun hrel skov mik"}
LABELLED = "doc_id long, text string, lang string"


def spoken(n, noise=0):
    r = random.Random(9)
    rows = []
    for i in range(n):
        lang = r.choice(list(SPOKEN))
        rows.append((i, " ".join(r.choice(SPOKEN[lang].split()) for _ in range(r.randrange(3, 40))), lang))
    return rows


def held(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def test_languages_of_held_out_rows(spark):
    rows = spoken(600)
    long = (9000, " ".join(SPOKEN["fr"].split() * 4000), "fr")
    odd = [(9001, None, "en"), (9002, "", "en"), (9003, "12 - 34 \n", "de"), (9004, "und der", None), (None, "the house", "en"), (9001, "les maison", "fr")]
    df = table(spark, [*rows, long, *odd], LABELLED)
    wide = df.selectExpr("*", "'x' AS score", "'y' AS held_out", "'z' AS has_letter", "'w' AS source")
    got = langid.predict_languages(wide.repartition(7)).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in [*rows, long, *odd])
    assert all(r["held_out"] == (r["doc_id"] is not None and held(r["doc_id"])) for r in got)
    truth = {r[0]: r[2] for r in rows}
    tested = [r for r in got if r["doc_id"] in truth and r["held_out"]]
    assert len(tested) > 100 and sum(r["lang_pred"] == truth[r["doc_id"]] for r in tested) >= 0.97 * len(tested)
    by_id = {r["doc_id"]: r for r in got if r["doc_id"] != 9001}
    assert by_id[9000]["lang_pred"] == "fr" and by_id[9004]["lang_pred"] == "de"
    assert [(by_id[i]["lang_pred"], by_id[i]["score"], by_id[i]["ambiguous"]) for i in (9002, 9003)] == [("und", 0.0, False)] * 2
    assert sorted(r["lang_pred"] for r in got if r["doc_id"] == 9001) == ["fr", "und"]
    assert all(0 <= r["score"] <= 1 for r in got)
    assert rows_of(langid.predict_languages(df.repartition(1))) == sorted(map(tuple, got), key=repr)


def test_mixed_text_is_flagged(spark):
    half = lambda a, b: " ".join(SPOKEN[a].split() * 3 + SPOKEN[b].split() * 3)
    rows = spoken(400) + [(5000 + i, half(*p), None) for i, p in enumerate([("en", "de"), ("fr", "xx"), ("de", "fr")])]
    got = {r["doc_id"]: r for r in langid.predict_languages(table(spark, rows, LABELLED)).collect()}
    mixed, plain = [got[5000 + i]["score"] for i in range(3)], sorted(got[i]["score"] for i in range(400))
    assert any(got[5000 + i]["ambiguous"] for i in range(3)) and max(mixed) < plain[100]


def test_few_or_no_languages(spark):
    one = [(1, "the house", "en"), (2, "der zug", None), (3, "12", "en"), (4, None, None)]
    for rows, want in ((one, {"en", "und"}), ([(i, t, None) for i, t, _ in one], {"und"})):
        got = langid.predict_languages(table(spark, rows, LABELLED)).collect()
        assert {r["lang_pred"] for r in got} == want and len(got) == 4
        assert all(r["score"] == (r["lang_pred"] != "und") for r in got)
    assert langid.predict_languages(table(spark, [], LABELLED)).count() == 0
