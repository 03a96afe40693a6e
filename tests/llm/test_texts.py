"""Quality rules, exact duplicates, line chunks and near duplicates against plain versions."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stepwise.llm import exact_dedup, graph, jaccard, line_dedup, quality
from stepwise.llm.graph import components
from stepwise.session import stored

from helpers import frame, odd_rows, prose, rows_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_repetition(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    marked = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    failed = len(words) < 50 or 100 * len(marked) > 50 * len(words)
    return len(words), sum(map(len, words)), symbols, dup, len(marked), failed


def test_repetition_counts(spark):
    got = rows_of(quality.repetition(frame(spark)), "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert got == sorted(((i, *plain_repetition(t)) for i, t in odd_rows()), key=repr)


def test_repetition_ignores_other_columns_and_empty_tables(spark):
    assert rows_of(quality.repetition(frame(spark))) == rows_of(quality.repetition(frame(spark, extra=True)))
    assert quality.repetition(frame(spark, [])).count() == 0


def test_keep_good_keeps_rows_whole(spark):
    kept = rows_of(quality.keep_good(frame(spark, extra=True)), "doc_id", "text", "kept")
    verdict = {(r["doc_id"], r["n_words"]) for r in quality.repetition(frame(spark)).where("kept").collect()}
    assert {(i, len(WORD.findall(t))) for i, t, _ in kept} == verdict
    assert Counter(i for i, *_ in kept)[2] == 2 and 12 not in {i for i, *_ in kept}


def test_each_ngram_rule_rejects_by_itself(spark):
    def text(size, times, total):
        """Words of four signs, of which a passage of ``size`` stands in ``times`` places apart from each other."""
        fresh, out = iter(range(1000, 9999)), []
        gap = (total - size * times) // times
        for _ in range(times):
            out += [f"p{n:03d}" for n in range(size)] + [str(next(fresh)) for _ in range(gap)]
        return " ".join(out + [str(next(fresh)) for _ in range(total - len(out))])

    rows = [(5, text(5, 8, 200)), (7, text(7, 4, 200)), (10, text(10, 2, 170)), (1, text(5, 5, 200)), (2, text(7, 3, 200)), (3, text(10, 2, 210)), (4, prose(60, 200, 9))]
    shares = {r["doc_id"]: [r[f"dup_chars_{n}"] / r["word_chars"] > limit for n, limit in quality.NGRAM_LIMITS.items()] for r in quality.repetition(frame(spark, rows)).collect()}
    assert [shares[n] for n in (5, 7, 10)] == [[True, False, False], [False, True, False], [False, False, True]]
    verdict = {r["doc_id"]: (r["base_failed"], r["kept"]) for r in quality.repetition(frame(spark, rows)).collect()}
    assert verdict == {n: (False, n < 5) for n, _ in rows}
    assert {r["doc_id"] for r in quality.keep_good(frame(spark, rows)).collect()} == {1, 2, 3, 4}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), max_size=30), max_size=4), st.integers(1, 11))
def test_covered_words(texts, n):
    words = np.array([w for t in texts for w in t], np.uint32)
    doc = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    want = []
    for t in texts:
        seen = Counter(tuple(t[i : i + n]) for i in range(len(t) - n + 1))
        inside = {j for i in range(len(t) - n + 1) if seen[tuple(t[i : i + n])] > 1 for j in range(i, i + n)}
        want += [i in inside for i in range(len(t))]
    for exact in (True, False):
        assert quality.covered(words, doc, n, exact).tolist() == want


def test_clashing_hashes_are_compared(monkeypatch):
    monkeypatch.setattr(quality, "_roll", lambda a, b: a * np.uint64(0))
    words = np.array([1, 2, 3, 1, 2, 4, 1, 2, 3], np.uint32)
    marked = quality.covered(words, np.zeros(9, np.int64), 3, True)
    assert marked.tolist() == [True] * 3 + [False] * 3 + [True] * 3


def plain_groups(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i is None, i or 0, i))
    out = []
    for i, t in rows:
        norm = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        best = min(groups[norm])
        kept = i == best[3] and -len(t or "") == best[0]
        out.append((i, best[3], len(groups[norm]), kept, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_exact_groups(spark):
    assert rows_of(exact_dedup.exact_groups(frame(spark, extra=True))) == plain_groups(odd_rows())
    assert exact_dedup.exact_groups(frame(spark, [])).count() == 0


def test_equal_digests_of_different_texts(spark):
    weak = lambda norm: bytes([len(norm) % 2]) * 32
    rows = [(i, f"text {i % 3}") for i in range(12)]
    got = exact_dedup.exact_groups(frame(spark, rows), digest=weak).select("doc_id", "keep_id", "group_size").collect()
    assert sorted(map(tuple, got)) == [(i, i % 3, 4) for i in range(12)]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.booleans(), st.integers(0, 60)), max_size=300))
def test_cuckoo_index_against_a_counter(steps):
    index, live = exact_dedup.CuckooIndex(2), Counter()
    pack = exact_dedup.zstandard.ZstdCompressor().compress
    for insert, n in steps:
        digest, content = hashlib.sha256(str(n).encode()).digest(), pack(str(n).encode())
        if insert:
            index.insert(digest, 0, content, 1, n, n)
            live[n] += 1
        else:
            assert index.delete(digest, content) == (live[n] > 0)
            live[n] -= live[n] > 0
    assert {e[4]: e[3] for e in index} == {n: c for n, c in live.items() if c}
    for n in range(61):
        digest = hashlib.sha256(str(n).encode()).digest()
        assert (index.find(digest, pack(str(n).encode())) is not None) == (live[n] > 0)


def test_update_index(spark):
    pack = exact_dedup.zstandard.ZstdCompressor().compress

    def entries(pairs):
        rows = [(0, hashlib.sha256(t.encode()).digest(), 0, pack(t.encode()), n, len(t), 1) for t, n in pairs]
        return spark.createDataFrame([(int.from_bytes(r[1][14:18], "little") % exact_dedup.BUCKETS, *r[1:]) for r in rows], exact_dedup.ENTRY)

    index = exact_dedup.build_index(entries([("a", 2), ("b", 1), ("a", 1)]), 3)
    after = exact_dedup.update_index(index, entries([("c", 1), ("b", -1), ("a", -1), ("zz", -1)]), 3)
    assert sorted((r["n_rows"], r["best_length"]) for r in after.collect()) == [(1, 1), (2, 1)]


@pytest.mark.parametrize("weak", [False, True])
def test_deleted_documents_against_a_recount(spark, weak):
    """After deletions the index says what an index of the documents left says, keepers included."""
    digest = (lambda norm: hashlib.sha256(norm[:1]).digest()) if weak else None
    rnd = random.Random(3)
    texts = ["a", "a ", "a  ", "b", "b\n", "", None, "ab", "a b"]
    docs = [(i, rnd.choice(texts)) for i in range(60)] + [(None, "a     "), (None, "only"), (70, "x"), (70, "x"), (71, "x")]
    gone = [i for i in range(60) if rnd.random() < 0.6] + [70, 70, None, 999]

    def table(rows):
        kinds = exact_dedup.digests(frame(spark, rows), "doc_id", "text", digest)
        kinds.write.mode("overwrite").parquet(path := exact_dedup.shared_dir(spark, "test-digests"))
        back = spark.read.parquet(path)
        members = back.where("kind = 'member'").select("doc_id", "length", "digest", "check_hash")
        return exact_dedup.build_index(back.where("kind = 'entry'"), 3), members

    def state(index):
        return sorted((r.digest, r.check_hash, r.n_rows, r.best_length, r.best_id or -1) for r in index.collect())

    index, members = table(docs)
    out = spark.createDataFrame([(i, "extra") for i in gone], "id long, digest string")
    live, left = exact_dedup.delete_documents(index, members, out, 3, "id")
    want, kept = table([(i, t) for i, t in docs if i is None or i not in gone])
    assert state(live) == state(want) and live.columns == index.columns
    assert sorted(map(str, left.collect())) == sorted(map(str, kept.select(left.columns).collect()))
    same, _ = exact_dedup.delete_documents(index, members, out.limit(0), 3, "id")
    assert state(same) == state(index)
    nothing, none = exact_dedup.delete_documents(index, members, members.where("doc_id IS NOT NULL"), 3)
    assert none.count() == 2 and sorted(r.n_rows for r in nothing.collect()) == [1, 1]


def plain_clean(rows, least=line_dedup.LEAST_WORDS):
    """Each pair of neighbouring filled lines and each chunk goes where it stood before; runs of few words stay."""

    def found(t):
        lines = (t or "").split("\n")
        at = [n for n, x in enumerate(lines) if x.strip()]
        both = [(a, b + 1) for a, b in zip(at, at[1:])]
        both += [(a, b) for a, b in line_dedup.cut(lines) if sum(a <= n < b for n in at) > 1]
        return lines, [(a, b, "\n".join(lines[a:b])) for a, b in both]

    first = {}
    for i, t in rows:
        for _, _, c in found(t)[1]:
            key = (i is None, i or 0)
            first[c] = min(first.get(c, key), key)
    out = []
    for i, t in rows:
        if t is None:
            out.append((i, None, 0))
            continue
        (lines, places), ends, gone = found(t), {}, set()
        for a, b, c in sorted(places):
            if ends.setdefault(c, b) <= a or (first[c] < (i is None, i or 0) and not first[c][0]):
                gone |= set(range(a, b))
        for n in sorted(gone):
            run = [n]
            while run[-1] + 1 in gone:
                run.append(run[-1] + 1)
            if n - 1 not in gone and sum(len(lines[k].split()) for k in run) < least:
                gone -= set(run)
        out.append((i, "\n".join(x for n, x in enumerate(lines) if n not in gone), len(gone)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("least", [0, line_dedup.LEAST_WORDS])
def test_clean_lines(spark, least):
    got = rows_of(line_dedup.clean_lines(frame(spark, extra=True), least_words=least), "doc_id", "text", "lines_removed")
    assert got == plain_clean(odd_rows(), least)
    assert line_dedup.clean_lines(frame(spark, [])).count() == 0
    assert line_dedup.clean_lines(frame(spark, extra=True), counts=False).columns == frame(spark, extra=True).columns


def test_boundaries_synchronise_after_span_lines():
    shared = prose(3, 900, 90).split("\n")
    one, two = (line_dedup.cut(prose(n, 60, 7 + n).split("\n") + shared) for n in (1, 5))
    edges = lambda found, before: {a - before for a, _ in found if a - before >= line_dedup.SPAN}
    assert edges(one, 8) == edges(two, 12) and len(edges(one, 8)) > 15


def test_chunks_carry_the_work(spark):
    """A long passage of many documents: without chunks each of them looks up all its windows."""
    passage = prose(70, 800, 80)
    rows = [(n, f"{prose(100 + n, 30, 3)}\n{passage}\n{prose(300 + n, 30, 3)}") for n in range(30)]
    docs = frame(spark, rows).selectExpr("doc_id", "text", "xxhash64(text) AS text_key")

    def looked_up(split):
        members = docs.mapInArrow(line_dedup._members(False, split), line_dedup._RANGE)
        hashes = line_dedup.chunk_hashes(members)
        return line_dedup.window_members(docs, hashes, split).count(), members.join(hashes, ["h1", "h2"]).where("doc_id > first_id").count()

    windows, chunks = looked_up(line_dedup.cut)
    assert chunks > 29 * 8 and windows < 0.5 * 30 * 80
    windows, chunks = looked_up(lambda lines: [])
    assert chunks == 0 and windows > 30 * 80


def test_a_shifted_passage_is_found(spark):
    passage = prose(7, 300, 30)
    rows = [(1, prose(8, 50, 5) + "\n" + passage), (2, prose(9, 90, 7) + "\n" + passage + "\n" + prose(10, 30, 3))]
    left = {r["doc_id"]: r["lines_removed"] for r in line_dedup.clean_lines(frame(spark, rows)).collect()}
    assert left == {1: 0, 2: 30}


def plain_passages(rows):
    """Lines with words that stay: runs of two or more shared with an earlier document go. Lines are compared one by one."""
    out = []
    for n, (i, text) in enumerate(rows):
        lines = text.split("\n")
        gone = set()
        for _, other in rows[:n]:
            theirs = other.split("\n")
            for a in range(len(lines)):
                for b in range(len(theirs)):
                    size = 0
                    while a + size < len(lines) and b + size < len(theirs) and lines[a + size] == theirs[b + size]:
                        size += 1
                    shared = [k for k in range(a, a + size) if lines[k].strip()]
                    gone.update(shared if len(shared) > 1 else ())
        out.append((i, [x for k, x in enumerate(lines) if x.strip() and k not in gone]))
    return out


def test_short_passages_are_found(spark):
    rows, blank = [], ["", "\n\n", " \n"]
    for n in range(40):
        shared = prose(500 + n, 60 + 10 * (n % 4), 2 + n % 4)
        if n % 5 == 0:
            shared = shared.replace("\n", "\n" + blank[n % 3])
        rows.append((2 * n, prose(600 + n, 40, 1 + n % 4) + "\n" + shared + "\n" + prose(700 + n, 30, 2)))
        rows.append((1000 - n, prose(800 + n, 70, 1 + n % 6) + "\n" + shared + "\n" + prose(900 + n, 40, 1 + n % 3)))
    rows.sort()
    cleaned = line_dedup.clean_lines(frame(spark, rows)).collect()
    assert sorted((r["doc_id"], [x for x in r["text"].split("\n") if x.strip()]) for r in cleaned) == plain_passages(rows)
    assert {(r["doc_id"] > 900, r["chunks_removed"]) for r in cleaned} == {(False, 0), (True, 1)}


def test_passages_that_overlap_themselves_stay(spark):
    rows = [(1, "x y\nx y\nx y"), (2, "a b\nc d\na b\nc d\na b"), (3, "e f\nx y\nx y\nx y\nx y\ng h")]
    left = {r["doc_id"]: r["text"] for r in line_dedup.clean_lines(frame(spark, rows), least_words=0).collect()}
    assert left == {1: "x y\nx y\nx y", 2: "a b\nc d", 3: "e f\ng h"}


def test_a_hash_of_different_chunks_removes_nothing(spark, monkeypatch):
    rows = [(1, "a b\nc d"), (2, "e f\ng h"), (3, "e f\ng h")]
    monkeypatch.setattr(line_dedup, "_halves", lambda chunk: (1, 1))
    df = frame(spark, rows).coalesce(1).selectExpr("*", "array(named_struct('a', 0, 'b', 2)) AS ranges")
    entries = list(line_dedup._entries(df.toArrow().to_batches()))
    assert len(entries[0]) == 2 and set(entries[0].column("h1").to_pylist()) == {1}
    monkeypatch.setattr(line_dedup, "_entries", lambda batches: iter(entries))
    assert line_dedup.repeated_chunks(df).count() == 0


def shingles(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def plain_near(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, o in sets[:a]:
            if i is None or j is None or not s or not o:
                continue
            common = len(s & o)
            if 100 * common >= 80 * len(s | o):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return sorted(((i, len(s), None if i is None else root(i)) for i, s in sets), key=repr)


def near_family(seed, copies, edits):
    import random

    r = random.Random(seed)
    base = prose(seed, 140).split(" ")
    out = []
    for c in range(copies):
        words = list(base)
        for _ in range(r.randrange(edits)):
            at = r.randrange(len(words))
            words[at : at + r.randrange(3)] = [f"edit{seed}x{c}y{r.randrange(9)}"]
        out.append(" ".join(words))
    return out


def test_near_groups_on_odd_rows(spark):
    assert rows_of(jaccard.near_groups(frame(spark, extra=True))) == plain_near(odd_rows())
    assert jaccard.near_groups(frame(spark, [])).count() == 0


def test_near_groups_on_families(spark):
    texts = [t for s in range(12) for t in near_family(s, 12, 9)] + [prose(100 + s, 80) for s in range(30)]
    rows = [(3 * n % 1009, t) for n, t in enumerate(texts)]
    want = plain_near(rows)
    assert rows_of(jaccard.near_groups(frame(spark, rows))) == want
    assert len({c for *_, c in want}) < len(rows)


def test_several_texts_of_one_id_are_one_node(spark):
    a, b = prose(1, 60), prose(2, 60)
    rows = [(5, a), (5, b), (2, a), (9, b)]
    assert {c for *_, c in rows_of(jaccard.near_groups(frame(spark, rows)))} == {2}


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 60), st.integers(0, 12), st.integers(0, 12), st.randoms())
def test_prefixes_share_enough(common, a_only, b_only, r):
    """Similar sets meet in as many prefix tokens as the smaller level asks for."""
    order = list(range(common + a_only + b_only))
    r.shuffle(order)
    a, b = set(order[: common + a_only]), set(order[:common]) | set(order[common + a_only :])
    if 100 * common < 80 * len(a | b):
        return
    for level in range(1, min(jaccard.needed(len(a)), jaccard.needed(len(b)), jaccard.MOST_LEVEL) + 1):
        prefix = [set(sorted(s)[: len(s) - jaccard.needed(len(s)) + level]) for s in (a, b)]
        assert len(prefix[0] & prefix[1]) >= level


@pytest.mark.parametrize("shape", ["chain", "star", "random"])
def test_components(spark, shape):
    import random

    r = random.Random(3)
    edges = {"chain": [(i, i + 1) for i in range(40)], "star": [(0, i) for i in range(1, 40)], "random": [(r.randrange(60), r.randrange(60)) for _ in range(40)]}[shape]
    parent = list(range(60))
    for _ in range(60):
        for a, b in edges:
            parent[a] = parent[b] = min(parent[a], parent[b])
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {n: p for n, p in enumerate(parent) if n != p}


def test_stars_take_one_round(spark, monkeypatch):
    # Each round is some 1,300 tasks with 211 partitions, all of which the driver keeps track of.
    rounds = []
    monkeypatch.setattr(graph, "stored", lambda df, name: rounds.append(name) or stored(df, name))
    edges = [(i, 7) for i in range(8, 40)] + [(50, 51), (50, 51), (3, 3)]
    got = sorted(tuple(r) for r in components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert got == [(i, 7) for i in range(8, 40)] + [(51, 50)]
    assert len(rounds) == 1
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.sets(st.integers(0, (1 << 64) - 1), max_size=300), st.sets(st.integers(0, 299), max_size=60), st.sets(st.integers(0, (1 << 64) - 1), max_size=40))
def test_parities_bound_the_difference(first, gone, fresh):
    second = {x for i, x in enumerate(sorted(first)) if i not in gone} | fresh
    a, b = (np.array(sorted(s), np.uint64) for s in (first, second))
    differ = sum(((x ^ y) & (1 << 64) - 1).bit_count() for x, y in zip(jaccard.parities(a), jaccard.parities(b)))
    assert differ <= len(first ^ second)


def test_parities_part_texts_of_one_template():
    rng = np.random.default_rng(1)
    shared = rng.integers(0, 1 << 63, 150).astype(np.uint64)
    sets = [np.unique(np.concatenate([shared, rng.integers(0, 1 << 63, 100).astype(np.uint64)])) for _ in range(2)]
    differ = sum(((x ^ y) & (1 << 64) - 1).bit_count() for x, y in zip(*map(jaccard.parities, sets)))
    assert 9 * differ > len(sets[0]) + len(sets[1])  # 150 of 350 shingles are shared: never compared
