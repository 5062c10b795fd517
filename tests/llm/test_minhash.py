import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from biblion.llm import graph, minhash
from biblion.llm.base import table
from biblion.llm.graph import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sets_of(text, words):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1)))


def brute(rows, words, percent):
    sets = [(i, sets_of(t, words)) for i, t in rows]
    by = defaultdict(list)
    for k, (i, s) in enumerate(sets):
        if i is not None:
            for x in s:
                by[x].append(k)
    common = defaultdict(int)
    for ks in by.values():
        for a in range(len(ks)):
            for b in range(a + 1, len(ks)):
                common[ks[a], ks[b]] += 1
    parent = {i: i for i, _ in sets if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a][1]) + len(sets[b][1]) - n):
            x, y = root(sets[a][0]), root(sets[b][0])
            parent[max(x, y)] = min(x, y)
    return sorted(((i, len(s), root(i) if i is not None else None, i is None or root(i) == i) for i, s in sets), key=str)


def got(df, words, percent):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.grouped(df, words=words, percent=percent).collect()), key=str)


@pytest.mark.parametrize("words", [2, 5])
def test_documents(spark, words):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], words, 80)
    assert got(docs, words, 80) == want
    assert sum(not x[3] for x in want) > 20


def exact(rows, words, percent):
    """Components by an exact join: two sets that are near enough share one of their rarest shingles."""
    sets = [(i, sets_of(t, words)) for i, t in rows]
    often = Counter(x for _, s in sets for x in s)
    by, parent = defaultdict(list), {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = 0
    for k, (i, s) in enumerate(sets):
        if not s:
            continue
        first = sorted(s, key=lambda x: (often[x], x))[: len(s) - -(-percent * len(s) // 100) + 1]
        near = {j for x in first for j in by[x]}
        for x in first:
            by[x].append(k)
        for j in near:
            both = len(s & sets[j][1])
            if 100 * both >= percent * (len(s) + len(sets[j][1]) - both):
                links += 1
                x, y = root(i), root(sets[j][0])
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i, _ in sets}, links


@pytest.mark.parametrize("words", [2, 5])
def test_recall_on_ten_thousand_documents(spark, words):
    docs = table(spark, "/root/testdata/sf0.1", "documents").select("doc_id", "text")
    want, links = exact([(r.doc_id, r.text) for r in docs.collect()], words, 80)
    found = {r.doc_id: r.component_id for r in minhash.grouped(docs, words=words).collect()}
    assert links > 500 and found.keys() == want.keys()
    # every component found is one in truth or a part of one; nearly all are whole
    assert all(want[found[i]] == want[i] for i in found)
    assert sum(found[i] == want[i] for i in found) / len(found) >= 0.999


def test_chains_stars_and_short_texts(spark):
    rnd = random.Random(9)
    rows, words = [], [f"w{i}" for i in range(60)]
    for i in range(40):  # a chain: each differs a little from the one before
        words = list(words)
        words[rnd.randrange(60)] = f"n{i}"
        rows.append((1000 - i, " ".join(words)))
    rows += [(2000 + i, " ".join(rnd.choice("ab") for _ in range(rnd.randint(0, 4)))) for i in range(80)]
    rows += [(3000 + i, "Same TEXT in many copies, word for word") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(df, 2, 80) == brute(rows, 2, 80)


def test_edges(spark):
    rows = [(None, "a b c"), (1, None), (2, ""), (3, " \t"), (4, "a b c"), (4, "a b c"), (5, "A B C"), (6, "x"), (7, "X"), (8, "é"), (9, "É"), (10, "long " * 9 + "word " * 20000), (11, "y z"), (11, "a b c")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(df, 2, 80) == brute(rows, 2, 80)
    wide = df.selectExpr("*", "1 AS n_shingles", "2 AS component", "3 AS bucket")
    assert minhash.grouped(wide, words=2).count() == len(rows)
    kept = minhash.representatives(wide, words=2)
    assert kept.columns == wide.columns
    assert {r.doc_id for r in kept.collect()} == {None, 1, 2, 3, 4, 6, 8, 9, 10}
    assert minhash.grouped(df.limit(0)).collect() == []


def test_signature_agrees_as_often_as_sets_do():
    rnd = np.random.default_rng(1)
    for size in (3, 20, 500):
        same = []
        for _ in range(60):
            x = rnd.integers(0, 2**63, size * 2, dtype=np.uint64)
            a, b = np.sort(x[: int(size * 1.5)]), np.sort(x[size // 2 :])
            j = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            same.append((minhash.signature(a) == minhash.signature(b)).mean() - j)
        assert abs(np.mean(same)) < 0.06


def test_components(spark):
    rnd = random.Random(1)
    edges = [(rnd.randrange(400), rnd.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(500, 700)] + [(9000, i) for i in range(8000, 8300)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    want = {x: root(x) for a, b in edges if a != b for x in (a, b)}
    df = spark.createDataFrame(edges, "a long, b long")
    assert {r.id: r.component for r in components(df).collect()} == want
    assert components(df.limit(0)).collect() == []


def test_a_long_chain_takes_few_rounds(spark):
    df = spark.range(2000).selectExpr("id AS a", "id + 1 AS b")
    assert {(r.id, r.component) for r in components(df).collect()} == {(i, 0) for i in range(2001)}
    assert graph.last_rounds <= 12


@pytest.mark.parametrize("sizes", [[60], [150, 150]])
def test_texts_that_derive_from_one(spark, sizes):
    # each differs from its source in places of its own: linked with the source only; sources form a chain
    rnd, rows = random.Random(len(sizes)), []
    source = [f"b{i}" for i in range(200)]
    for f, size in enumerate(sizes):
        new = set(rnd.sample(range(200), 8))
        source = [f"s{f}_{k}" if k in new else w for k, w in enumerate(source)]
        for m in range(size):
            away = set(rnd.sample(range(200), 9))
            rows.append((1000 * f + m, " ".join(f"v{f}_{m}_{k}" if k in away else w for k, w in enumerate(source))))
        rows.append((1000 * f + size, " ".join(source)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    assert got(df, 2, 80) == brute(rows, 2, 80)


def test_crowded_buckets(spark):
    # form letters: most pairs lie just under the threshold and share buckets with very many others
    rnd, rows = random.Random(4), []
    for i in range(300):
        words = [f"f{k}" for k in range(230)]
        for k in range(29):
            words += [f"slot{k}", f"c{k}_{rnd.randrange(6)}", f"end{k}"]
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    want = brute(rows, 2, 80)
    assert 20 < sum(not x[3] for x in want) < 280
    assert got(df, 2, 80) == want


def test_dealt_stars_and_blocks(spark, monkeypatch):
    # a popular centre with salts, and buckets of many blocks whose light members link among themselves only
    monkeypatch.setattr(minhash, "DEALT", 5)
    monkeypatch.setattr(minhash, "BLOCK", 12)
    rnd, rows = random.Random(12), []
    source = [f"b{i}" for i in range(200)]
    for m in range(120):
        away = set(rnd.sample(range(200), rnd.choice([6, 9, 12])))
        words = [f"v{m}_{k}" if k in away else w for k, w in enumerate(source)]
        rows.append((m, " ".join(words)))
        if m % 3 == 0:
            words[rnd.randrange(200)] = "other"
            rows.append((1000 + m, " ".join(words)))
    rows.append((5000, " ".join(source)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    assert got(df, 2, 80) == brute(rows, 2, 80)
