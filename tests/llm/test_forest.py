from collections import defaultdict

import numpy as np
import pytest
from biblion.llm import forest
from biblion.llm.base import table

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, threshold=0.98):
    ids, out = [r[0] for r in rows], {}
    ok = [k for k, (i, v, c) in enumerate(rows) if i is not None and c is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links, parent = defaultdict(int), {i: i for i in ids if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    groups = defaultdict(list)
    for k in ok:
        groups[rows[k][2], len(rows[k][1])].append(k)
    for ks in groups.values():
        x = np.array([rows[k][1] for k in ks], np.float32).astype(float)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        near = x @ x.T >= threshold
        np.fill_diagonal(near, False)
        for a, b in zip(*np.nonzero(near)):
            links[ks[a]] += 1
            p, q = root(ids[ks[a]]), root(ids[ks[b]])
            parent[max(p, q)] = min(p, q)
    return sorted(((i, links[k], root(i) if i is not None else None, i is None or root(i) == i) for k, i in enumerate(ids)), key=str)


def got(df):
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in forest.grouped(df).collect()), key=str)


def test_table(spark):
    df = table(spark, "/root/testdata/sf0.1", "embeddings")
    want = brute([tuple(r) for r in df.select("vec_id", "embedding", "label").collect()])
    assert len(want) == df.count()
    assert got(df) == want


@pytest.mark.parametrize("gap", [0.05, 0.18])
def test_links_near_the_threshold(spark, gap):
    # families around 3,000 centres, their members at cosines from 0.97 to 1: recall of links against brute force
    rnd = np.random.default_rng(9)
    centres = rnd.standard_normal((3000, 64))
    rows = []
    for k in range(9000):
        c = centres[k % 3000]
        noise = rnd.standard_normal(64)
        rows.append((k, [float(v) for v in c + gap * rnd.uniform(0.3, 1) * noise * np.linalg.norm(c) / np.linalg.norm(noise)], k % 3000 % 3))
    df = spark.createDataFrame(rows, SCHEMA)
    found, want = got(df), brute([tuple(r) for r in df.collect()])
    links, all_links = sum(x[1] for x in found), sum(x[1] for x in want)
    assert 3000 < all_links and 0.99 * all_links <= links <= all_links
    assert sum(a != b for a, b in zip(found, want, strict=True)) < 0.02 * len(want)


@pytest.mark.parametrize("most", [1500, 60])
def test_dense_spots_and_copies(spark, monkeypatch, most):
    monkeypatch.setattr(forest, "LEAF", 40)
    monkeypatch.setattr(forest, "LEAF_MOST", most)
    rnd = np.random.default_rng(3)
    centre = rnd.standard_normal(16)
    rows = [(i, [float(v) for v in rnd.standard_normal(16)], int(i % 3)) for i in range(300)]
    rows += [(1000 + i, [float(v) for v in centre + 0.06 * rnd.standard_normal(16)], int(i % 2)) for i in range(400)]
    rows += [(2000 + i, [float(v) for v in centre], 1) for i in range(50)]
    rows += [(3000 + i, [float(v) * 3 for v in centre], 1) for i in range(5)]
    df = spark.createDataFrame(rows, SCHEMA)
    rows = [tuple(r) for r in df.collect()]
    assert got(df) == brute(rows)


def test_doubles_keep_their_precision(spark):
    # as floats the second would equal the first
    rows = [(1, [1.0, 0.0], 1), (2, [1.0, 1e-9], 1), (3, [1e300, 1e299], 1), (4, [0.0, 1.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert got(df) == [(1, 2, 1, True), (2, 2, 1, False), (3, 2, 1, False), (4, 0, 4, True)]


def test_edges(spark):
    a, nan, inf = [1.0, 2.0], float("nan"), float("inf")
    rows = [(1, a, 1), (2, a, None), (3, None, 1), (4, [], 1), (5, [0.0, 0.0], 1), (6, [1.0, None], 1), (7, [nan, 1.0], 1), (8, [inf, 1.0], 1), (9, a, 1), (9, a, 1), (None, a, 1), (10, [1.0, 2.0, 0.0], 1), (11, a, 2), (12, [1e-30, 2e-30], 1), (13, [1e30, 2e30], 2)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(df) == brute([tuple(r) for r in df.collect()])
    wide = df.selectExpr("*", "1 AS id", "2 AS leaf", "'x' AS rep")
    assert forest.grouped(wide).columns == ["vec_id", "n_links", "component_id", "kept"]
    assert forest.grouped(wide).count() == len(rows)
    assert forest.grouped(df.limit(0)).collect() == []
