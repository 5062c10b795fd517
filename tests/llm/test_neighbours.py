import numpy as np
from biblion.llm import neighbours, queries
from biblion.llm.base import table
from pyspark.sql import functions as F

SCHEMA = "vec_id long, embedding array<float>, rank int"


def brute(ids, x, asked, k=10):
    out = {}
    for i in np.flatnonzero(asked):
        gap = x - x[i]
        score = np.sqrt((gap * gap).sum(axis=1))
        score[i] = np.inf
        best = np.lexsort((ids, score))[: min(k, len(ids) - 1)]
        out[int(ids[i])] = [(int(ids[j]), float(score[j])) for j in best]
    return out


def collected(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def recall(got, want):
    assert got.keys() == want.keys()
    for q, rows in got.items():
        assert len(rows) == len(want[q]) and len({v for v, _ in rows}) == len(rows)
        assert [(s, v) for v, s in rows] == sorted((s, v) for v, s in rows)
    return np.mean([len({v for v, _ in got[q]} & {v for v, _ in want[q]}) / len(want[q]) for q in want])


def test_recall_on_the_table(spark):
    df = table(spark, "/root/testdata/sf0.1", "embeddings")
    rows = df.select("vec_id", "embedding").orderBy("vec_id").collect()
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float32).astype(float)
    got, want = collected(queries.op5_nearest(spark, "/root/testdata/sf0.1")), brute(ids, x, ids % 100 == 0)
    assert recall(got, want) >= 0.9
    place = {int(i): k for k, i in enumerate(ids)}
    for q, found in got.items():
        for v, s in found:
            gap = x[place[v]] - x[place[q]]
            assert abs(s - np.sqrt((gap * gap).sum())) < 1e-12


def test_clusters_need_few_candidates():
    rnd = np.random.default_rng(2)
    centres = rnd.standard_normal((200, 32))
    x = np.repeat(centres, 20, axis=0) + 0.05 * rnd.standard_normal((4000, 32))
    ids, centre = np.arange(4000), x.mean(axis=0)
    block = {"id": ids, "at": ids, "v": x, "s": neighbours.strings(x, centre)}
    asked = {"id": ids[:50], "at": ids[:50], "v": x[:50], "s": block["s"][:, :50]}
    visited = []
    query, row, score, angle = neighbours.answered(block, asked, 10, centre, {}, visited)
    assert np.mean(visited) < 1000
    want = brute(ids, x, ids < 50)
    found = {i: {r for q, r in zip(query, row) if q == i} for i in range(50)}
    assert np.mean([len(found[i] & {v for v, _ in want[i]}) / 10 for i in range(50)]) > 0.95
    # the ascent takes up where the descent ended, and no further than the bound asks
    deeper = []
    neighbours.answered(block, asked, 10, centre, None, deeper)
    assert np.mean(deeper) <= np.mean(visited)


def test_many_blocks_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "CHUNK", 40)
    rnd = np.random.default_rng(5)
    rows = [(i, [float(v) for v in rnd.standard_normal(8)], 0) for i in range(3000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int").repartition(6)
    x = np.array([r[1] for r in rows])
    got, want = collected(neighbours.searched(df, F.col("vec_id") % 20 == 0)), brute(np.arange(3000), x, np.arange(3000) % 20 == 0)
    assert recall(got, want) >= 0.9


def test_double_components(spark):
    rows = [(0, [1.0, 0.0], 0), (1, [1.0 + 1e-12, 0.0], 0), (2, [1.0 - 1e-9, 0.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int")
    got = collected(neighbours.searched(df, F.col("vec_id") == 0))[0]
    assert [v for v, _ in got] == [1, 2] and got[0][1] == (1.0 + 1e-12) - 1.0


def test_edges(spark):
    a, nan = [1.0, 2.0], float("nan")
    rows = [(0, a, 1), (100, None, 1), (200, [], 1), (300, [0.0, 0.0], 1), (400, [1.0, None], 1), (500, [nan, 1.0], 1), (None, a, 1), (7, a, 1), (7, a, 1), (5, a, 1), (9, [1.0, 5.0], 1), (600, [1.0, 2.0, 3.0], 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = collected(neighbours.searched(df, F.col("vec_id") % 100 == 0))
    # every row but the query's own is a candidate, rows with one id, too
    assert got == {0: [(5, 0.0), (7, 0.0), (7, 0.0), (9, 3.0)]}
    twice = spark.createDataFrame([(0, a, 1), (0, [1.0, 3.0], 1), (4, [1.0, 9.0], 1)], SCHEMA)
    found = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in neighbours.searched(twice, F.col("vec_id") == 0).collect())
    assert found == [(0, 1, 0, 1.0), (0, 1, 0, 1.0), (0, 2, 4, 6.0), (0, 2, 4, 7.0)]
    assert neighbours.searched(df.limit(0), F.col("vec_id") % 100 == 0).collect() == []
    many = spark.createDataFrame([(i, [float(i), 1.0], 0) for i in range(0, 3000)], SCHEMA)
    got = collected(neighbours.searched(many, F.col("vec_id") % 1000 == 0, k=3))
    assert got[1000] == [(999, 1.0), (1001, 1.0), (998, 2.0)]
