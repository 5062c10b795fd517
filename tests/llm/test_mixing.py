import random
import re
from collections import defaultdict

from biblion.llm import mixing, queries
from biblion.llm.base import table
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"


def expected_targets(sizes):
    """source -> target by repeated resharing."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        rest = total - sum(fixed.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return fixed | share
        fixed |= {s: 3 * sizes[s] for s in over}


def check(rows):
    sizes, taken, most = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        most[r.source] = max(most[r.source], r.size)
        assert 0 <= r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
    want = expected_targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert abs(r.target - want[r.source]) <= 1e-6 * max(1, want[r.source])
    for s, t in taken.items():
        assert abs(t - want[s]) <= most[s], (s, t, want[s])


def test_documents(spark):
    docs = table(spark, SF, "documents")
    rows = mixing.plan(docs).collect()
    text = {r.doc_id: r.text for r in docs.collect()}
    assert sorted(r.doc_id for r in rows) == sorted(text)
    assert all(r.size == len(re.findall(r"[^\x20\x09-\x0D]+", text[r.doc_id])) for r in rows)
    check(rows)
    again = mixing.plan(docs.repartition(3)).collect()
    assert {(r.doc_id, r.taken) for r in rows} == {(r.doc_id, r.taken) for r in again}
    assert queries.op8_mix(spark, SF).columns == ["doc_id", "size", "source_size", "target", "taken"]


def test_many_small_blocks_and_skew(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 16)
    rnd = random.Random(5)
    rows = [(i, "big" if i % 3 == 0 else rnd.choice(["a", "b", "c", None, ""]), "w " * rnd.randint(0, 60)) for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    check(mixing.plan(df).collect())


def test_edges(spark):
    rows = [(1, "a", None, 5), (1, "a", None, 5), (2, None, "", 5), (3, "b", "x y z", 5), (3, "b", "x y z", 6), (None, "c", "one", 7), (9, "c", "word " * 5000, 8)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, size int")
    plan = mixing.plan(df).collect()
    assert len(plan) == len(rows)
    check(plan)
    out = mixing.mixed(df)
    assert out.columns == df.columns
    words = sum(r.taken for r in plan)
    assert words == sum(len((r.text or "").split()) for r in out.collect())
    assert mixing.plan(df.limit(0)).collect() == [] and mixing.mixed(df.limit(0)).collect() == []
    assert {r.target for r in mixing.plan(df.filter(F.col("doc_id") < 3)).collect()} == {0.0}


def test_rows_without_an_id(spark):
    rnd = random.Random(8)
    rows = [(None, rnd.choice("ab"), "w " * rnd.randint(0, 9), k) for k in range(400)] + [(k, "c", "v " * 7, k) for k in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, n int").repartition(5)
    plan = mixing.plan(df).collect()
    assert len(plan) == len(rows)
    check(plan)
    out = mixing.mixed(df).collect()
    assert sum(r.taken for r in plan) == sum(len(r.text.split()) for r in out)
    # no row more often than its source's rate allows, in every rerun the same
    times = defaultdict(int)
    for r in out:
        times[r.n, r.doc_id] += 1
    assert max(times.values()) <= 3
    again = mixing.mixed(df.repartition(3)).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))


def test_flight_holds_both_totals():
    rnd = random.Random(2)
    w = [rnd.randint(1, 500) for _ in range(400)]
    p = [0.37] * 400
    live = mixing.flight(p, w, rnd)
    assert len(live) <= 2 and all(x in (0.0, 1.0) for i, x in enumerate(p) if i not in live)
    assert abs(sum(p) - 0.37 * 400) < 1e-6 and abs(sum(a * b for a, b in zip(p, w)) - 0.37 * sum(w)) < 1e-4
