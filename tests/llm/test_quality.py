import math
import zlib

import numpy as np
import zstandard
from biblion.llm import quality, queries
from biblion.llm.base import table
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.1"


def auc(score, y):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    n = y.sum()
    return (rank[y == 1].sum() - n * (n + 1) / 2) / n / (len(y) - n)


def test_held_out_accuracy(spark):
    got = queries.op3_quality(spark, SF)
    assert got.count() == table(spark, SF, "documents").count()
    rows = got.join(table(spark, SF, "labels"), "doc_id").filter("held_out").select("doc_id", "score", "predicted", "quality").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in rows)
    y, s = np.array([r.quality for r in rows]), np.array([r.score for r in rows])
    assert auc(s, y) > 0.97
    assert ((s >= 0.5) == np.array([r.predicted for r in rows])).all()
    assert (s[y == 1] >= 0.5).mean() > 0.98
    assert (s[y == 0] < 0.5).mean() > 0.7
    assert abs(s.mean() - y.mean()) < 0.05


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, 7), (2, "", 7), (None, "x", 7), (4, "fine words " * 4000, None), (4, "fine words " * 4000, None)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(1, 1), (2, 0), (4, None), (4, 5), (7, 0), (7, 1)], "doc_id long, quality int")
    model = quality.fit(docs, labels, F.lit(True))
    got = quality.score(docs, model)
    assert got.columns == ["doc_id", "score", "predicted"]
    rows = got.collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    none = quality.fit(docs, labels.limit(0), F.lit(True))
    assert {r.score for r in quality.score(docs, none).collect()} == {0.5}
    assert quality.score(docs.limit(0), model).collect() == []
    assert quality.accepted(docs, none).columns == docs.columns
    assert quality.accepted(docs, none).count() == 5


def test_small_model_separates():
    good = [f"the small house stood by river number {i} and the people were kind" for i in range(40)]
    bad = [f"BUY!! NOW!! {i}!! CHEAP!! OFFER!!" for i in range(20)]
    model = quality.fitted({1: good, 0: bad}, {1: 40, 0: 20})
    s = model.scorer().scores(["the small house stood by river number 77 and the people were kind", "BUY!! NOW!! 77!! CHEAP!! OFFER!!"])
    assert s[0] > 0.5 > s[1]


def plain_score(model, text):
    """The score of one text, step by step: fresh compressors, the difference by length, the curve."""
    raw = (text or "").encode("utf-8")
    sizes = []
    for samples in (model.good, model.bad):
        made = zstandard.ZstdCompressor(level=quality.LEVEL, dict_data=zstandard.ZstdCompressionDict(samples), write_content_size=False, write_checksum=False, write_dict_id=False)
        sizes.append(len(made.compress(raw)) if raw else 0)
    d, r = (sizes[1] - sizes[0]) / max(1, len(raw)), min(sizes) / max(1, len(raw))
    z = model.weights[0]
    for x, mean, scale, w in zip((d, r, d * d, r * r, d * r), model.mean, model.scale, model.weights[1:], strict=True):
        z += (x - mean) / scale * w
    return 1 / (1 + math.exp(-max(-40, min(40, z))))


def test_whole_table_against_a_plain_scorer(spark):
    sf = "/root/testdata/sf0.01"
    docs = table(spark, sf, "documents")
    model = quality.fit(docs, table(spark, sf, "labels"), ~quality.held_out(F.col("doc_id")))
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = queries.op3_quality(spark, sf).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        assert abs(r.score - plain_score(model, texts[r.doc_id])) < 1e-9
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == int(r.score >= 0.5)


def test_the_size_difference_alone_tells_the_classes_apart(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    scorer = quality.fit(docs, labels, ~quality.held_out(F.col("doc_id"))).scorer()
    held = docs.join(labels, "doc_id").filter(quality.held_out(F.col("doc_id")) & F.col("quality").isin(0, 1)).select("text", "quality").collect()
    d = scorer.features([r.text for r in held])[:, 0]
    assert auc(d, np.array([r.quality for r in held])) > 0.97


def test_long_texts_and_lost_documents_leave_the_sample_whole(spark, monkeypatch):
    monkeypatch.setattr(quality, "FOR_DICTIONARY", 4)
    monkeypatch.setattr(quality, "FOR_CURVE", 6)
    kinds = {0: "bad!! ", 1: "good words "}
    rows = [(i, kinds[i % 2] * (9000 if i < 200 else 5 + i % 3)) for i in range(240)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality, "fitted", lambda texts, counts: seen.append((texts, counts)))
    quality.fit(docs, labels, F.lit(True))
    texts, counts = seen[0]
    assert {y: len(x) for y, x in texts.items()} == {0: 10, 1: 10} and counts == {0: 20, 1: 20}
