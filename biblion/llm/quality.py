"""Quality classifier by compression.

Two zstandard dictionaries are built from good and from bad labelled texts.
Every text is compressed with either; the difference of the two sizes, divided
by the text's own size, tells which kind it resembles, and a logistic curve
fitted on further labelled texts turns it into the probability of label 1.
The curve also sees the better of the two ratios, since a text that repeats
itself shrinks under any dictionary and then has hardly a difference.

The fit uses a bounded sample of labelled rows: ``FOR_DICTIONARY`` +
``FOR_CURVE`` texts of each class, those of the smallest hash, of at most
``SAMPLE_BYTES`` each.  Scoring reads every whole text in one Arrow pass and
shuffles nothing; the model that is sent to the executors has a fixed size.

Defined cases: null and empty texts score as the text of no bytes does, by the
curve's constant; an empty table gives an empty table; labels that are null, not
0 or 1, or contradict one another for a document are not learnt from, nor are
those without a document of a fitting size; without labels of both classes every
score is the share of label 1 (0.5 without any); a score of just 0.5 counts as
good; rows with equal ids are scored each; very long texts are scored whole;
other columns stay as they are, but for ``score`` and ``predicted``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from biblion.llm.base import bounded, cut, dropped, fresh, slices

FOR_DICTIONARY = 1000
FOR_CURVE = 3000
SAMPLE_BYTES = 32_768
DICTIONARY_BYTES = 112_640
LEVEL = 3


@dataclass(frozen=True)
class Model:
    """What is sent to the executors: two dictionaries and a curve."""

    good: bytes
    bad: bytes
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def scorer(self) -> Scorer:
        return Scorer(self)


class Scorer:
    def __init__(self, model: Model):
        self.model = model
        self.good, self.bad = compressor(model.good), compressor(model.bad)

    def features(self, texts: list[str | None]) -> np.ndarray:
        return features(self.good, self.bad, texts)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        return probability(self.model, self.features(texts))


def probability(model: Model, x: np.ndarray) -> np.ndarray:
    z = np.c_[np.ones(len(x)), (x - model.mean) / model.scale] @ model.weights
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    plain = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
    if not dictionary:
        return zstandard.ZstdCompressor(level=LEVEL, **plain)
    made = zstandard.ZstdCompressionDict(dictionary)
    made.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=made, **plain)


def features(good: zstandard.ZstdCompressor, bad: zstandard.ZstdCompressor, texts: list[str | None]) -> np.ndarray:
    """Of each text: normalised difference d, better ratio r, and d*d, r*r, d*r."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    n = np.array([max(len(x), 1) for x in raw], float)
    g = np.array([len(good.compress(x)) if x else 0 for x in raw], float)
    b = np.array([len(bad.compress(x)) if x else 0 for x in raw], float)
    d, r = (b - g) / n, np.minimum(g, b) / n
    return np.stack([d, r, d * d, r * r, d * r], axis=1).reshape(len(raw), 5)


def dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary; of few or short samples, their plain text."""
    samples = [x for x in samples if x]
    if sum(map(len, samples)) > 20 * 1024:
        try:
            return zstandard.train_dictionary(min(DICTIONARY_BYTES, sum(map(len, samples)) // 4), samples, level=LEVEL).as_bytes()
        except zstandard.ZstdError:
            pass
    joined = b"\n".join(samples)[:DICTIONARY_BYTES]
    return joined if len(joined) >= 8 else b""


def curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-4) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logistic regression by Newton's method with halved steps."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    a = np.c_[np.ones(len(x)), (x - mean) / scale]
    weight = weight / weight.sum()
    hold = ridge * np.r_[0.0, np.ones(x.shape[1])]
    w = np.zeros(a.shape[1])

    def loss(w: np.ndarray) -> float:
        z = a @ w
        return float((weight * (np.logaddexp(0, z) - y * z)).sum() + 0.5 * (hold * w * w).sum())

    now = loss(w)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -40, 40)))
        slope = a.T @ (weight * (p - y)) + hold * w
        bend = (a * (weight * p * (1 - p))[:, None]).T @ a + np.diag(hold + 1e-9)
        step = np.linalg.solve(bend, slope)
        size = 1.0
        while size > 1e-6 and loss(w - size * step) > now:
            size /= 2
        w, before, now = w - size * step, now, loss(w - size * step)
        if before - now < 1e-10:
            break
    return mean, scale, w


def learnable(labels: DataFrame, key: str, label: str, among: Column) -> DataFrame:
    """One row (key, y) for each document with one clear label."""
    good = F.col(label).isin(0, 1) & F.col(key).isNotNull() & F.coalesce(among, F.lit(False))
    return labels.filter(good).groupBy(F.col(key).alias("_id")).agg(F.min(label).alias("y"), F.max(label).alias("_most")).filter("y = _most").select("_id", F.col("y").cast("int").alias("y"))


def fit(docs: DataFrame, labels: DataFrame, among: Column, key: str = "doc_id", text: str = "text", label: str = "quality") -> Model:
    """Learn from the labelled rows for which ``among`` (of ``key``) holds.

    Only documents whose texts may be learnt from are counted and sampled, so
    long texts and labels without a document leave the sample as large as it
    can be.
    """
    texts = docs.select(F.col(key).alias("_id"), F.col(text).alias("_text")).filter(F.octet_length("_text").between(1, SAMPLE_BYTES))
    known = cut(learnable(labels, key, label, among).join(texts.select("_id"), "_id", "left_semi"))
    counts = {r.y: r.n for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    order = F.xxhash64("_id")
    rows = []
    for y in sorted(counts):
        # a bounded number of ids: broadcasting them spares shuffling the texts
        some = known.filter(F.col("y") == y).orderBy(order, "_id").limit(FOR_DICTIONARY + FOR_CURVE)
        found = texts.join(F.broadcast(some), "_id").orderBy(order, "_id", "_text").limit(FOR_DICTIONARY + FOR_CURVE)
        rows += [(r.y, r._text) for r in found.select("y", "_text").collect()]
    dropped(known)
    return fitted({y: [t for z, t in rows if z == y] for y in (0, 1)}, counts)


def fitted(texts: dict[int, list[str]], counts: dict[int, int]) -> Model:
    share = counts.get(1, 0) / max(1, sum(counts.values())) if counts else 0.5
    first = {y: min(FOR_DICTIONARY, len(x) // 2) for y, x in texts.items()}
    rest = {y: x[first[y] :] for y, x in texts.items()}
    if not all(first.values()):
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Model(b"", b"", np.zeros(5), np.ones(5), np.r_[np.log(share / (1 - share)), np.zeros(5)])
    bad, good = (dictionary([t.encode("utf-8", "surrogatepass") for t in texts[y][: first[y]]]) for y in (0, 1))
    x = np.concatenate([features(compressor(good), compressor(bad), rest[y]) for y in (0, 1)])
    y = np.r_[np.zeros(len(rest[0])), np.ones(len(rest[1]))]
    weight = np.r_[np.full(len(rest[0]), counts[0] / len(rest[0])), np.full(len(rest[1]), counts[1] / len(rest[1]))]
    return Model(good, bad, *curve(x, y, weight))


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with score and predicted instead of its text."""
    return _mapped(docs, model, text, keep_text=False)


def accepted(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the model predicts to be good, unchanged."""
    flag = fresh("accepted", docs.columns)
    return _mapped(docs, model, text, keep_text=True, flag=flag).filter(F.col(flag) == 1).drop(flag)


def _mapped(docs: DataFrame, model: Model, text: str, keep_text: bool, flag: str | None = None) -> DataFrame:
    bounded(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    new = [flag] if flag else ["score", "predicted"]
    kept = [f for f in docs.schema if f.name not in new and (keep_text or f.name != text)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = sent.value.scorer()
        for batch in (part for whole in batches for part in slices(whole)):
            at = batch.schema.get_field_index
            p = scorer.scores(batch.column(at(text)).to_pylist())
            says = pa.array((p >= 0.5).astype("i4"))
            made = [says] if flag else [pa.array(p, pa.float64()), says]
            yield pa.RecordBatch.from_arrays([*(batch.column(at(f.name)) for f in kept), *made], names=[*(f.name for f in kept), *new])

    kinds = ["int"] if flag else ["double", "int"]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), *(f"`{n}` {k}" for n, k in zip(new, kinds, strict=True))])
    return docs.mapInArrow(run, schema)


def held_out(key: Column) -> Column:
    """True for the third of the ids that nothing is learnt from; false for a null id."""
    return F.coalesce(F.crc32(key.cast("string")) % 3 == 1, F.lit(False))
