from collections import Counter

import corpus_pipeline
import pytest
from biblion.llm import bpe, mixing
from biblion.llm.base import cut, table
from biblion.llm.queries import vocabulary_path

from tests.llm import test_lines, test_minhash

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark):
    docs, out = table(spark, SF, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = cut(stage(spark, docs, SF))
        out.append((name, docs))
    return out


def test_names(steps):
    assert [n for n, _ in steps] == ["quality classifier", "line dedup", "MinHash near-dedup", "mixing sources to target weights", "BPE encoding and decoding"]


def test_columns_stay(spark, steps):
    for _, docs in steps[:-1]:
        assert docs.columns == table(spark, SF, "documents").columns


def test_quality_keeps_the_good(spark, steps):
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    kept = {r.doc_id for r in steps[0][1].collect()}
    good = [i for i, q in labels.items() if q == 1]
    assert sum(i in kept for i in good) / len(good) > 0.97
    assert sum(i not in kept for i, q in labels.items() if q == 0) > 0.6 * sum(q == 0 for q in labels.values())


def test_lines_against_brute_force(steps):
    want = test_lines.brute([(r.doc_id, r.text) for r in steps[0][1].collect()])
    got = sorted(((r.doc_id, r.text) for r in steps[1][1].collect()), key=str)
    assert got == [(i, t) for i, _, _, t in want]
    assert all(r.n_chars == len(r.text) for r in steps[1][1].collect())


def test_near_copies_against_brute_force(steps):
    want = test_minhash.brute([(r.doc_id, r.text) for r in steps[1][1].collect()], 5, 80)
    assert sorted(r.doc_id for r in steps[2][1].collect()) == sorted(i for i, _, _, kept in want if kept)


def test_mix_takes_what_the_plan_says(steps):
    plan = {r.doc_id: r.copies for r in mixing.plan(steps[2][1]).collect()}
    assert Counter(r.doc_id for r in steps[3][1].collect()) == Counter({i: c for i, c in plan.items() if c})


def test_tokens(steps):
    with open(vocabulary_path(), "rb") as f:
        own = bpe.loaded(f.read())
    texts = {r.doc_id: r.text for r in steps[3][1].collect()}
    rows = steps[4][1].collect()
    assert len(rows) == steps[3][1].count()
    assert all(r.n_tokens == len(own.encode(texts[r.doc_id])) // 4 for r in rows)


def test_run_gives_the_same(spark, steps):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert Counter((r.doc_id, r.ids_sha256) for r in rows) == Counter((r.doc_id, r.ids_sha256) for r in steps[4][1].collect())


EXTRA = "doc_id long, text string, lang string, source string, n_chars long, gone int, lines string, H int, copies int, score double, k string, nth int, accepted int, bands string, block int, n_tokens int"


def odd_rows():
    passage = "\n".join(f"line {k} of a passage that stands here and there" for k in range(12))
    words = " ".join(f"w{k}" for k in range(80))
    texts = [(1, None), (2, ""), (3, " \n\t"), (None, words), (None, None), (None, ""), (4, words), (4, words), (4, passage), (5, words + " more"), (6, passage), (7, "x\n" * 300), (8, "word " * 30_000), (9, "one"), (9, "one")]
    return [(i, t, "en", None if n % 3 == 0 else "s", 5, 1, "x", 2, 3, 0.1, "k", n, 0, None, 4, 6) for n, (i, t) in enumerate(texts)]


@pytest.mark.parametrize("at", range(5))
def test_odd_rows_and_names(spark, at):
    docs = spark.createDataFrame(odd_rows(), EXTRA)
    name, stage = corpus_pipeline.STAGES[at]
    out = stage(spark, docs, SF)
    rows = out.collect()
    if at < 4:
        assert out.columns == docs.columns and all(r.lang == "en" and r.lines == "x" and r.H == 2 and r.nth < 15 for r in rows)
    kept = Counter((r.doc_id, r.nth) for r in rows) if at < 4 else None
    if at == 0:  # null and empty texts share one fate
        assert len({r.nth in {x.nth for x in rows} for r in docs.collect() if not r.text}) == 1
    if at == 1:
        assert len(rows) == len(docs.collect()) and all((r.text is None) == (r.n_chars is None) for r in rows)
        assert {r.text for r in rows if r.doc_id is None} == {t for i, t, *_ in odd_rows() if i is None}
    if at == 2:
        want = test_minhash.brute([(i, t) for i, t, *_ in odd_rows()], 5, 80)
        assert sorted(str(r.doc_id) for r in rows) == sorted(str(i) for i, _, _, k in want if k)
    if at == 3:
        assert max(kept.values()) <= 3
    if at == 4:
        assert len(rows) == len(odd_rows()) and {r.n_tokens for r in rows if r.doc_id in (1, 2, 3)} == {0}


@pytest.mark.parametrize("at", range(5))
def test_no_rows(spark, at):
    docs = spark.createDataFrame([], EXTRA)
    out = corpus_pipeline.STAGES[at][1](spark, docs, SF)
    assert out.collect() == [] and (at == 4 or out.columns == docs.columns)
