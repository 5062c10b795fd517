import bisect
import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from biblion.llm import substring
from biblion.llm.base import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, length):
    words = [(i, WORD.findall(t or "")) for i, t in rows]
    first = defaultdict(lambda: None)
    for i, w in words:
        if i is not None:
            for k in range(len(w) - length + 1):
                x = tuple(w[k : k + length])
                first[x] = i if first[x] is None else min(first[x], i)
    out = []
    for i, w in words:
        gone = [False] * len(w)
        if i is not None:
            for k in range(len(w) - length + 1):
                if first[tuple(w[k : k + length])] < i:
                    gone[k : k + length] = [True] * length
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return sorted(out, key=str)


def got(df, length):
    rows = substring.deduplicated(df, length=length, with_text=True).collect()
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256, r.text) for r in rows), key=str)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_documents(spark, sf):
    docs = table(spark, f"/root/testdata/{sf}", "documents")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], 50)
    assert got(docs, 50) == want
    assert any(x[2] for x in want)


def test_random_overlaps(spark, monkeypatch):
    monkeypatch.setattr(substring, "BLOCK_BYTES", 400)
    rnd = random.Random(4)
    rows = [(rnd.randrange(-50, 400), " ".join(rnd.choice(["a", "b", "ab", "é"]) for _ in range(rnd.randint(0, 40)))) for _ in range(300)]
    rows += [(i, "one very common passage of words") for i in range(500, 800)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(df, 5) == brute(rows, 5)


def test_edges(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(None, text), (1, None), (2, ""), (3, text), (3, text), (4, text.replace(" ", "\n\t")), (5, "x " + text + " y"), (6, " \x0b"), (7, "a b " * 3), (8, "long " * 20000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(df, 50) == brute(rows, 50)
    wide = df.selectExpr("*", "1 AS n_words", "2 AS block")
    assert substring.deduplicated(wide).count() == len(rows)
    assert substring.deduplicated(df.limit(0)).collect() == []


def test_words_do_not_run_together():
    one, two = substring.windows(b"ab c", 2), substring.windows(b"a bc", 2)
    assert one[0][0] != two[0][0] and one[1][0] != two[1][0]


def test_equal_first_hashes_are_told_apart(spark, monkeypatch):
    """With a first hash of 3 bits only, the other half alone tells windows apart."""
    u = np.uint64
    a, b = np.array([5, 5, 5, 7, 5, 7], u), np.array([1, 2, 1, 1, 3, 9], u)
    by, new = substring._sorted(a, b)
    assert list(zip(a[by], b[by])) == sorted(zip(a, b)) and new.tolist() == [True, False, True, True, True, True]
    known_a, known_b = np.array([5, 5, 7], u), np.array([2, 3, 9], u)
    assert substring._member(a, b, known_a, known_b).tolist() == [False, True, False, False, True, True]
    assert substring._member(a, b, known_a[:0], known_b[:0]).tolist() == [False] * 6


def test_blocks_are_bounded_in_bytes(spark, monkeypatch):
    monkeypatch.setattr(substring, "BLOCK_BYTES", 40_000)
    rnd = random.Random(8)
    rows = [(i, "w " * rnd.choice([5, 5, 5, 5, 2000])) if i < 300 else (i, "w " * 2000) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    borders, blocks = substring._borders(docs, "doc_id", "text")
    size = defaultdict(int)
    for i, t in rows:
        size[bisect.bisect_left(borders, i)] += len(t)
    assert blocks >= 15 and max(size.values()) < 100_000
