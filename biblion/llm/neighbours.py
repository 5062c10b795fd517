"""Approximate nearest neighbours by a hash-prefix forest.

Every vector gets, in each tree, a long string of sign bits of random
projections; a tree is the sorted array of these strings.  A query descends in
every tree to the longest prefix that it shares with any string.  From there
all trees ascend together, one bit at a time; each step brings the strings that
share the shorter prefix.  The ascent ends as soon as a neighbour as near as
the k-th best so far would have been missed by all trees with a probability of
``MISSED`` at most: two vectors at an angle t agree in a bit with probability
1 - t / pi, in a prefix of x bits with its x-th power.  Where vectors cluster
few candidates suffice; where they don't, the trees ascend nearly to the root.
Candidates are ranked by their exact distance on the vectors as they are.

The strings are made once and written with the vectors.  A block of ``BLOCK``
rows of that table has sorted arrays of its own and answers a chunk of at most
``CHUNK`` queries, which is sent to all tasks: rows are shuffled nowhere, and a
chunk has a fixed size.  The descent of all blocks gives the k best so far;
with them each block ascends.  A block passes on its k best of each query.

The centre of the projections is the mean of ``SAMPLE`` vectors; every row is
indexed.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components take no part, nor do rows without an id; every row but the query's
own is a candidate, so rows with one id count each, and each of them that is a
query is answered; vectors of other lengths than the query's are no candidates;
a query with fewer candidates gets them all; without candidates, and in an empty
table, there are no rows; ties go to the smaller id; other columns, whatever
their names, play no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from biblion.llm.base import bounded, cut, dropped, fresh
from biblion.llm.forest import components_type, matrix, usable

TREES, BITS = 16, 32
MISSED = 0.05
#: Queries that are sent at once, and those of them that a block answers together.
CHUNK, TOGETHER = 16_384, 256
#: Rows of a block at most.
BLOCK = 65_536
#: Vectors on which the centre of the projections is measured.
SAMPLE = 10_000


def strings(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """(trees, rows): the hash string of each vector as an integer, first bit highest."""
    planes = np.random.default_rng(11).standard_normal((TREES, BITS, x.shape[1]))
    weight = np.uint64(1) << np.arange(BITS - 1, -1, -1, dtype=np.uint64)
    x = x - centre
    return np.stack([((x @ p.T >= 0).astype(np.uint64) * weight).sum(axis=1, dtype=np.uint64) for p in planes])


def level_for(angle: float) -> int:
    """The longest prefix at which the trees miss a neighbour at this angle seldom enough."""
    p = min(max(1 - angle / math.pi, 1e-9), 1 - 1e-9)
    return max(0, min(BITS, math.floor(math.log(1 - MISSED ** (1 / TREES)) / math.log(p))))


class Forest:
    """The sorted arrays of a block's strings."""

    def __init__(self, found: np.ndarray):
        self.order = np.argsort(found, axis=1, kind="stable")
        self.sorted = np.take_along_axis(found, self.order, axis=1)

    def ranges(self, query: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        """(trees, queries): where the strings that share ``level`` bits begin and end."""
        low = BITS - level
        first = (query >> np.uint64(low)) << np.uint64(low)
        last = first | np.uint64((1 << low) - 1)
        pairs = [(np.searchsorted(s, a, "left"), np.searchsorted(s, b, "right")) for s, a, b in zip(self.sorted, first, last, strict=True)]
        return np.stack([a for a, _ in pairs]), np.stack([b for _, b in pairs])

    def descent(self, query: np.ndarray) -> int:
        """The longest prefix that any query shares with any string: bits at most."""
        best = 0
        for s, q in zip(self.sorted, query, strict=True):
            at = np.searchsorted(s, q)
            for side in (np.maximum(at - 1, 0), np.minimum(at, len(s) - 1)):
                least = int((s[side] ^ q).min())
                best = max(best, BITS - least.bit_length())
        return best


class Best:
    """The k best rows of a query so far: of this block, and of all blocks for the bound."""

    def __init__(self, k: int, known: tuple[np.ndarray, np.ndarray, np.ndarray] | None):
        self.k, self.rows, self.scores = k, np.zeros(0, np.int64), np.zeros(0)
        self.at, self.bound, self.angles = known or (np.zeros(0, np.int64), np.zeros(0), np.zeros(0))

    def add(self, rows: np.ndarray, scores: np.ndarray, at: np.ndarray, ids: np.ndarray, angle) -> None:
        if len(rows) > self.k:  # those beyond the k-th smallest score can't stay; ties do
            near = scores <= np.partition(scores, self.k - 1)[self.k - 1]
            rows, scores = rows[near], scores[near]
        rows, scores = np.r_[self.rows, rows], np.r_[self.scores, scores]
        by = np.lexsort((at[rows], ids[rows], scores))[: self.k]
        self.rows, self.scores = rows[by], scores[by]
        new = self.rows[~np.isin(at[self.rows], self.at)]
        if len(new):
            score = self.scores[np.isin(self.rows, new)]
            all_scores, all_at, all_angles = np.r_[self.bound, score], np.r_[self.at, at[new]], np.r_[self.angles, angle(new)]
            by = np.argsort(all_scores, kind="stable")[: self.k]
            self.bound, self.at, self.angles = all_scores[by], all_at[by], all_angles[by]

    def enough(self) -> int:
        """The level at which the ascent may end; below 0 while fewer than k are known."""
        return level_for(float(self.angles.max())) if len(self.angles) >= self.k else -1


def answered(block: dict[str, np.ndarray], asked: dict[str, np.ndarray], k: int, centre: np.ndarray, known: dict | None, visited: list | None = None) -> tuple[list, list, list, list]:
    """query (its place), row, score and angle of the k best candidates in a block.

    Without ``known`` (the best of all blocks so far) the ascent ends when a
    query has k candidates here; with it, when the bound says so.
    """
    forest, ids, at, x = Forest(block["s"]), block["id"], block["at"], block["v"]
    length = np.linalg.norm(x - centre, axis=1)
    out: tuple[list, list, list, list] = ([], [], [], [])
    for start in range(0, len(asked["id"]), TOGETHER):
        some = np.arange(start, min(start + TOGETHER, len(asked["id"])))
        hashed, q = asked["s"][:, some], asked["v"][some]
        seen = np.zeros((len(some), len(ids)), bool)
        seen[asked["at"][some][:, None] == at[None, :]] = True  # the query's own row
        best = [Best(k, known.get(int(i)) if known is not None else None) for i in some]
        active = np.arange(len(some))
        low, high = np.zeros((TREES, len(some)), np.int64), np.zeros((TREES, len(some)), np.int64)

        def angle(i: int):
            here = q[i] - centre

            def of(rows: np.ndarray) -> np.ndarray:
                cosine = ((x[rows] - centre) @ here) / np.maximum(length[rows] * np.linalg.norm(here), 1e-300)
                return np.arccos(np.clip(cosine, -1, 1))

            return of

        for level in range(forest.descent(hashed), -1, -1):
            begin, end = forest.ranges(hashed[:, active], level)
            going = []
            for j, i in enumerate(active.tolist()):
                parts = []
                for t, (a, b, c, d) in enumerate(zip(begin[:, j].tolist(), low[:, i].tolist(), high[:, i].tolist(), end[:, j].tolist(), strict=True)):
                    if b == c:  # nothing before
                        if a < d:
                            parts.append(forest.order[t, a:d])
                    elif a < b or c < d:  # what the shorter prefix adds on either side
                        parts += [forest.order[t, a:b], forest.order[t, c:d]]
                if parts:
                    fresh_rows = np.concatenate(parts)
                    fresh_rows = np.unique(fresh_rows[~seen[i, fresh_rows]])
                    if len(fresh_rows):
                        seen[i, fresh_rows] = True
                        gap = x[fresh_rows] - q[i]
                        best[i].add(fresh_rows, np.sqrt((gap * gap).sum(axis=1)), at, ids, angle(i))
                done = len(best[i].rows) >= k if known is None else level <= best[i].enough()
                if not done:
                    going.append(j)
            low[:, active], high[:, active] = begin, end
            active = active[going]
            if not len(active):
                break
        if visited is not None:
            visited += seen.sum(axis=1).tolist()
        for i, b in zip(some.tolist(), best, strict=True):
            out[0].extend([i] * len(b.rows))
            out[1].extend(b.rows.tolist())
            out[2].extend(b.scores.tolist())
            out[3].extend(angle(i - start)(b.rows).tolist())
    return out


def _table(rows: pa.Table | pa.RecordBatch, dims: int) -> dict[str, np.ndarray]:
    s = np.asarray(rows.column("s").combine_chunks().flatten() if isinstance(rows, pa.Table) else rows.column("s").flatten())
    return {"id": np.asarray(rows.column("id")), "at": np.asarray(rows.column("at")), "v": matrix(rows.column("v"), dims), "s": s.reshape(-1, TREES).T.astype(np.uint64)}


def _nearest(sent, k: int, centre: np.ndarray):
    """Over blocks of rows: the k best candidates of each query of a chunk."""
    dims = len(centre)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
        held, n = [], 0
        for batch in batches:
            for start in range(0, len(batch), BLOCK):
                part = batch.slice(start, BLOCK)
                if n + len(part) > BLOCK:
                    yield _table(pa.Table.from_batches(held), dims)
                    held, n = [], 0
                held.append(part)
                n += len(part)
        if n:
            yield _table(pa.Table.from_batches(held), dims)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, known = sent.value
        for block in blocks(batches):
            query, row, score, angle = answered(block, asked, k, centre, known)
            yield pa.RecordBatch.from_arrays([pa.array(query, pa.int64()), pa.array(block["at"][row], pa.int64()), pa.array(block["id"][row], pa.int64()), pa.array(score, pa.float64()), pa.array(angle, pa.float64())], names=["query", "at", "vec_id", "score", "angle"])

    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy("score", "vec_id", "at")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _indexed(rows: DataFrame, centre: np.ndarray) -> DataFrame:
    """``rows`` with the strings of each vector, written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                found = strings(matrix(batch.column(batch.schema.get_field_index("v")), len(centre)), centre).T.astype(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(batch) + 1, dtype=np.int32) * TREES), pa.array(found.ravel()))
                yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, "s"])

    kind = rows.schema["v"].dataType.simpleString()
    return cut(rows.mapInArrow(run, f"id long, at long, v {kind}, asks boolean, s array<long>"))


def _searched(rows: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score among vectors of one length."""
    spark = rows.sparkSession
    sample = rows.select("v").orderBy(F.xxhash64("at"), "at").limit(SAMPLE).toArrow()
    centre = matrix(sample.column("v"), len(sample.column("v")[0])).mean(axis=0)
    index = _indexed(rows, centre)
    asking = index.filter("asks")
    chunks = max(1, math.ceil(asking.count() / CHUNK))
    out = None
    for chunk in range(chunks):  # each of a bounded size
        asked = _table(asking.filter(F.pmod(F.xxhash64("at"), F.lit(chunks)) == chunk).drop("asks").toArrow().sort_by("at"), len(centre))
        if not len(asked["id"]):
            continue
        schema = "query long, at long, vec_id long, score double, angle double"

        def search(known: dict | None) -> DataFrame:
            sent = spark.sparkContext.broadcast((asked, known))
            return _best(index.drop("asks").mapInArrow(_nearest(sent, k, centre), schema), k)

        first = cut(search(None).drop("rank"))
        table, known = first.orderBy("query", "score").toArrow(), {}
        query = np.asarray(table.column("query"))
        border = np.searchsorted(query, np.arange(len(asked["id"]) + 1))
        at, score, angle = (np.asarray(table.column(c)) for c in ("at", "score", "angle"))
        for i in range(len(asked["id"])):
            a, b = border[i], border[i + 1]
            known[i] = (at[a:b], score[a:b], angle[a:b])
        second = search(known).drop("rank")
        ids = spark.createDataFrame(list(zip(range(len(asked["id"])), asked["id"].tolist(), strict=True)), "query long, query_id long")
        best = _best(first.unionByName(second).dropDuplicates(["query", "at"]), k)
        part = cut(best.join(ids, "query").select("query_id", "rank", "vec_id", "score"))
        dropped(first)
        out = part if out is None else out.unionByName(part)
    dropped(index)
    return out if out is not None else rows.selectExpr("id AS query_id", "0 AS rank", "id AS vec_id", "0D AS score").limit(0)


def searched(df: DataFrame, asks: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each row for which ``asks`` holds."""
    at = fresh("at", df.columns)
    bounded(df.sparkSession)
    rows = df.withColumn(at, F.monotonically_increasing_id())
    rows = rows.select(F.col(key).cast("long").alias("id"), F.col(at).alias("at"), F.col(vector).cast(components_type(df, vector)).alias("v"), F.coalesce(asks, F.lit(False)).alias("asks"))
    rows = cut(rows.filter(F.col("id").isNotNull() & usable(F.col("v"))))
    out = None
    for (dims,) in rows.select(F.size("v")).distinct().orderBy(F.size("v")).collect():
        part = _searched(rows.filter(F.size("v") == dims), k)
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = rows.selectExpr("id AS query_id", "0 AS rank", "id AS vec_id", "0D AS score")
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
