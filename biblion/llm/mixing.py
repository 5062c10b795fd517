"""Mixing sources to target weights by balanced sampling (the cube method).

Every source gets a target number of words; the whole part of target / size
is taken of each of its documents, and the rest by a sample whose inclusion
probabilities are all that fraction.  The sample is drawn by the flight phase
of the cube method: three undecided documents at a time move along the null
space of the two constraints (words, documents) until one of them is decided,
so the totals of both stay as they were.

Flights run in blocks of ``BLOCK`` documents of one source, so a source that
holds a third of all rows is many groups.  Each block leaves two documents
undecided at most; these fly again together, level by level, until one block a
source is left, whose last two documents are decided by the landing: the choice
that comes nearest to the words due.  All of it is fixed by ids and ``seed``.

Defined cases: a null or empty text has size 0, and no words are taken of it; a
null source is a source of its own, last in order; rows without an id are told
apart by source and text; repeated rows are sampled each, and of equal ones it
doesn't matter which is taken once more; ties in the landing go to the first
choice in order; very long texts are taken whole; without any words, and in an
empty table, all targets are 0; other columns play no part in the plan and are
kept by ``mixed``, whatever their names.
"""

from __future__ import annotations

import random
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from biblion.llm.base import cut, fresh, word_count

BLOCK = 1024
MOST = 3


#: What tells rows apart: the id as text, whether it is null, a hash of source and text; equal rows besides by their number.
IDENTITY = ["k", "none", "h"]


def _identity(key: str, source: str, text: str) -> list[Column]:
    own = F.col(key)
    return [F.coalesce(own.cast("string"), F.lit("")), own.isNull(), F.xxhash64(F.lit(7), F.col(source), F.col(text))]


def sized(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """doc_id, source, size, the identity of the row and its number (from 1) among its equals.

    Rows without an id are told apart by their texts, so that they don't meet in
    one task; rows without words need no number.
    """
    same = [c.alias(n) for n, c in zip(IDENTITY, _identity(key, source, text), strict=True)]
    rows = docs.select(F.col(key).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"), *same)
    alone = F.when(F.col("size") == 0, F.monotonically_increasing_id())
    rows = rows.withColumn("_alone", alone)
    return rows.withColumn("nth", F.row_number().over(Window.partitionBy(*IDENTITY, "_alone").orderBy("size"))).drop("_alone")


def targets(sizes: DataFrame, most: int = MOST) -> DataFrame:
    """source, n, source_size, target: all words shared by weight, none above ``most`` times its source's size.

    Sources by size over weight: those that fill up come first, and the level
    at which the rest share what is left follows from running sums.  One row a
    source goes through the windows.
    """
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.when(F.col("size") > 0, 1)).alias("n"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    rows = total.withColumn("weight", (F.row_number().over(order) - 1) % 3 + 1)
    filled = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumns({"before": F.coalesce(F.sum("source_size").over(filled), F.lit(0)), "used": F.coalesce(F.sum("weight").over(filled), F.lit(0)), "words": F.sum("source_size").over(everything), "weights": F.sum("weight").over(everything)})
    level = (F.col("words") - most * F.col("before")) / (F.col("weights") - F.col("used"))
    rows = rows.withColumn("level", level).withColumn("full", F.col("level") * F.col("weight") > most * F.col("source_size"))
    rows = rows.withColumn("at", F.min(F.when(~F.col("full"), F.struct("used", "level"))).over(everything)["level"])
    return rows.select("source", "n", "source_size", F.when(F.col("full"), (most * F.col("source_size")).cast("double")).otherwise(F.coalesce(F.col("at"), F.lit(0.0)) * F.col("weight")).alias("target"))


def flight(p: list[float], w: list[int], rnd: random.Random) -> list[int]:
    """Move the probabilities ``p`` with sums of p and of p * w held, until two at most are undecided; their places."""
    live: list[int] = []
    for new in range(len(p)):
        if 0.0 < p[new] < 1.0:
            live.append(new)
        while len(live) > 2:
            a, b, c = live
            u = (w[b] - w[c], w[c] - w[a], w[a] - w[b])
            if not any(u):
                u = (1, -1, 0)
            up = min(((1 - p[i]) / x if x > 0 else p[i] / -x) for i, x in zip(live, u, strict=True) if x)
            down = min((p[i] / x if x > 0 else (1 - p[i]) / -x) for i, x in zip(live, u, strict=True) if x)
            step = up if rnd.random() * (up + down) < down else -down
            near = 1.0
            for i, x in zip(live, u, strict=True):
                p[i] += step * x
                near = min(near, abs(p[i]), abs(1 - p[i])) if x else near
            for i, x in zip(live, u, strict=True):
                if x and min(abs(p[i]), abs(1 - p[i])) <= near + 1e-12:
                    p[i] = float(p[i] > 0.5)
            live = [i for i in live if 0.0 < p[i] < 1.0]
    return live


def landing(p: list[float], w: list[int], live: list[int]) -> None:
    """Decide the last documents so that the words come nearest to what is due."""
    due = sum(p[i] * w[i] for i in live)
    best = min(range(1 << len(live)), key=lambda m: (abs(sum(w[i] for k, i in enumerate(live) if m >> k & 1) - due), m))
    for k, i in enumerate(live):
        p[i] = float(best >> k & 1)


def _fly(seed: int, level: int):
    def run(key: tuple, group: pa.Table) -> pa.Table:
        source, block = key[0].as_py(), key[1].as_py()
        rows = group.combine_chunks()
        own = list(zip(*(rows.column(c).to_pylist() for c in ("k", "none", "h", "nth")), strict=True))
        mixed = [zlib.crc32(f"{seed}/{k}/{h}/{n}".encode()) for k, _, h, n in own]
        order = sorted(range(len(own)), key=lambda i: (mixed[i], own[i]))
        rows = rows.take(pa.array(order, pa.int64()))
        p, w = rows.column("p").to_pylist(), rows.column("size").to_pylist()
        live = flight(p, w, random.Random(f"{seed}/{level}/{source}/{block}"))
        if rows.column("blocks")[0].as_py() == 1:
            landing(p, w, live)
        return rows.set_column(rows.schema.get_field_index("p"), "p", pa.array(p, pa.float64()))

    return run


def plan(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", seed: int = 0) -> DataFrame:
    """One row a document: doc_id, its identity and number, source, size, source_size, target, copies, taken."""
    sizes = cut(sized(docs, key, source, text))
    goal = cut(targets(sizes))
    rows = sizes.join(goal, sizes["source"].eqNullSafe(goal["source"])).drop(goal["source"])
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.least(F.floor(rate + 1e-12), F.lit(MOST))
    rows = rows.withColumn("whole", whole).withColumn("p", F.greatest(rate - F.col("whole"), F.lit(0.0)))
    rows = rows.withColumn("p", F.when(F.col("size") > 0, F.col("p")).otherwise(0.0))
    undecided = (F.col("p") > 0) & (F.col("p") < 1)
    done, left = rows.filter(~undecided).drop("n"), rows.filter(undecided)
    level = 0
    while True:
        # blocks of a source: as many as its undecided documents need
        left = left.withColumn("blocks", F.ceil(F.col("n") / BLOCK)).withColumn("block", F.pmod(F.xxhash64(*IDENTITY, "nth", F.lit(seed + level)), F.col("blocks"))).drop("n")
        shape = left.schema
        flown = cut(left.groupBy("source", "block").applyInArrow(_fly(seed, level), shape))
        done = done.unionByName(flown.filter(~undecided).select(done.columns))
        rest = flown.filter(undecided).drop("blocks", "block")
        if rest.isEmpty():
            break
        count = cut(rest.groupBy("source").agg(F.count("*").alias("n")))
        left = rest.join(count, rest["source"].eqNullSafe(count["source"])).drop(count["source"])
        level += 1
    copies = (F.col("whole") + F.round("p")).cast("long")
    return done.select("doc_id", *IDENTITY, "nth", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", seed: int = 0) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it.

    Of equal rows (one id, source and text) some are taken once more than the
    others; which of them is told by their other columns.  Texts are shuffled
    once: the join and the numbering need the same partitions.
    """
    taken = plan(docs, key, source, text, seed).groupBy(*IDENTITY).agg(F.min("copies").alias("low"), (F.sum("copies") - F.min("copies") * F.count("*")).alias("more"))
    names = {c: fresh(c, docs.columns) for c in (*IDENTITY, "nth", "copies")}
    own = [names[c] for c in IDENTITY]
    rows = docs.withColumns(dict(zip(own, _identity(key, source, text), strict=True)))
    taken = taken.filter("low + more > 0").select(*(F.col(c).alias(names[c]) for c in IDENTITY), F.struct("low", "more").alias(names["copies"]))
    both = rows.join(taken, own)
    told = [c for c in docs.columns if "map<" not in docs.schema[c].dataType.simpleString()]
    number = F.row_number().over(Window.partitionBy(*own).orderBy(F.xxhash64(*told)))
    times = F.col(names["copies"])["low"] + (F.col(names["nth"]) <= F.col(names["copies"])["more"]).cast("int")
    out = both.withColumn(names["nth"], number).withColumn(names["copies"], times).filter(F.col(names["copies"]) > 0)
    return out.withColumn(names["nth"], F.explode(F.sequence(F.lit(1), F.col(names["copies"]).cast("int")))).select(docs.columns)
