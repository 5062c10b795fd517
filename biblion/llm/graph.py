"""Connected components of links, as DataFrame operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from biblion.llm.base import cut, dropped

#: Rounds that the last call of ``components`` took; for tests.
last_rounds = 0


def components(edges: DataFrame) -> DataFrame:
    """id and component (the smallest id reachable) of every id in the links ``a``, ``b``, a table that is cheap to read.

    Vertices are contracted in a random order of their own, the hash of the
    id: each vertex goes to the first of itself and its neighbours, then from
    there once more, and links that become loops vanish.  The order of the ids
    plays no part, so a chain of ascending ids needs no more rounds than any
    other graph: their number grows with the logarithm of the vertices.  Minima
    are taken with partial aggregation, so a vertex with very many links is no
    hot group.  A round writes the steps of its vertices and the links that are
    left, both smaller than the round's before; the steps are chained at the end.
    Tables are removed when they have been read for the last time.

    Defined cases: null ends and loops are no links; repeated links count
    once; without links there are no rows.
    """
    global last_rounds
    edges, steps, last_rounds = edges.select("a", "b").filter("a <> b"), [], 0
    while True:
        last_rounds += 1
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        place = lambda c: F.struct(F.xxhash64(c).alias("o"), F.col(c).alias("v"))
        once = both.groupBy("a").agg(F.least(place("a"), F.min(place("b")))["v"].alias("to"))
        step = cut(once.join(once.select(F.col("a").alias("to"), F.col("to").alias("next")), "to").select("a", F.col("next").alias("to")))
        steps.append(step)
        moved = edges.join(step, "a").select(F.col("to").alias("a"), "b").join(step.select(F.col("a").alias("b"), F.col("to").alias("other")), "b")
        fewer = cut(moved.select(F.least("a", "other").alias("a"), F.greatest("a", "other").alias("b")).filter("a <> b").distinct())
        dropped(edges)
        edges = fewer
        if edges.isEmpty():
            break
    # every vertex takes part in the first round, its step in the next, and so on
    labels = steps[0].select(F.col("a").alias("id"), F.col("to").alias("root"))
    for step in steps[1:]:
        labels = labels.join(step.select(F.col("a").alias("root"), "to"), "root", "left").select("id", F.coalesce("to", "root").alias("root"))
    labels = cut(labels)
    smallest = labels.groupBy("root").agg(F.min("id").alias("component"))
    out = cut(labels.join(smallest, "root").select("id", "component"))
    dropped(edges, labels, *steps)
    return out
