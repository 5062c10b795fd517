"""Embedding near-dedup by a forest of random-projection trees.

Each tree halves the space again and again along random directions, at the
median of a bounded sample; vectors near a border go down both sides (spill),
so that close pairs seldom part.  Vectors of one label that meet in a leaf are
compared exactly, in double precision; links are united into components.

A pair counts in the first leaf only in which both meet, which each leaf can
tell since every vector carries the numbers of its leaves; so pairs never leave
the leaf: it passes on, for each vector, the number of its links and the root
of its component within the leaf.

Equal vectors of one label form one class before the trees, so copies are one
row.  A leaf with more than ``LEAF_MOST`` vectors (a dense spot that no
direction parts) is dealt into blocks, and each pair of blocks is a task of its
own: all its pairs are still compared, and no task holds more than two blocks.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components, and rows without a label, link with nothing and are components of
their own; vectors of different lengths never link; a cosine that equals the
threshold links; repeated rows count as vectors of their own; rows without an id
link with nothing and have no component; an empty table gives an empty table;
other columns, whatever their names, play no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from biblion.llm.base import bounded, cut, dropped
from biblion.llm.graph import components

TREES = 8
#: Vectors of one label that a leaf should hold, and those beyond which it is dealt into blocks.
LEAF, LEAF_MOST = 400, 1500
#: The trees are fitted on so many vectors (those of the smallest hash).
SAMPLE = 20_000
#: Half the width of the spill zone, in standard deviations of the gap of a pair at the threshold.
SPILL = 0.5


@dataclass
class Tree:
    """Inner nodes in arrays; a child below 0 is leaf number -1 - child."""

    directions: list[np.ndarray] = field(default_factory=list)
    borders: list[float] = field(default_factory=list)
    children: list[list[int]] = field(default_factory=list)
    leaves: int = 0


def grow(sample: np.ndarray, depth: int, rnd: np.random.Generator) -> Tree:
    tree = Tree()

    def node(rows: np.ndarray, left: int) -> int:
        if left == 0 or len(rows) < 8:
            tree.leaves += 1
            return -tree.leaves
        direction = rnd.standard_normal(sample.shape[1])
        direction /= np.linalg.norm(direction)
        along = sample[rows] @ direction
        border = float(np.median(along))
        if not (along < border).any():
            tree.leaves += 1
            return -tree.leaves
        me = len(tree.directions)
        tree.directions.append(direction)
        tree.borders.append(border)
        tree.children.append([0, 0])
        tree.children[me] = [node(rows[along < border], left - 1), node(rows[along >= border], left - 1)]
        return me

    node(np.arange(len(sample)), depth)
    return tree


def descend(tree: Tree, x: np.ndarray, margin: float) -> Iterator[tuple[int, np.ndarray]]:
    """Each leaf of a tree and the rows of ``x`` that come down to it, by one side or both."""
    if not tree.directions:
        yield 0, np.arange(len(x))
        return
    todo = [(0, np.arange(len(x)))]
    while todo:
        at, rows = todo.pop()
        if at < 0:
            yield -1 - at, rows
            continue
        off = x[rows] @ tree.directions[at] - tree.borders[at]
        for child, side in zip(tree.children[at], (off < margin, off >= -margin), strict=True):
            if side.any():
                todo.append((child, rows[side]))


def usable(vector: Column) -> Column:
    """Not null nor empty, all components finite, and not zero."""
    finite = F.forall(vector, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) != float("inf")), F.lit(False)))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda v: v != 0), F.lit(False))


def components_type(df: DataFrame, vector: str) -> str:
    """The type in which vectors are kept as they are: floats as floats, all other numbers as doubles."""
    kind = df.schema[vector].dataType.simpleString()
    return kind if kind == "array<float>" else "array<double>"


def matrix(column: pa.Array | pa.ChunkedArray, dims: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten(), np.float64).reshape(len(column), dims)


def unit(x: np.ndarray) -> np.ndarray:
    # scaled first, so that squares neither vanish nor overflow
    x = x / np.abs(x).max(axis=1, keepdims=True) if len(x) else x
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def roots(adjacent: np.ndarray) -> np.ndarray:
    """For each vertex the first vertex of its component."""
    label = np.arange(len(adjacent))
    while True:
        new = np.minimum(label, np.where(adjacent, label[None, :], len(label)).min(axis=1, initial=len(label)))
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _leaves(trees: list[Tree], margin: float, dims: int):
    """Rows of classes with all their leaves; leaf numbers run through the trees."""
    base = np.cumsum([0, *(max(1, t.leaves) for t in trees)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            x = unit(matrix(batch.column(batch.schema.get_field_index("v")), dims))
            row, leaf = [], []
            for t, tree in enumerate(trees):
                for number, rows in descend(tree, x, margin):
                    row.append(rows)
                    leaf.append(np.full(len(rows), base[t] + number))
            row, leaf = np.concatenate(row), np.concatenate(leaf)
            by = np.lexsort((leaf, row))
            row, leaf = row[by], leaf[by].astype(np.int32)
            offsets = np.searchsorted(row, np.arange(len(batch) + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(leaf))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, "leaves"])

    return run


def _compared(threshold: float, dims: int):
    """Of a leaf or two blocks of one: links and local root of each vector."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        leaf, one, two = key[1].as_py(), key[2].as_py(), key[3].as_py()
        # a fixed order, for any order of the rows
        rows = rows.take(pa.compute.sort_indices(rows.column("rep")))
        ids, times = np.asarray(rows.column("rep")), np.asarray(rows.column("times"))
        block = np.asarray(rows.column("own"))
        x = unit(matrix(rows.column("v"), dims))
        n = len(x)
        near = np.zeros((n, n), bool)
        for at in range(0, n, 512):
            near[at : at + 512] = x[at : at + 512] @ x.T >= threshold
        near &= near.T
        np.fill_diagonal(near, False)
        if one != two:  # pairs within a block have a task of their own
            near &= block[:, None] != block[None, :]
        some = np.flatnonzero(near.any(axis=1))
        if not len(some):
            return pa.table({"rep": pa.array([], pa.int64()), "links": pa.array([], pa.int64()), "root": pa.array([], pa.int64())})
        near = near[np.ix_(some, some)]
        whole = near.copy()
        # a pair counts in the first leaf that both are in
        lists = rows.column("leaves").combine_chunks().take(pa.array(some))
        flat, owner = np.asarray(lists.flatten()), np.repeat(np.arange(len(some)), np.asarray(pa.compute.list_value_length(lists)))
        before = flat < leaf
        if before.any():
            known, column = np.unique(flat[before], return_inverse=True)
            holds = np.zeros((len(some), len(known)), np.float32)
            holds[owner[before], column] = 1
            near &= ~(holds @ holds.T > 0)
        links = near.astype(np.int64) @ times[some]
        root = roots(whole)
        return pa.table({"rep": pa.array(ids[some]), "links": pa.array(links), "root": pa.array(ids[some][root])})

    return run


def linked(classes: DataFrame, most: int, n: int, dims: int, threshold: float) -> DataFrame:
    """rep, links, root: of each leaf the vectors (rep, label, v, times) that have links there."""
    trees: list[Tree] = []
    if most > LEAF:
        sample = classes.select("v", "rep").orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE).select("v").collect()
        x = unit(np.array([r.v for r in sample], np.float64))
        rnd = np.random.default_rng(7)
        trees = [grow(x, math.ceil(math.log2(most / LEAF)), rnd) for _ in range(TREES)]
    margin = SPILL * math.sqrt(max(0.0, 2 * (1 - threshold))) / math.sqrt(dims)
    schema = f"label string, v {classes.schema['v'].dataType.simpleString()}, rep long, times long, leaves array<int>"
    placed = classes.select("label", "v", "rep", "times").mapInArrow(_leaves(trees or [Tree()], margin, dims), schema)
    placed = placed.withColumn("leaf", F.explode("leaves"))
    counts = placed.groupBy("label", "leaf").agg(F.count("*").alias("n")).filter(F.col("n") > LEAF_MOST)
    large = cut(counts.withColumn("blocks", F.ceil(F.col("n") * 2 / LEAF_MOST).cast("int")).select("label", "leaf", "blocks"))
    told = placed.join(large, ["label", "leaf"], "left")
    told = told.withColumn("own", F.when(F.col("blocks").isNull(), 0).otherwise(F.pmod(F.xxhash64("rep", "leaf"), F.col("blocks")).cast("int")))
    other = F.when(F.col("blocks").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))
    told = told.withColumn("other", F.explode(other)).withColumns({"one": F.least("own", "other"), "two": F.greatest("own", "other")}).drop("other", "blocks")
    return told.groupBy("label", "leaf", "one", "two").applyInArrow(_compared(threshold, dims), "rep long, links long, root long")


def grouped(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = 0.98) -> DataFrame:
    """vec_id, n_links, component_id, kept of each row."""
    bounded(df.sparkSession)
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(label).cast("string").alias("label"), F.col(vector).cast(components_type(df, vector)).alias("v"))
    good = cut(rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col("v"))))
    classes = cut(good.groupBy("label", "v").agg(F.min("id").alias("rep"), F.count("*").alias("times")))
    shapes = classes.withColumn("dims", F.size("v")).groupBy("dims", "label").agg(F.count("*").alias("n")).groupBy("dims").agg(F.max("n").alias("most"), F.sum("n").alias("n")).orderBy("dims").collect()
    found = None
    for shape in shapes:  # one round for each length of vectors
        part = linked(classes.filter(F.size("v") == shape.dims), shape.most, shape.n, shape.dims, threshold)
        found = part if found is None else found.unionByName(part)
    ids = df.select(F.col(key).cast("long").alias("vec_id"))
    # the other members of a vector's own class, and links between classes
    of = good.join(classes.select("label", "v", "rep", "times"), ["label", "v"]).select(F.col("id").alias("vec_id"), "rep", "times")
    if found is None:
        return ids.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    found = cut(found)
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    own = cut(of)
    edges = cut(found.select(F.col("rep").alias("a"), F.col("root").alias("b")).unionByName(own.select(F.col("vec_id").alias("a"), F.col("rep").alias("b"))).filter("a <> b").distinct())
    labels = components(edges).select(F.col("id").alias("vec_id"), F.col("component"))
    dropped(edges)
    told = own.join(links, "rep", "left").select("vec_id", (F.col("times") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    # one row for each row of the table, also where ids repeat
    bad = df.filter(F.col(key).isNull() | F.col(label).isNull() | ~usable(F.col(vector).cast(components_type(df, vector)))).select(F.col(key).cast("long").alias("vec_id"), F.lit(0).cast("long").alias("n_links"))
    out = told.unionByName(bad).join(labels, "vec_id", "left").withColumn("component_id", F.coalesce("component", "vec_id"))
    return out.select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept"))
