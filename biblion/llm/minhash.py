"""MinHash near-dedup by one-permutation hashing.

A document is its set of distinct word shingles.  One hash of each shingle
names a bin and a value; the smallest value of each bin is kept, and an empty
bin borrows that of the first filled bin in its own random order (optimal
densification).  Bands of bins are bucket keys.

Sets that are equal form one class before anything is bucketed, so a group of
copies is one row.  Every bucket is a star: each class is paired with one
centre, that which shares the most buckets with others (a text that many
others derive from), as many edges as members.  Pairs are confirmed on the full
sets, in the JVM, where the members of a crowded centre are dealt by salt.

A star may miss a link between two of its points.  So the buckets that still
hold several components after the stars are compared in full: the largest
component of such a bucket and the rest are dealt into blocks by size, and each
pair of blocks that sizes allow a link between is a task of its own, which
passes on only links that unite components.  No link of a bucket is left out,
and no task holds more than two blocks.

With 36 bands of 6 bins a pair of similarity 0.8 shares no bucket with a
probability of 0.00002.

Defined cases: null and empty texts, and texts of blanks only, have no
shingles and are linked with nothing; a text of fewer words than a shingle is
one shingle; rows with one id are one vertex, linked if any of them is; rows
without an id are linked with nothing; very long texts are taken whole; other
columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from biblion.llm.base import bounded, cut, dropped, fresh, slices
from biblion.llm.graph import components
from biblion.llm.hashing import hashed_words, mixed

BANDS, ROWS = 36, 6
BINS = BANDS * ROWS
#: Members of a centre, or of a bucket, that one task joins: more are dealt by salt.
DEALT = 4096
#: Classes and bytes of hashes that a block of the last pass should hold.
BLOCK, BLOCK_BYTES = 600, 8_000_000

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def shingles(text: str | None, words: int) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles of ``words`` words, A-Z taken as a-z."""
    raw = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER)
    word, _, _ = hashed_words(raw)
    n = min(len(word), words)
    if not n:
        return word
    total = word[: len(word) - n + 1]
    for k in range(1, n):
        total = mixed(total) + word[k : len(word) - n + 1 + k]
    return np.unique(mixed(total + np.uint64(n)))


def _orders(bins: int, tries: int) -> np.ndarray:
    """For each bin the bins that it asks, in order."""
    at = np.arange(bins * tries, dtype=np.uint64)
    return (mixed(at + np.uint64(0x5851F42D4C957F2D)) % np.uint64(bins)).astype(np.int64).reshape(bins, tries)


_ASKED = _orders(BINS, 1024)


def signature(sets: np.ndarray) -> np.ndarray:
    """The densified one-permutation signature of a set of hashes that isn't empty."""
    place = ((sets >> np.uint64(32)) * np.uint64(BINS)) >> np.uint64(32)
    first = np.r_[True, place[1:] != place[:-1]]
    at = place[first].astype(np.int64)
    full = np.zeros(BINS, bool)
    full[at] = True
    value = np.zeros(BINS, np.uint64)
    value[at] = sets[first]
    for tries in (16, _ASKED.shape[1]):
        empty = np.flatnonzero(~full) if tries == 16 else rest
        hits = full[_ASKED[empty, :tries]]
        got = hits.any(axis=1)
        value[empty[got]] = value[_ASKED[empty[got], hits[got].argmax(axis=1)]]
        rest = empty[~got]
        if not len(rest):
            break
    # after all those tries: the next filled bin
    value[rest] = value[at[np.searchsorted(at, rest) % len(at)]]
    return value


def bands(sets: np.ndarray) -> np.ndarray:
    rows = signature(sets).reshape(BANDS, ROWS)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(ROWS):
        key = mixed(key + rows[:, k])
    return key.view(np.int64)


def sketched(docs: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """doc_id, n_shingles, h1 and h2 (128 bits that stand for the set), bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            n, one, two, keys = [], [], [], []
            for t in batch.column(1):  # one text at a time, not all of a batch
                s = shingles(t.as_py(), words)
                n.append(len(s))
                one.append(int(np.bitwise_xor.reduce(mixed(s + np.uint64(1))).view(np.int64)))
                two.append(int(mixed(s + np.uint64(2)).sum(dtype=np.uint64).view(np.int64)))
                keys.append(bands(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()), pa.array(keys, pa.list_(pa.int64()))], names=["doc_id", "n_shingles", "h1", "h2", "bands"])

    return docs.select(F.col(key).cast("long"), F.col(text)).mapInArrow(run, "doc_id long, n_shingles long, h1 long, h2 long, bands array<long>")


def hashes(texts: DataFrame, words: int) -> DataFrame:
    """doc_id and its set, where it isn't empty: the sorted hashes of its shingles (of doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch):
                sets = [shingles(t.as_py(), words).view(np.int64) for t in some.column(1)]
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["doc_id", "set"])

    return texts.select("doc_id", "text").mapInArrow(run, "doc_id long, set array<long>").filter(F.size("set") > 0)


def stars(members: DataFrame) -> DataFrame:
    """a, b, salt: each class of a bucket (a) with its centre (b); members: doc_id, weight, buckets (of bucket, n)."""
    each = members.select("doc_id", "weight", F.explode("buckets").alias("at")).select("doc_id", "weight", "at.bucket", "at.n")
    order = F.struct((-F.col("weight")).alias("o"), "doc_id")
    centre = each.groupBy("bucket").agg(F.min(order)["doc_id"].alias("centre"))
    pairs = each.select("doc_id", "bucket", "n").join(centre, "bucket").filter("doc_id <> centre")
    pairs = pairs.groupBy(F.col("doc_id").alias("a"), F.col("centre").alias("b")).agg(F.max("n").alias("n"))
    return pairs.select("a", "b", F.pmod(F.xxhash64("a"), F.ceil(F.col("n") / DEALT)).alias("salt"))


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those pairs a, b whose sets have 100 * intersection >= percent * union.

    The sets of the members are shuffled; the centres' are repeated once a salt.
    """
    heads = pairs.select("b", "salt").distinct().join(sets.select(F.col("doc_id").alias("b"), F.col("set").alias("y")), "b")
    told = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("set").alias("x")), "a").join(heads, ["b", "salt"])
    both = F.size(F.array_intersect("x", "y"))
    return told.filter(both * (100 + percent) >= (F.size("x") + F.size("y")) * percent).select("a", "b")


def _compared(percent: int):
    """Of two blocks of a bucket, or one: links that unite components."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        bucket, one, two = (k.as_py() for k in key)
        rows = rows.combine_chunks()
        some = rows.take(pa.compute.sort_indices(rows.column("doc_id"))).combine_chunks()
        ids, own, label = (np.asarray(some.column(c)) for c in ("doc_id", "own", "component"))
        label = label.copy()  # united with each link that is found
        column = some.column("set").combine_chunks()
        size = np.asarray(pa.compute.list_value_length(column)).astype(np.int64)
        at = np.r_[0, np.cumsum(size)]
        known, number = np.unique(np.asarray(column.flatten()), return_inverse=True)
        # a pair counts in the first bucket that both are in
        lists = some.column("buckets").combine_chunks()
        owner, flat = np.repeat(np.arange(len(some)), np.asarray(pa.compute.list_value_length(lists))), np.asarray(lists.flatten())
        owner, flat = owner[flat < bucket], flat[flat < bucket]
        buckets, flat = np.unique(flat, return_inverse=True)
        of = np.searchsorted(owner, np.arange(len(some) + 1))
        seen, mark = np.zeros(len(buckets), bool), np.zeros(len(known), bool)
        out = []
        place = np.arange(len(some))
        for k in range(len(some)):
            other = (place > k) & (label != label[k])
            if one != two:  # pairs within a block have a task of their own
                other &= own != own[k]
            other &= 100 * np.minimum(size, size[k]) >= percent * np.maximum(size, size[k])
            if not other.any():
                continue
            seen[flat[of[k] : of[k + 1]]] = True
            other[owner[seen[flat]]] = False
            seen[:] = False
            mark[number[at[k] : at[k + 1]]] = True
            for j in np.flatnonzero(other).tolist():
                if label[j] != label[k]:
                    both = int(np.count_nonzero(mark[number[at[j] : at[j + 1]]]))
                    if 100 * both >= percent * (int(size[k]) + int(size[j]) - both):
                        out.append((ids[k], ids[j]))
                        label[label == label[j]] = label[k]
            mark[number[at[k] : at[k + 1]]] = False
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})

    return run


def unsettled(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between the components of each bucket (members: doc_id, component, n, buckets), of all its pairs."""
    each = members.select("doc_id", "component", "n", F.explode("buckets.bucket").alias("bucket"))
    parts = each.groupBy("bucket", "component").agg(F.count("*").alias("n"), F.sum(F.col("n") * 8).alias("bytes"))
    total = parts.groupBy("bucket").agg(F.max(F.struct("n", "bytes", "component")).alias("most"), F.sum("n").alias("n"), F.sum("bytes").alias("bytes"), F.count("*").alias("components"))
    # buckets of the same members are one; of two members the one pair was tested
    one, two = F.xxhash64("doc_id"), F.xxhash64(F.lit(1), "doc_id")
    same = each.groupBy("bucket").agg(F.count("*").alias("k"), F.sum(one.cast("decimal(38,0)")).alias("s"), F.bit_xor(two).alias("x"))
    same = same.groupBy("k", "s", "x").agg(F.min("bucket").alias("bucket")).select("bucket")

    def blocks(n: Column, size: Column) -> Column:
        return F.greatest(F.ceil(n / BLOCK), F.ceil(size / BLOCK_BYTES), F.lit(1)).cast("int")

    # pairs within the largest component are linked already: its blocks (numbers from "rest" on) meet those of the rest only
    shape = total.filter("components > 1 AND n > 2").join(same, "bucket")
    shape = shape.select("bucket", F.col("most.component").alias("largest"), blocks(F.col("n") - F.col("most.n"), F.col("bytes") - F.col("most.bytes")).alias("rest"), blocks(F.col("most.n"), F.col("most.bytes")).alias("large"))
    told = each.join(shape, "bucket")
    inside, chance = F.col("component") == F.col("largest"), F.xxhash64("doc_id", "bucket")
    told = told.withColumn("own", F.when(inside, F.col("rest") + F.pmod(chance, F.col("large"))).otherwise(F.pmod(chance, F.col("rest"))).cast("int"))
    told = told.withColumn("last", F.when(inside, F.col("rest")).otherwise(F.col("rest") + F.col("large")) - 1)
    # one row a class until the texts have come: the buckets that are open and its blocks there
    open_ = told.groupBy("doc_id", "component").agg(F.collect_list(F.struct("bucket", "own", "last")).alias("tasks"))
    rows = open_.join(sets, "doc_id").select("doc_id", "component", "set", F.col("tasks.bucket").alias("buckets"), F.explode("tasks").alias("t"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("t.last"))))
    own = F.col("t.own")
    rows = rows.select("doc_id", "component", "set", "buckets", F.col("t.bucket").alias("bucket"), own.alias("own"), F.least(own, "other").alias("one"), F.greatest(own, "other").alias("two"))
    return rows.groupBy("bucket", "one", "two").applyInArrow(_compared(percent), "a long, b long")


def labelled(docs: DataFrame, classes: DataFrame, words: int, percent: int) -> DataFrame | None:
    """id and component of the class representatives that are linked with others; None without any."""
    keys = classes.select(F.col("rep").alias("doc_id"), F.col("n_shingles").alias("n"), F.explode("bands").alias("bucket")).groupBy("doc_id", "bucket").agg(F.max("n").alias("size"))
    shared = keys.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    members = cut(keys.join(shared, "bucket").groupBy("doc_id").agg(F.max("size").alias("n"), F.sum("n").alias("weight"), F.collect_list(F.struct("bucket", "n")).alias("buckets")))
    # texts are hashed once more, but only those that share a bucket
    sets = cut(hashes(docs.join(members.select("doc_id"), "doc_id", "left_semi"), words))
    new = cut(confirmed(stars(members), sets, percent))
    labels = None if new.isEmpty() else components(new)
    dropped(new)
    told = members.select("doc_id", "n", "buckets")
    if labels is None:
        told = told.withColumn("component", F.col("doc_id"))
    else:
        own = labels.select(F.col("id").alias("doc_id"), "component")
        told = told.join(own, "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    told = cut(told)
    last = cut(unsettled(told, sets, percent))
    if not last.isEmpty():
        labels = merged(labels, last)
    dropped(last, told, sets, members)
    return labels


def merged(labels: DataFrame | None, edges: DataFrame) -> DataFrame:
    """The labels after further links: components of components."""
    if labels is None:
        return components(edges)
    for side in ("a", "b"):
        own = labels.select(F.col("id").alias(side), F.col("component").alias("to"))
        edges = edges.join(own, side, "left").withColumn(side, F.coalesce("to", side)).drop("to")
    edges = cut(edges)
    moved = components(edges).withColumnRenamed("component", "to")
    dropped(edges)
    old = labels.join(moved.withColumnRenamed("id", "component"), "component", "left").select("id", F.coalesce("to", "component").alias("component"))
    return cut(old.unionByName(moved.join(labels, "id", "left_anti").select("id", F.col("to").alias("component"))))


def grouped(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of each row."""
    bounded(docs.sparkSession)
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sketches = cut(sketched(docs, "doc_id", "text", words))
    full = sketches.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    sets = ["h1", "h2", "n_shingles"]
    # equal sets have equal bands
    classes = cut(full.groupBy(sets).agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands")))
    labels = labelled(docs, classes, words, percent)
    classes = classes.drop("bands")
    # rows with one id link the classes that they belong to
    twins = full.groupBy("doc_id").agg(F.min(F.struct(sets)).alias("x"), F.max(F.struct(sets)).alias("y")).filter("x <> y").select("doc_id")
    if not twins.isEmpty():
        same = cut(full.join(twins, "doc_id").join(classes, sets).select(F.col("doc_id").alias("a"), F.col("rep").alias("b")))
        labels = merged(labels, same)
        dropped(same)
    own = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("component", "doc_id"))
    if labels is None:
        told = classes.withColumn("component", F.col("rep"))
    else:
        told = classes.join(labels.withColumnRenamed("id", "rep"), "rep", "left").select(*sets, F.coalesce("component", "rep").alias("component"))
    rows = sketches.select("doc_id", *sets).join(told.select(*sets, "component"), sets, "left").select("doc_id", "n_shingles", own.alias("component_id"))
    return rows.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def representatives(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` but for those whose component has a smaller id."""
    gone = fresh("gone", docs.columns)
    away = grouped(docs, key, text, words, percent).filter("NOT kept").select(F.col("doc_id").alias(gone)).distinct()
    return docs.join(away, docs[key].cast("long") == F.col(gone), "left_anti")
