"""Tables as ordered sets: unions, intersections, differences, the best or first of each key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from biblion.operators.papers import digest


def union_all(tables: Sequence[DataFrame], ordinal: str, source: str = "source_ordinal") -> DataFrame:
    """All rows, columns by name (null where a table lacks one), with the number of their table, from 1; it and ``ordinal`` keep the order."""
    numbered = [t.withColumn(source, F.lit(k)) for k, t in enumerate(tables, 1)]
    if not numbered:
        raise ValueError("no tables")
    lacking = [k for k, t in enumerate(tables, 1) if ordinal not in t.columns]
    if lacking:
        raise ValueError(f"no {ordinal} in table {lacking[0]}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), numbered)


def first_of(df: DataFrame, key: Column, order: Sequence[str]) -> DataFrame:
    """The first row of each key in an order; keys meet as digests, map-side combined, so a frequent key is one row a task."""
    rows = df.select(digest(key).alias("_digest"), F.struct(*df.columns).alias("_row"), F.struct(*order).alias("_order"))
    return rows.groupBy("_digest").agg(F.min_by("_row", "_order").alias("_row")).select("_row.*")


def union_distinct(tables: Sequence[DataFrame], key: str, ordinal: str) -> DataFrame:
    """The rows of all tables, of each key the first: by table, then by ``ordinal``."""
    return first_of(union_all(tables, ordinal), F.col(key), ["source_ordinal", ordinal])


def best_of(df: DataFrame, keys: Sequence[str], score: str, ordinal: str) -> DataFrame:
    """The row of each key with the largest score, the first of equals."""
    rows = F.struct(*(c for c in df.columns if c not in keys))
    # the smallest of (minus the score, ordinal); a null score comes last
    order = F.struct(F.col(score).isNull().alias("none"), (-F.col(score)).alias("score"), F.col(ordinal).alias("ordinal"))
    best = df.groupBy(*keys).agg(F.min_by(rows, order).alias("_row"))
    return best.select(*keys, "_row.*").select(df.columns)


def intersection(one: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """The keys that both tables hold."""
    return one.select(key).intersect(other.select(key))


def difference(one: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """The keys that only the first table holds, sorted."""
    return one.select(key).distinct().join(other.select(key), key, "left_anti").orderBy(key)


def listed(df: DataFrame, ids: DataFrame, key: str, without: DataFrame | None = None) -> DataFrame:
    """Rows whose id a list holds, and another doesn't; a list may name an id more than once."""
    rows = df.join(ids.select(key), key, "left_semi")
    return rows if without is None else rows.join(without.select(key), key, "left_anti")


def head(df: DataFrame, most: int, ordinal: str, by: str | None = None) -> DataFrame:
    """The first rows in input order, of all or of each value of a column."""
    if most < 1:
        raise ValueError("most must be at least 1.")
    if by is None:
        return df.orderBy(ordinal).limit(most)
    n = F.row_number().over(Window.partitionBy(by).orderBy(ordinal))
    return df.withColumn("_n", n).filter(F.col("_n") <= most).drop("_n")
