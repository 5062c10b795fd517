"""What runs keep between calls: resumption, reuse, quotas, the top-up loop."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Sequence
from itertools import count

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from biblion.operators.papers import unseen


def resume_state(df: DataFrame, query: str, rank: str, per_page: int, provenance: str | None = None) -> DataFrame:
    """query, consumed, page, offset: where each query goes on, from the rows it has given (and their duplicates)."""
    rows = df.select(F.col(query).alias("query"), F.col(rank).alias("rank"))
    if provenance:
        rows = rows.unionByName(df.select(F.explode(provenance).alias("p")).select(F.col(f"p.{query}").alias("query"), F.col(f"p.{rank}").alias("rank")))
    most = rows.groupBy("query").agg(F.max("rank").alias("consumed"))
    return most.withColumns({"page": F.floor(F.col("consumed") / per_page) + 1, "offset": F.col("consumed") % per_page})


def accepted(df: DataFrame, query: str, order: Sequence[Column], remaining: int, active: int) -> DataFrame:
    """At most ceil(remaining / active) rows of each query, the first in order."""
    most = max(1, -(-remaining // active)) if active else 0
    n = F.row_number().over(Window.partitionBy(query).orderBy(*order))
    return df.withColumn("accept_rank", n).filter(F.col("accept_rank") <= most)


def held(df: DataFrame) -> DataFrame:
    """``df`` written as a checkpoint, in the folder that all executors share: lineage ends there."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            folder = tempfile.mkdtemp(prefix="checkpoints-")
        context.setCheckpointDir(folder)
    return df.checkpoint()


def ranked(df: DataFrame, order: Sequence[Column], rank: str = "rank", after: int = 0) -> DataFrame:
    """Ranks 1 to n over all rows, after ``after``.

    The ordered ranges are written once, each row with its place in its range,
    so that no second reading can part them otherwise; only their sizes meet.
    """
    placed = held(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    part, own = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select("_part", before.alias("_before"))  # one row a range
    return placed.withColumns({"_part": part, "_own": own + 1}).join(F.broadcast(sizes), "_part").withColumn(rank, F.col("_before") + F.col("_own") + after).drop("_part", "_own", "_before", "_at")


def reused(new: DataFrame, done: DataFrame, keys: Sequence[str], check: Callable[[DataFrame], DataFrame], skipped: Column | None = None) -> DataFrame:
    """Rows decided before are kept as they are (skipped ones are done again); only the others are checked."""
    keep = done.filter(~skipped) if skipped is not None else done
    asked = new.join(keep.select(*keys), list(keys), "left_anti")
    kept = keep.join(new.select(*keys).distinct(), list(keys), "left_semi")
    return kept.unionByName(check(asked), allowMissingColumns=True)


def checked_once(df: DataFrame, url: str, check: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Each distinct URL is checked once, and the answer joined back."""
    return df.join(check(df.select(url).filter(F.col(url) != "").distinct()), url, "left")


def topped_up(start: DataFrame, fetch: Callable[[int], DataFrame | None], enough: Callable[[DataFrame], bool], key: str, ordinal: str, write: Callable[[DataFrame, int], DataFrame], rounds: int | None = None) -> tuple[DataFrame, str]:
    """Fetch, keep what is unseen, write, until there is enough, nothing new, or no more to fetch; ``rounds``, if given, ends it before."""
    rows = start
    for n in count(1) if rounds is None else range(1, rounds + 1):
        if enough(rows):
            return rows, "enough"
        found = fetch(n)
        if found is None:
            return rows, "exhausted"
        new = held(write(unseen(found, rows, key, ordinal), n))
        if new.isEmpty():
            return rows, "nothing_new"
        rows = held(rows.unionByName(new, allowMissingColumns=True))
    return rows, "enough" if enough(rows) else "rounds"


def fetch_counts(df: DataFrame) -> DataFrame:
    """kind (all, tier or query), name, candidates and duplicates_removed of fetched candidates, in one pass.

    Columns: retrieval_tier, retrieval_query_id, in_fetch_duplicate_count (null is 1).
    """
    rows = df.select(F.col("retrieval_tier").cast("string").alias("t"), F.col("retrieval_query_id").cast("string").alias("q"), (F.coalesce(F.col("in_fetch_duplicate_count"), F.lit(1)) - 1).alias("d"))
    sets = rows.groupingSets([[], ["t"], ["q"]], "t", "q").agg(F.grouping_id().alias("g"), F.count("*").alias("candidates"), F.coalesce(F.sum("d"), F.lit(0)).alias("duplicates_removed"))
    kind = F.when(F.col("g") == 3, "all").when(F.col("g") == 1, "tier").otherwise("query")
    return sets.select(kind.alias("kind"), F.coalesce(F.when(F.col("g") == 1, F.col("t")).when(F.col("g") == 2, F.col("q")), F.lit("")).alias("name"), "candidates", "duplicates_removed")
