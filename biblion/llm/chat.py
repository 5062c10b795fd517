"""Chat formatting: collapse cumulative snapshots, then render.

Logs often hold one conversation many times, each time some turns longer.
A rolling hash of every prefix of turns (128 bits: two xor-chained hashes of
position, role and text, and the number of turns) finds conversations that are
a prefix of a longer one; an anti-join leaves the maximal ones, which are
rendered with one marked block a turn.

Equal conversations are grouped by their hash before any join, and prefixes
are made distinct, so a conversation that was logged a million times is one
row there.

Defined cases: a null role or text counts as empty; rows without a
conversation id belong to none and are left out; turns are ordered by number
(nulls first), then role, then text, and repeated rows are turns of their own;
of equal conversations the smallest id stays; the head of a marker (``<|``)
within a role or text gets a blank behind the ``<``; very long texts are taken
whole; an empty table gives an empty table; other columns, whatever their names,
play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The block of a turn in the rendered text.
OPEN, AFTER_ROLE, CLOSE = "<|im_start|>", "\n", "<|im_end|>\n"


def turns(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv, pos (from 1), n (turns of the conversation), role, text, and the hash h1, h2 of the turns up to this one."""
    rows = df.filter(F.col(conv).isNotNull()).select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))
    inside = Window.partitionBy("conv").orderBy("turn", "role", "text")
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("pos", F.row_number().over(inside)).withColumn("n", F.count("*").over(Window.partitionBy("conv")))
    one, two = F.xxhash64("pos", "role", "text"), F.xxhash64(F.lit("other"), "text", "role", "pos")
    return rows.select("conv", "pos", "n", "role", "text", F.bit_xor(one).over(so_far).alias("h1"), F.bit_xor(two).over(so_far).alias("h2"))


def maximal(rows: DataFrame) -> DataFrame:
    """conv, n and copies of those conversations of turns() that are no prefix of a longer one."""
    whole = rows.filter("pos = n").groupBy("pos", "h1", "h2").agg(F.min("conv").alias("conv"), F.count("*").alias("copies"))
    prefixes = rows.filter("pos < n").select("pos", "h1", "h2").distinct()
    return whole.join(prefixes, ["pos", "h1", "h2"], "left_anti").select("conv", "copies")


def block(role: Column, text: Column) -> Column:
    """One rendered turn; what would read as a marker within it is parted, so that no text can forge a turn."""
    inner = lambda c: F.replace(c, F.lit("<|"), F.lit("< |"))
    return F.concat(F.lit(OPEN), inner(role), F.lit(AFTER_ROLE), inner(text), F.lit(CLOSE))


def formatted(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row (conv_id, n_turns, copies, text) for each maximal conversation."""
    rows = turns(df, conv, turn, role, text)
    kept = rows.select("conv", "pos", block(F.col("role"), F.col("text")).alias("part")).join(maximal(rows), "conv")
    parts = F.array_sort(F.collect_list(F.struct("pos", "part")))
    out = kept.groupBy("conv").agg(parts.alias("parts"), F.first("copies").alias("copies"))
    return out.select(F.col("conv").alias("conv_id"), F.size("parts").cast("long").alias("n_turns"), "copies", F.array_join(F.col("parts.part"), "").alias("text"))


ORACLE = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos,
         count(*) OVER (PARTITION BY conv_id) AS n
  FROM conversations WHERE conv_id IS NOT NULL),
h AS (
  SELECT conv_id, pos, n, md5(string_agg(md5(role) || md5(text), '') OVER (PARTITION BY conv_id ORDER BY pos)) AS h FROM t),
whole AS (SELECT h, min(conv_id) AS conv_id, count(*) AS copies FROM h WHERE pos = n GROUP BY h),
kept AS (SELECT conv_id, copies FROM whole WHERE h NOT IN (SELECT h FROM h WHERE pos < n))
SELECT t.conv_id, count(*) AS n_turns, any_value(copies) AS copies,
       string_agg('{OPEN}' || replace(role, '<|', '< |') || chr(10) || replace(text, '<|', '< |') || '<|im_end|>' || chr(10), '' ORDER BY pos) AS text
FROM t JOIN kept USING (conv_id) GROUP BY t.conv_id
"""
