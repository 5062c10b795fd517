"""Line dedup by content-defined chunks, in DataFrame functions only.

Lines are hashed, and a polynomial hash rolls over ``WINDOW`` neighbouring line
hashes.  A chunk ends where the rolling hash is smaller than before and no
larger than behind, so borders depend on the lines around them alone and shift
with them when lines are put in elsewhere; two borders are ``LEAST`` lines
apart at least.  Within a run of one repeated line, where the rolling hash does
not change, a chunk ends at every second line.  Chunks that stand at several
places, in one document or in several, are removed everywhere but at the first
place (smallest id, then first line).

Places are counted by hash with partial aggregation, so a chunk that a third
of all documents hold is one row a task there.  Only chunks whose hash repeats
are compared, byte by byte, with the chunk at the hash's first place: joins on
the hash read tables that were written before and feed nothing that needs their
partitioning, so the adaptive skew join may split a frequent one.  Chunks that
share a hash but differ are grouped by their text itself.

Lines that stay although they repeat: documents of one line, and at the edges
of a passage the lines up to its first border within (about ``WINDOW`` + 1) and
from its last one on.

Defined cases: a null text stays null and has no lines; an empty text is one
empty line; an empty table gives an empty table; chunks of blanks only are kept;
rows with one id do not remove one another's chunks at the same place; rows
without an id are kept whole and remove nothing; very long texts are taken
whole; columns other than id and text stay as they are (``with_text``),
whatever their names, or play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from biblion.llm.base import cut, dropped, fresh

WINDOW, LEAST = 4, 2
#: The rolling hash is a polynomial of this base modulo a prime.
BASE, PRIME = 1_103_515_245, 2_147_483_647


def line_hash(line: Column) -> Column:
    """The first 32 bits of a line's MD5."""
    return F.conv(F.substring(F.md5(line.cast("binary")), 1, 8), 16, 10).cast("long")


def _rolled(h: Column, i: Column) -> Column:
    """The hash of the lines before place ``i``; lines before the first count as 0."""
    total = F.lit(0).cast("long")
    for k in range(WINDOW, 0, -1):
        line = F.when(i >= k, F.get(h, (i - k).cast("int"))).otherwise(0)
        total = (total * BASE + line) % PRIME
    return total


def parted(docs: DataFrame, key: str, text: str) -> DataFrame:
    """doc_id, t (the text's hash), lines and starts (the places, from 0, of the first line of each chunk)."""
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    rows = rows.select("doc_id", F.xxhash64("text").alias("t"), F.split("text", "\n").alias("lines"))
    rows = rows.withColumn("h", F.transform("lines", line_hash))
    rows = rows.withColumn("r", F.transform(F.sequence(F.lit(0), F.size("h")), lambda i: _rolled(F.col("h"), i)))

    def within(i: Column) -> Column:
        """In a run of one line: the two lines before and the two from here on are equal."""
        one = F.get("h", i)
        return F.coalesce((i >= 2) & (F.get("h", i - 2) == one) & (F.get("h", i - 1) == one) & (F.get("h", i + 1) == one), F.lit(False))

    def begins(i: Column) -> Column:
        low = (F.get("r", i) < F.get("r", i - 1)) & (F.get("r", i) <= F.get("r", i + 1)) & ~within(i - 1) & ~within(i + 1)
        inner = (i >= LEAST) & (i <= F.size("h") - LEAST) & F.when(within(i), i % 2 == 0).otherwise(low)
        return (i == 0) | inner

    places = F.sequence(F.lit(0), F.size("h") - 1)
    return rows.withColumn("starts", F.filter(places, begins)).drop("h", "r")


def chunks(rows: DataFrame) -> DataFrame:
    """doc_id, t, start, n, chunk of each chunk that may go."""
    n = F.size("lines")
    each = F.transform("starts", lambda s, k: F.struct(s.alias("start"), (F.coalesce(F.get("starts", k + 1), n) - s).alias("n")))
    several = F.filter(each, lambda c: c["n"] >= LEAST)
    out = rows.select("doc_id", "t", "lines", F.explode(several).alias("c"))
    out = out.select("doc_id", "t", F.col("c.start").alias("start"), F.col("c.n").alias("n"), F.array_join(F.slice("lines", F.col("c.start") + 1, F.col("c.n")), "\n").alias("chunk"))
    return out.filter(F.col("chunk").rlike(r"[^\x20\x09-\x0D]"))


def repeated(rows: DataFrame) -> DataFrame:
    """doc_id, t, start, n of every chunk that stands somewhere before, byte for byte."""
    told = chunks(rows).withColumn("h", F.xxhash64("chunk", "n"))
    place = F.struct("doc_id", "start")
    hashes = told.groupBy("h").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    # written, so that the join behind has nothing but an exchange on either side and can be split
    often = cut(hashes.filter("first <> last").select("h", "first"))
    # a merge at every size: it is split where a hash is frequent, and its cost grows evenly
    places = cut(told.join(often.hint("merge"), "h"))
    # rows with one id may both be at the first place: one row for each text there
    single = cut(places.filter(place == F.col("first")).groupBy("h").agg(F.min("chunk").alias("one")))
    same = cut(places.join(single, "h").select("doc_id", "t", "start", "n", "h", "first", (F.col("chunk") == F.col("one")).alias("same"), F.when(F.col("chunk") != F.col("one"), F.col("chunk")).alias("other")))
    gone = same.filter(F.col("same") & (place != F.col("first"))).select("doc_id", "t", "start", "n")
    # one hash, another text: hardly ever, and then told apart by the text itself
    rest = same.filter(~F.col("same"))
    own = rest.groupBy("h", "other").agg(F.min(place).alias("first"))
    more = rest.drop("first").join(own, ["h", "other"]).filter(place != F.col("first"))
    dropped(often, places, single)
    return gone.unionByName(more.select("doc_id", "t", "start", "n"))


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text", with_text: bool = False) -> DataFrame:
    """doc_id, n_lines, n_removed, text; or, ``with_text``, the columns of ``docs`` with the kept text."""
    gone = repeated(parted(docs, key, text)).groupBy("doc_id", "t").agg(F.array_sort(F.collect_set(F.struct("start", "n"))).alias("gone"))
    marks = {x: fresh(x, docs.columns) for x in ("gone_id", "gone_t", "gone", "lines")}
    away, lines = F.col(marks["gone"]), F.col(marks["lines"])
    gone = gone.select(F.col("doc_id").alias(marks["gone_id"]), F.col("t").alias(marks["gone_t"]), F.col("gone").alias(marks["gone"])).hint("merge")
    # of rows with one id, each loses only the chunks that it has itself
    rows = docs.join(gone, (docs[key] == gone[marks["gone_id"]]) & (F.xxhash64(docs[text]) == gone[marks["gone_t"]]), "left")
    rows = rows.withColumn(marks["lines"], F.split(text, "\n"))

    def until(end: Column, begin: Column) -> Column:
        return F.slice(lines, begin + 1, F.greatest(end - begin, F.lit(0)))

    def behind(k: Column) -> Column:
        before = F.get(away, k - 1)
        return F.when(k > 0, before["start"] + before["n"]).otherwise(0)

    pieces = F.transform(away, lambda g, k: until(g["start"], behind(k)))
    tail = until(F.size(lines), behind(F.size(away)))
    new = F.when(away.isNull(), F.col(text)).otherwise(F.array_join(F.concat(F.flatten(pieces), tail), "\n"))
    if with_text:
        return rows.select(*[new.alias(text) if f == text else F.col(f) for f in docs.columns])
    n = F.when(F.col(text).isNotNull(), F.size(lines)).otherwise(0).cast("long")
    removed = F.coalesce(F.aggregate(away, F.lit(0).cast("long"), lambda a, g: a + g["n"]), F.lit(0).cast("long"))
    return rows.select(F.col(key).alias("doc_id"), n.alias("n_lines"), removed.alias("n_removed"), new.alias("text"))


ORACLE = """
WITH d AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
h AS (
  SELECT *, list_transform(lines, lambda x: ('0x' || substr(md5(x), 1, 8))::BIGINT) AS h FROM d),
r AS (
  SELECT *, list_transform(range(len(h) + 1), lambda i:
    (((coalesce(CASE WHEN i >= 4 THEN h[i - 3] END, 0) % 2147483647 * 1103515245
     + coalesce(CASE WHEN i >= 3 THEN h[i - 2] END, 0)) % 2147483647 * 1103515245
     + coalesce(CASE WHEN i >= 2 THEN h[i - 1] END, 0)) % 2147483647 * 1103515245
     + coalesce(CASE WHEN i >= 1 THEN h[i] END, 0)) % 2147483647) AS r FROM h),
w AS (
  SELECT *, list_transform(range(len(h) + 2), lambda i:
    i >= 2 AND i < len(h) - 1 AND h[i - 1] = h[i] AND h[i] = h[i + 1] AND h[i + 1] = h[i + 2]) AS run FROM r),
s AS (
  SELECT *, list_filter(range(len(h)), lambda i: i = 0 OR (i >= 2 AND i <= len(h) - 2 AND CASE WHEN run[i + 1] THEN i % 2 = 0
    ELSE r[i + 1] < r[i] AND r[i + 1] <= r[i + 2] AND NOT run[i] AND NOT run[i + 2] END)) AS starts FROM w),
c AS (
  SELECT doc_id, start, coalesce(lead(start) OVER (PARTITION BY doc_id ORDER BY start), len(lines)) AS stop, lines
  FROM (SELECT doc_id, lines, unnest(starts) AS start FROM s)),
t AS (
  SELECT doc_id, start, stop - start AS n, array_to_string(lines[start + 1 : stop], chr(10)) AS chunk FROM c),
k AS (
  SELECT *, n >= 2 AND regexp_matches(chunk, '[^ \\t\\n\\v\\f\\r]')
            AND row_number() OVER (PARTITION BY chunk, n ORDER BY doc_id, start) > 1 AS gone FROM t)
SELECT d.doc_id, len(d.lines)::BIGINT AS n_lines, coalesce(g.n_removed, 0)::BIGINT AS n_removed,
       CASE WHEN coalesce(g.n_removed, 0) = 0 THEN d.text ELSE coalesce(g.text, '') END AS text
FROM d LEFT JOIN (
  SELECT doc_id, sum(CASE WHEN gone THEN n ELSE 0 END) AS n_removed, string_agg(CASE WHEN NOT gone THEN chunk END, chr(10) ORDER BY start) AS text
  FROM k GROUP BY doc_id) g USING (doc_id)
"""
