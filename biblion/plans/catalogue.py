"""Queries of the bibliographic operators on the given tables, and their SQL.

Documents stand in for papers: doc_id is provider id, rank and ordinal, source
the provider, the first line the title, the text the abstract; labels stand in
for screening rows.  Every query reads its whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from biblion.functions import text as X
from biblion.operators import audit, availability, documents, matching, model, papers, reviews, seeds, sets, state
from biblion.operators.audit import Category, Label
from biblion.operators.matching import Topic, TopicSpec

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

INCLUDE, EXCLUDE = ["thing the", "on the ing of", "and", "urban heat islands"], ["all rights reserved", "apache license"]
SPEC = TopicSpec(
    [
        Topic("anchor", ["the", "de"]),
        Topic("second", ["thing", "ion the", "que"], "abstract"),
        Topic("third", ["ering"], "title"),
        Topic("second", ["entry", "licensed"], "abstract", "secondary", "g1"),
        Topic("third", ["ti", "ed the"], "title_or_abstract", "secondary", "g2"),
    ],
    "anchor",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def as_papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.col("source").alias("provider"), "lang", F.substring_index("text", "\n", 1).alias("title"), F.col("text").alias("abstract"), "n_chars")


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


_TITLE = "split_part(text, chr(10), 1)"
_KEY = "trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g'))"
_SCREEN = "trim(regexp_replace(regexp_replace(lower(text), '<[^>]+>', ' ', 'g'), '[^a-z0-9]+', ' ', 'g'))"


@query(f"""SELECT doc_id, trim(regexp_replace({_TITLE}, '\\s+', ' ', 'g')) AS title, regexp_extract(text, '[0-9]{{4}}', 0) AS year,
CASE WHEN trim(regexp_replace(text, '\\s+', ' ', 'g')) <> '' THEN 'yes' ELSE 'no' END AS abstract_available, 'no' AS full_text_available,
array_to_string(list_filter([CASE WHEN trim({_TITLE}) = '' THEN 'missing_title' END, CASE WHEN regexp_extract(text, '[0-9]{{4}}', 0) = '' THEN 'missing_year' END,
CASE WHEN trim(text) = '' THEN 'missing_abstract' END, 'missing_full_text_path'], lambda x: x IS NOT NULL), '; ') AS metadata_notes
FROM documents""")
def normalize_documents(spark, sf_dir):
    rows = as_papers(spark, sf_dir).select("doc_id", F.lit("").alias("paper_id"), "title", F.col("abstract").alias("year"), F.lit("").alias("doi"), "abstract")
    return papers.normalized(rows, "doc_id").select("doc_id", "title", "year", "abstract_available", "full_text_available", "metadata_notes")


@query(f"SELECT doc_id, CASE WHEN {_KEY} <> '' THEN 'title:' || {_KEY} ELSE 'provider_id:' || source || ':' || doc_id END AS dedupe_key FROM documents")
def dedupe_key(spark, sf_dir):
    rows = as_papers(spark, sf_dir)
    return rows.select("doc_id", _dedupe_key().alias("dedupe_key"))


def _dedupe_key():
    return X.dedupe_key(F.lit(None), F.col("abstract"), F.lit(""), F.col("provider"), F.col("doc_id").cast("string"))


@query(f"""WITH k AS (SELECT doc_id, source, n_chars, {_KEY} AS k FROM documents),
r AS (SELECT *, row_number() OVER w AS rn, count(*) OVER (PARTITION BY k) AS n FROM k WINDOW w AS (PARTITION BY k ORDER BY n_chars = 0, doc_id))
SELECT doc_id, source AS provider, n AS duplicate_count FROM r WHERE rn = 1""")
def dedupe_documents(spark, sf_dir):
    rows = as_papers(spark, sf_dir).select("doc_id", "provider", "n_chars", _dedupe_key().alias("k"))
    out = papers.deduplicated(rows, F.col("k"), F.col("n_chars") > 0, F.col("doc_id").cast("string"), "doc_id")
    return out.select("doc_id", "provider", "duplicate_count")


@query(f"""SELECT doc_id, n AS duplicate_count, ids AS provenance FROM (
SELECT min(doc_id) AS doc_id, count(*) AS n, string_agg(source || '/' || doc_id, '|' ORDER BY n_chars = 0, doc_id) AS ids FROM documents GROUP BY {_KEY}) WHERE n > 1""")
def dedupe_provenance(spark, sf_dir):
    rows = as_papers(spark, sf_dir).select("doc_id", "provider", "n_chars", _dedupe_key().alias("k"))
    out = papers.deduplicated(rows, F.col("k"), F.col("n_chars") > 0, F.col("doc_id").cast("string"), "doc_id", ["provider", "doc_id"])
    told = F.array_join(F.transform("duplicate_provenance", lambda p: F.concat(p["provider"], F.lit("/"), p["doc_id"])), "|")
    return out.filter("duplicate_count > 1").select("doc_id", "duplicate_count", told.alias("provenance"))


@query(f"SELECT count(*) AS rows_in, count(DISTINCT {_KEY}) AS groups, count(*) - count(DISTINCT {_KEY}) AS duplicates FROM documents")
def dedupe_stats(spark, sf_dir):
    return papers.dedupe_counts(as_papers(spark, sf_dir), _dedupe_key())


def _sql_stem(t: str) -> str:
    return f"CASE WHEN len({t}) > 4 AND {t} LIKE '%ies' THEN {t}[:-4] || 'y' WHEN len({t}) > 4 AND {t} LIKE '%es' THEN {t}[:-3] WHEN len({t}) > 3 AND {t} LIKE '%s' THEN {t}[:-2] ELSE {t} END"


_STOP = "[" + ", ".join(f"'{w}'" for w in X.STOPWORDS) + "]"
_TOKENS = f"list_transform(list_filter(string_split(t, ' '), lambda x: x <> '' AND NOT list_contains({_STOP}, x)), lambda x: {_sql_stem('x')})"


# no document holds a character reference, so that texts need no unescaping here; html_unescape has its own query
@query(f"""WITH n AS (SELECT doc_id, t, {_TOKENS} AS k FROM (SELECT doc_id, {_SCREEN} AS t FROM documents)),
m AS (SELECT doc_id, list_filter([
CASE WHEN contains(' ' || t || ' ', ' thing the ') THEN 'thing the' END,
CASE WHEN contains(' ' || t || ' ', ' on the ing of ') THEN 'on the ing of' END,
CASE WHEN contains(' ' || t || ' ', ' and ') THEN 'and' END,
CASE WHEN contains(' ' || t || ' ', ' urban heat islands ') OR contains(' ' || t || ' ', ' uhi ') OR (list_contains(k, 'urban')::INT + list_contains(k, 'heat')::INT + list_contains(k, 'island')::INT) >= 2 THEN 'urban heat islands' END], lambda x: x IS NOT NULL) AS i,
list_filter([
CASE WHEN contains(' ' || t || ' ', ' all rights reserved ') OR contains(' ' || t || ' ', ' arr ') OR (list_contains(k, 'all')::INT + list_contains(k, 'right')::INT + list_contains(k, 'reserved')::INT) >= 2 THEN 'all rights reserved' END,
CASE WHEN contains(' ' || t || ' ', ' apache license ') OR contains(' ' || t || ' ', ' al ') OR (list_contains(k, 'apache')::INT + list_contains(k, 'license')::INT) >= 2 THEN 'apache license' END], lambda x: x IS NOT NULL) AS e FROM n)
SELECT doc_id, CASE WHEN len(e) > 0 THEN 'exclude_or_route_elsewhere' ELSE 'include' END AS scope_decision, array_to_string(i, '; ') AS included_by, array_to_string(e, '; ') AS excluded_by FROM m""")
def scope_screen(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    out = papers.scoped(docs, INCLUDE, EXCLUDE, text=F.col("text"))
    return out.select("doc_id", "scope_decision", F.col("scope_matched_include_terms").alias("included_by"), F.col("scope_matched_exclude_terms").alias("excluded_by"))


@query(f"""SELECT doc_id, len({_TOKENS}) AS n_tokens, (list_contains({_TOKENS}, 'thing')::INT + list_contains({_TOKENS}, 'ion')::INT + list_contains({_TOKENS}, 'er')::INT) >= 2 AS overlaps
FROM (SELECT doc_id, {_SCREEN} AS t FROM documents)""")
def token_overlap(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", X.meaningful_tokens(X.screening_text(F.col("text"))).alias("k"))
    return rows.select("doc_id", F.size("k").cast("long").alias("n_tokens"), X.token_overlap(F.col("k"), "things ions er").alias("overlaps"))


def _matched(spark, sf_dir) -> DataFrame:
    return matching.matched(as_papers(spark, sf_dir), SPEC)


def _sql_match(field: str) -> str:
    text = _TITLE if field == "title" else "text"
    return f"regexp_replace(regexp_replace(regexp_replace({text}, '<[^>]+>', ' ', 'g'), '[‐-―]', '-', 'g'), '[‘’ʼ'']', '', 'g')"


_B, _E = "(?i)(?:^|[^A-Za-z0-9])", "(?:$|[^A-Za-z0-9])"
_LONG = " UNION ALL ".join(
    f"""SELECT doc_id, '{topic}' AS topic_id, '{kind}' AS kind, '{group}' AS group_id, '{term}' AS "value", '{f}' AS field FROM d WHERE regexp_matches({f}, '{_B}{pattern}{_E}')"""
    for topic, kind, group, term, pattern, fields in (
        ("anchor", "main", "", "the", "thes?", ("title", "abstract")),
        ("anchor", "main", "", "de", "de", ("title", "abstract")),
        ("second", "main", "", "thing", "things?", ("abstract",)),
        ("second", "main", "", "ion the", "ions?[\\s\\-]+thes?", ("abstract",)),
        ("second", "main", "", "que", "ques?", ("abstract",)),
        ("third", "main", "", "ering", "erings?", ("title",)),
        ("second", "secondary", "g1", "entry", "entr(?:y|ies)", ("abstract",)),
        ("second", "secondary", "g1", "licensed", "licenseds?", ("abstract",)),
        ("third", "secondary", "g2", "ti", "ti", ("title", "abstract")),
        ("third", "secondary", "g2", "ed the", "ed[\\s\\-]+thes?", ("title", "abstract")),
    )
    for f in fields
)
_MATCHED = f"""WITH d AS (SELECT doc_id, source, {_sql_match('title')} AS title, {_sql_match('abstract')} AS abstract FROM documents), l AS ({_LONG}),
m AS (SELECT doc_id, bool_or(kind = 'main' AND topic_id = 'anchor') AS anchor, """ + ", ".join(f"bool_or(kind = '{k}' AND topic_id = '{t}') AS {k}_{t}" for k in ("main", "secondary") for t in ("second", "third")) + """,
bool_or(kind = 'main' AND topic_id = 'anchor' AND field = 'title') AND bool_or(kind = 'main' AND topic_id = 'second' AND field = 'title') AND bool_or(kind = 'main' AND topic_id = 'third' AND field = 'title') AS titled FROM l GROUP BY doc_id),
t AS (SELECT d.doc_id, d.source, coalesce(anchor, false) AS anchor, coalesce(titled, false) AS titled, CASE WHEN coalesce(anchor, false) AND (main_second OR secondary_second) AND (main_third OR secondary_third)
THEN (NOT main_second)::INT + (NOT main_third)::INT ELSE 999 END AS tier FROM d LEFT JOIN m USING (doc_id))"""


@query(f"WITH d AS (SELECT doc_id, {_sql_match('title')} AS title, {_sql_match('abstract')} AS abstract FROM documents) {_LONG}")
def topic_match_long(spark, sf_dir):
    return matching.matches_long(_matched(spark, sf_dir), "doc_id")


@query(_MATCHED + " SELECT doc_id, anchor AS anchor_present, tier AS local_relevance_tier FROM t")
def local_tier(spark, sf_dir):
    return _matched(spark, sf_dir).select("doc_id", "anchor_present", "local_relevance_tier")


def _screened(spark, sf_dir) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    rows = _matched(spark, sf_dir).select("doc_id", "provider", "topic_hits", "anchor_present", "local_relevance_tier").join(labels, "doc_id", "left")
    strict = F.coalesce(F.col("quality") == 1, F.lit(False))
    return matching.cascade(rows, SPEC, strict, F.col("toxic"))


_CASCADE = _MATCHED + """, r AS (SELECT t.doc_id, t.source, CASE WHEN toxic = 0 AND tier = 0 AND titled THEN 'tier0_title' WHEN coalesce(quality = 1, false) AND tier <> 999 THEN 'local_include'
WHEN coalesce(quality = 1, false) AND NOT anchor THEN 'anchor_missing' ELSE 'needs_llm' END AS screening_rule FROM t LEFT JOIN labels USING (doc_id)),
s AS (SELECT *, CASE screening_rule WHEN 'anchor_missing' THEN 'exclude' WHEN 'needs_llm' THEN 'pending' ELSE 'include' END AS screening_decision FROM r)"""


@query(_CASCADE + " SELECT doc_id, screening_rule, screening_decision FROM s")
def screening_cascade(spark, sf_dir):
    return _screened(spark, sf_dir).select("doc_id", "screening_rule", "screening_decision")


@query(_CASCADE + """ SELECT source AS provider, count(*) AS total, count_if(screening_decision = 'include') AS included, count_if(screening_decision = 'exclude') AS excluded, count_if(screening_decision = 'review') AS review,
count_if(screening_decision = 'include') AS deterministic_include, count_if(screening_decision = 'exclude') AS deterministic_exclude, count_if(screening_decision = 'pending') AS pending_llm_full_text,
0::BIGINT AS llm_screened, 0::BIGINT AS llm_error, 0::BIGINT AS llm_error_auto_excluded FROM s GROUP BY source""")
def grouped_screening_counts(spark, sf_dir):
    return audit.screening_counts(_screened(spark, sf_dir), "provider")


def _screening_rows(spark, sf_dir) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    return labels.select(F.lit("").alias("doi"), F.col("doc_id").cast("string").alias("provider_id"), F.when(F.col("quality") == 1, "include").otherwise("exclude").alias("screening_decision"), F.col("toxic").cast("string").alias("title_relevance_tier"), F.col("doc_id").cast("string").alias("source_rank"), F.col("doc_id").alias("ordinal"))


def _candidates(spark, sf_dir) -> DataFrame:
    return as_papers(spark, sf_dir).select(F.lit("").alias("doi"), F.col("doc_id").cast("string").alias("provider_id"), "provider", "n_chars", F.col("doc_id").alias("ordinal"))


@query("SELECT l.doc_id::VARCHAR AS provider_id, d.source AS provider, d.n_chars, l.toxic::VARCHAR AS title_relevance_tier FROM labels l JOIN documents d USING (doc_id) WHERE quality = 1")
def included_join(spark, sf_dir):
    rows = papers.exported(_candidates(spark, sf_dir), _screening_rows(spark, sf_dir), "ordinal")
    return rows.select("provider_id", "candidate.provider", "candidate.n_chars", "title_relevance_tier")


@query("SELECT l.doc_id::VARCHAR AS provider_id, d.source AS provider FROM labels l JOIN documents d USING (doc_id) WHERE quality = 1 AND d.n_chars > 1000 ORDER BY toxic, l.doc_id LIMIT 25")
def included_top_verified(spark, sf_dir):
    found = _candidates(spark, sf_dir).select("doi", "provider_id", F.when(F.col("n_chars") > 1000, "verified").otherwise("missing").alias("full_text_availability_status"), "ordinal")
    rows = papers.exported(_candidates(spark, sf_dir), _screening_rows(spark, sf_dir), "ordinal", 25, found, True)
    return rows.select("provider_id", "candidate.provider")


@query("SELECT min(doc_id) AS doc_id, k AS dedupe_key FROM (SELECT doc_id, " + _KEY + " AS k FROM documents) WHERE k NOT IN (SELECT " + _KEY + " FROM documents JOIN labels USING (doc_id)) GROUP BY k")
def anti_seen(spark, sf_dir):
    rows = as_papers(spark, sf_dir).select("doc_id", X.title_key(F.col("abstract")).alias("dedupe_key"))
    seen = rows.join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")
    return papers.unseen(rows, seen, "dedupe_key", "doc_id")


@query("SELECT doc_id, source, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AND doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def semi_ids(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "source", "lang"), table(spark, sf_dir, "labels")
    return sets.listed(docs, labels.filter("quality = 1"), "doc_id", without=labels.filter("toxic = 1"))


@query("SELECT o_orderkey, c_name, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING' ORDER BY o_totalprice DESC, o_orderkey LIMIT 50")
def export_topk(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").filter("c_mktsegment = 'BUILDING'").select("c_custkey", "c_name")
    rows = table(spark, sf_dir, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return rows.select("o_orderkey", "c_name", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(50)


@query("""WITH r AS (SELECT doc_id, source, n_chars, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS w FROM documents)
SELECT doc_id, source, CASE WHEN w = 1 THEN 1 ELSE 2 END AS selected_pass FROM r ORDER BY selected_pass, n_chars DESC, doc_id LIMIT 40""")
def first_per_group_then_fill(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    return papers.best_then_fill(docs, F.col("source"), F.col("n_chars"), "doc_id", 40).select("doc_id", "source", "selected_pass")


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS n FROM orders) WHERE n = 1")
def best_per_key(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return sets.best_of(orders, ["o_custkey"], "o_totalprice", "o_orderkey")


@query("SELECT 'cell' AS label_id, v AS \"value\", 'valid' AS status, count(*) AS paper_count FROM (SELECT lang AS v FROM documents UNION ALL SELECT source FROM documents) GROUP BY v")
def value_counts(spark, sf_dir):
    return audit.value_counts(table(spark, sf_dir, "documents").select(F.concat_ws("; ", "lang", "source", "lang").alias("cell")), [Label("cell")])


@query("""SELECT 'lang' AS label_id, v AS "value", CASE WHEN v IN ('en', 'fr', 'it') THEN 'valid' ELSE 'invalid' END AS status, count(lang) AS paper_count
FROM (SELECT unnest(['en', 'fr', 'de', 'es', 'it']) AS v) LEFT JOIN documents ON lang = v GROUP BY v""")
def fixed_value_counts(spark, sf_dir):
    return audit.value_counts(table(spark, sf_dir, "documents").select("lang"), [Label("lang", "controlled_fixed", ["en", "fr", "it"])])


@query("""WITH c AS (SELECT event_type AS v, count(*) AS n FROM events GROUP BY 1), t AS (SELECT count(*) AS n FROM events), a AS (SELECT unnest(['click', 'view', 'never', 'purchase']) AS v)
SELECT 'event_type' AS field, a.v AS "value", 'unused_value_distribution_warning' AS issue, 0::BIGINT AS "count", t.n AS applicable_rows FROM a, t WHERE a.v NOT IN (SELECT v FROM c)
UNION ALL SELECT 'event_type', c.v, 'dominant_value_distribution_warning', c.n, t.n FROM c, t WHERE c.n >= 0.9 * t.n
UNION ALL SELECT 'always', 'yes', 'dominant_value_distribution_warning', count_if(event_type = 'click'), count_if(event_type = 'click') FROM events
UNION ALL SELECT 'always', 'no', 'unused_value_distribution_warning', 0, count_if(event_type = 'click') FROM events""")
def distribution_audit(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_type", F.lit("yes").alias("always"))
    return audit.distribution_issues(rows, [Category("event_type", ["click", "view", "never", "purchase"]), Category("always", ["yes", "no"], parent="event_type", triggers=["click"])])


_ORDERS = [Category("status", ["O", "F"], "single", True), Category("tags", ["1-URGENT", "O"], "single", parent="status", triggers=["O", "P"])]


@query("""WITH o AS (SELECT o_orderkey, o_orderstatus AS s, o_orderpriority AS p FROM orders)
SELECT o_orderkey, 'status' AS field, s AS "value", 'invalid_value' AS issue FROM o WHERE s NOT IN ('O', 'F')
UNION ALL SELECT o_orderkey, 'tags', p, 'invalid_value' FROM o WHERE s IN ('O', 'P') AND p <> '1-URGENT'
UNION ALL SELECT o_orderkey, 'tags', s, 'invalid_value' FROM o WHERE s = 'P'
UNION ALL SELECT o_orderkey, 'tags', p || '; ' || s, 'single_selection_has_multiple_values' FROM o WHERE s IN ('O', 'P')
UNION ALL SELECT o_orderkey, 'tags', p || '; ' || s, 'inapplicable_category_has_value' FROM o WHERE s NOT IN ('O', 'P')""")
def row_audit(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"), F.concat_ws("; ", "o_orderpriority", "o_orderstatus").alias("tags"))
    return audit.row_issues(orders, "o_orderkey", _ORDERS)


@query("""WITH j AS (SELECT l.doc_id IS NULL AS e, d.lang FROM documents d LEFT JOIN labels l USING (doc_id))
SELECT 'quality' AS field, count_if(e) AS empty, count(*) AS total FROM j HAVING count_if(e) >= 0.5 * count(*)""")
def missingness(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang").join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    return audit.missingness(rows, ["quality", "lang"])


@query("SELECT l_orderkey::VARCHAR AS l_orderkey, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) > 1")
def duplicate_ids(spark, sf_dir):
    return audit.duplicate_ids(table(spark, sf_dir, "lineitem").select("l_orderkey"), "l_orderkey")


@query("""WITH j AS (SELECT l.quality, d.lang FROM documents d LEFT JOIN labels l USING (doc_id))
SELECT 'quality' AS label_id, count(quality) AS papers_with_usable_value, count(*) AS total, round(count(quality) / count(*), 4) AS ratio FROM j
UNION ALL SELECT 'lang', count_if(lang IN ('en', 'de')), count(*), round(count_if(lang IN ('en', 'de')) / count(*), 4) FROM j""")
def coverage_ratio(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang").join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    return audit.coverage(rows, [Label("quality", "free_text"), Label("lang", "controlled_fixed", ["en", "de"])])


@query("SELECT min(year(o_orderdate))::INT AS first_year, max(year(o_orderdate))::INT AS last_year FROM orders")
def year_range(spark, sf_dir):
    return audit.year_range(table(spark, sf_dir, "orders"), F.date_format("o_orderdate", "yyyy"))


@query("SELECT l_shipdate::DATE::VARCHAR AS issue, count(*) AS n FROM lineitem GROUP BY 1")
def issue_counts(spark, sf_dir):
    return audit.issue_counts(table(spark, sf_dir, "lineitem").select(F.col("l_shipdate").cast("date").cast("string").alias("issue")))


@query("""SELECT doc_id, round(least(8, 1.2 * ln(1 + n_chars)) + least(6, 1.5 * ln(1 + n_chars / greatest(1, 2025 - (1990 + doc_id % 40) + 1)))
+ CASE WHEN greatest(0, 2025 - (1990 + doc_id % 40)) <= 2 THEN 15 WHEN greatest(0, 2025 - (1990 + doc_id % 40)) <= 5 THEN 12 WHEN greatest(0, 2025 - (1990 + doc_id % 40)) <= 10 THEN 8 WHEN greatest(0, 2025 - (1990 + doc_id % 40)) <= 20 THEN 4 ELSE 1 END
+ CASE WHEN text <> '' THEN 5 ELSE 0 END, 3) AS score FROM documents""")
def relevance_score(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").withColumn("year", 1990 + F.col("doc_id") % 40)
    rate = X.citation_rate(F.col("n_chars"), F.col("year"), 2025)
    score = F.least(F.lit(8.0), 1.2 * F.log1p("n_chars")) + F.least(F.lit(6.0), 1.5 * F.log1p(rate)) + X.recency(F.col("year"), 2025) + F.when(F.col("text") != "", 5.0).otherwise(0.0)
    return rows.select("doc_id", F.round(score, 3).alias("score"))


@query("SELECT l_suppkey AS query, max(l_linenumber) AS consumed, max(l_linenumber) // 3 + 1 AS page, max(l_linenumber) % 3 AS \"offset\" FROM lineitem GROUP BY 1")
def resume_state(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("query_id"), F.col("l_linenumber").alias("query_rank"))
    return state.resume_state(rows, "query_id", "query_rank", 3)


@query("SELECT event_id, event_type, n AS accept_rank FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS n FROM events) WHERE n <= ceil(100 / 3)")
def quota_accept(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    return state.accepted(events, "event_type", [F.col("ts"), F.col("event_id")], 100, 3).select("event_id", "event_type", "accept_rank")


@query("SELECT event_id, row_number() OVER (ORDER BY ts, event_id) + 1000 AS rank FROM events")
def global_rank(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    return state.ranked(events, [F.col("ts"), F.col("event_id")], after=1000).select("event_id", "rank")


@query("""SELECT key, first_source FROM (SELECT key, first_source, row_number() OVER (PARTITION BY key ORDER BY o, i) AS n FROM (
SELECT lower(text) AS key, 'documents' AS first_source, 1 AS o, doc_id AS i FROM documents UNION ALL SELECT lower(text), 'benchmark', 2, item_id FROM benchmark)) WHERE n = 1""")
def union_first_seen(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.lower("text").alias("key"), F.lit("documents").alias("first_source"), F.col("doc_id").alias("i"))
    bench = table(spark, sf_dir, "benchmark").select(F.lower("text").alias("key"), F.lit("benchmark").alias("first_source"), F.col("item_id").alias("i"))
    return sets.union_distinct([docs, bench], "key", "i").select("key", "first_source")


@query("SELECT 'both' AS kind, k FROM (SELECT c_custkey AS k FROM customer INTERSECT SELECT o_custkey FROM orders) UNION ALL SELECT 'without_orders', k FROM (SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders)")
def set_ops(spark, sf_dir):
    customers, orders = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")), table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"))
    both, lone = sets.intersection(customers, orders, "k"), sets.difference(customers, orders, "k")
    return both.select(F.lit("both").alias("kind"), "k").unionByName(lone.select(F.lit("without_orders").alias("kind"), "k"))


@query("SELECT doc_id, text FROM documents")
def rebuild_text(spark, sf_dir):
    words = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", " ")).alias("p", "w"))
    # word -> positions, as providers send abstracts
    index = words.groupBy("doc_id", "w").agg(F.collect_list("p").alias("at")).groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("w", "at"))).alias("i"))
    return index.select("doc_id", X.inverted_index_text(F.col("i")).alias("text"))


_TITLES = "CASE doc_id % 8 WHEN 0 THEN 'A Review of ' WHEN 1 THEN 'peer reviewed ' WHEN 2 THEN 'Meta-Analyses: ' WHEN 3 THEN 'metaanalysis ' WHEN 4 THEN 'A scoping study ' WHEN 5 THEN 'Previews ' ELSE '' END || split_part(text, chr(10), 1)"
_KINDS = "CASE doc_id % 5 WHEN 0 THEN 'article; Review' WHEN 1 THEN 'peer reviewed article' WHEN 2 THEN 'Meta-Analysis|x' ELSE '' END"


def _reviewable(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.expr(_TITLES.replace("split_part(text, chr(10), 1)", "substring_index(text, '\\n', 1)")).alias("title"), F.expr(_KINDS).alias("article_type"))


@query(f"""WITH d AS (SELECT doc_id, lower({_TITLES}) AS t, lower({_KINDS}) AS k FROM documents)
SELECT doc_id, regexp_matches(t, '(^|[^a-z0-9_])reviews?($|[^a-z0-9_])') OR regexp_matches(t, '(^|[^a-z0-9_])meta[-\\s]?analys(is|es)($|[^a-z0-9_])')
OR list_has_any(list_transform(regexp_split_to_array(k, '[;,|]'), lambda x: replace(replace(trim(x), '-', '_'), ' ', '_')), ['review', 'meta_analysis']) AS likely_review FROM d""")
def review_filter(spark, sf_dir):
    rows = _reviewable(spark, sf_dir)
    reviews, others = papers.split(rows, papers.review_papers(rows))
    return others.select("doc_id", F.lit(False).alias("likely_review")).unionByName(reviews.select("doc_id", F.lit(True).alias("likely_review")))


@query(f"""WITH d AS (SELECT doc_id, lower({_TITLES}) AS t FROM documents)
SELECT doc_id, contains(t, 'systematic review') OR contains(t, 'scoping review') OR contains(t, 'meta-analysis') OR contains(t, 'meta analysis') OR contains(t, 'literature review') OR doc_id % 11 = 0 AS review, contains(t, 'protocol') AS not_primary FROM d""")
def candidate_review_filter(spark, sf_dir):
    rows, kind = _reviewable(spark, sf_dir), F.when(F.col("doc_id") % 11 == 0, "Review").otherwise("article")
    return rows.select("doc_id", papers.is_review_candidate(F.col("title"), kind).alias("review"), papers.is_not_primary(F.col("title")).alias("not_primary"))


@query("SELECT c_custkey, regexp_replace(regexp_replace(lower(c_name), '[^a-z0-9]+', '_', 'g'), '^_|_$', '', 'g') AS slug, 'Smith and ' || c_mktsegment AS label, '(Smith and ' || c_mktsegment || ', 2020)' AS inline FROM customer")
def citation_labels(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").withColumn("authors", F.concat(F.lit("Smith, John; Jane "), "c_mktsegment"))
    return rows.select("c_custkey", X.slug(F.col("c_name")).alias("slug"), X.author_label(F.col("authors")).alias("label"), X.harvard_inline(F.col("authors"), F.lit(2020)).alias("inline"))


@query("SELECT page_id, lower(regexp_extract(url, '^[A-Za-z]+://[^/?#]*', 0)) || regexp_replace(substr(url, len(regexp_extract(url, '^[A-Za-z]+://[^/?#]*', 0)) + 1), '#.*$', '') AS cache_key, regexp_matches(url, '^(?i:https?)://[^/\\s{}<>]+[^\\s{}<>]*$') AS valid FROM pages")
def url_functions(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", X.cache_url(F.col("url")).alias("cache_key"), X.is_http_url(F.col("url")).alias("valid"))


@query(f"""SELECT {_TITLE} AS title, CASE source WHEN 'src1' THEN 'core_topic' ELSE 'off_topic' END AS categoric, CASE WHEN doc_id % 2 = 0 THEN 'claim ' || doc_id ELSE trim({_TITLE}) END AS semantic,
doc_id::VARCHAR AS paper_id, '2020' AS year, '' AS doi, CASE source WHEN 'src1' THEN 'core_topic; x' ELSE 'off_topic; adjacent_but_relevant' END AS fit, lang || '; other' AS tag FROM documents WHERE source IN ('src1', 'src2')""")
def analytics_export(spark, sf_dir):
    fit = F.when(F.col("provider") == "src1", "core_topic; x").when(F.col("provider") == "src2", "off_topic; adjacent_but_relevant").otherwise("off_topic")
    rows = as_papers(spark, sf_dir).select(F.col("doc_id").cast("string").alias("paper_id"), "title", F.lit("2020").alias("year"), F.lit("").alias("doi"), F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("claim "), "doc_id")).otherwise("").alias("main_knowledge_claim"), fit.alias("fit"), F.concat("lang", F.lit("; other")).alias("tag"))
    return papers.export_rows(rows, "fit", "tag")


@query("""SELECT 'malformed_quote_json' AS issue, 'error' AS severity, item_id FROM benchmark WHERE item_id % 3 = 0
UNION ALL SELECT 'quote_json_not_list', 'error', item_id FROM benchmark WHERE item_id % 3 = 1 UNION ALL SELECT 'quote_missing_section', 'warning', item_id FROM benchmark WHERE item_id % 3 = 2""")
def quote_validation(spark, sf_dir):
    rows = table(spark, sf_dir, "benchmark")
    made = F.when(F.col("item_id") % 3 == 0, F.lit("[{")).when(F.col("item_id") % 3 == 1, F.lit('{"quote": "x"}')).otherwise(F.to_json(F.array(F.struct(F.col("text").alias("quote"), F.lit("").alias("section")))))
    return audit.quote_issues(rows.withColumn("quotes", made), "item_id", "quotes")


@query("SELECT doc_id, '' AS error, CASE WHEN lang = 'en' THEN 'include' ELSE 'exclude' END AS decision FROM documents")
def model_screening(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang")
    told = model.per_row(rows, "doc_id", "language $lang", {"required": ["anchor_present"]}, _client)
    present = F.get_json_object("answer", "$.anchor_present").cast("boolean")
    none = F.array().cast("array<string>")
    return told.select("doc_id", "error", matching.verdict(present, none, none, "anchor")["decision"].alias("decision"))


def _client():
    return model.Static(lambda prompt: '{"anchor_present": %s}' % ("true" if prompt.endswith(" en") else "false"))


CONTRACT = {
    "topic_id": "rights",
    "research_topic": {"title": "Thanea attion", "description": "Eriner and anea of the license"},
    "topic_structure": {
        "anchor_topic_id": "rights",
        "anchor_reason": "all papers have it",
        "main_topics": [
            {"topic_id": "rights", "label": "Rights", "terms": ["rights reserved", "thanedble anea"], "field": "title"},
            {"topic_id": "license", "label": "License", "terms": ["apache license"], "field": "title_or_abstract"},
        ],
        "secondary_topics": {"license": ["version"]},
    },
    "scope": {"include_criteria": ["version"], "exclude_criteria": ["menu"], "boundary_rules": []},
    "rule_based_screening": {"include_terms": ["rights", "thane"], "exclude_terms": ["cookie"], "exclude_wins": True},
    "candidate_screening": {"missing_abstract_policy": "review", "borderline_policy": "review", "human_review_policy": "none"},
    "tagging": {"fallback_policy": {}, "categories": {"lang": {"values": ["en", "fr"]}}},
    "collection": {"allowed_providers": ["recorded"], "preferred_provider": "recorded"},
}


def _sql_list(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]::VARCHAR[]"


_PLAIN_STOP = """about across after also among and are based application applications been being between both can could does evidence explores for from has have how
impact into its may methods more not outcomes research settings that the their these this through use used using what when where which with within""".split()


def _sql_tokens(key: str) -> str:
    return f"list_distinct(list_filter(string_split({key}, ' '), lambda w: (len(w) >= 3 OR w = 'ai') AND NOT list_contains({_sql_list(_PLAIN_STOP)}, w)))"


def _sql_shared(tokens: str, words) -> str:
    return f"len(list_intersect({tokens}, {_sql_list(words)}))"


def _sql_held(terms) -> str:
    return "(" + " + ".join(f"contains(k, '{t}')::INT" for t in terms) + ")"


_WORDS = {"titled": ["thanea", "attion"], "wanted": ["rights", "thane"], "researched": ["thanea", "attion", "eriner", "anea", "license"], "scoped": ["version", "menu"]}
_TERMS = ["thanea", "attion", "eriner", "anea", "license", "rights", "reserved", "thanedble", "apache", "version"]
_PHRASES = ["thanea attion", "eriner and anea", "eriner and anea of", "and anea of the license", "anea of the license", "rights reserved", "thanedble anea", "apache license"]
_TITLE_KEY = f"trim(regexp_replace(lower({_TITLE}), '[^a-z0-9]+', ' ', 'g'))"


@query(f"""WITH d AS (SELECT doc_id, n_chars AS c, (1990 + doc_id % 40)::INT AS y, text, trim(regexp_replace(lower({_TITLE} || ' ' || text || ' ' || source), '[^a-z0-9]+', ' ', 'g')) AS k FROM documents),
t AS (SELECT *, {_sql_tokens('k')} AS w FROM d),
n AS (SELECT *, {', '.join(f"{_sql_shared('w', v)} AS {k}" for k, v in _WORDS.items())}, {_sql_held(['rights', 'thane'])} AS i, {_sql_held(['cookie'])} AS e, {_sql_held(['systematic review', 'scoping review', 'rapid review', 'umbrella review', 'meta analysis', 'review', 'overview', 'survey'])} AS r, greatest(0, 2025 - y) AS age FROM t)
SELECT doc_id, i > 0 OR wanted > 0 OR titled > 0 AS on_topic, round(30 * titled + 18 * wanted + 6 * researched + 2 * scoped + least(180, 60 * i) - 120 * e - CASE WHEN i > 0 OR wanted > 0 OR titled > 0 THEN 0 ELSE 120 END
+ least(8, 1.2 * ln(1 + c)) + least(6, 1.5 * ln(1 + c / greatest(1, 2025 - y + 1))) + CASE WHEN age <= 2 THEN 15 WHEN age <= 5 THEN 12 WHEN age <= 10 THEN 8 WHEN age <= 20 THEN 4 ELSE 1 END
+ CASE WHEN text <> '' THEN 5 ELSE 0 END + least(12, 4 * r), 3) AS score FROM n""")
def seed_score(spark, sf_dir):
    rows = as_papers(spark, sf_dir).select("doc_id", "title", "abstract", F.col("provider").alias("venue"), F.col("n_chars").alias("cited_by_count"), (1990 + F.col("doc_id") % 40).cast("int").alias("year"))
    return seeds.scored(rows, CONTRACT, 2025).select("doc_id", "on_topic", F.round("review_score", 3).alias("score"))


@query(f"""WITH d AS (SELECT doc_id, text, {_TITLE_KEY} AS tk, {_sql_tokens(_TITLE_KEY)} AS tw, {_sql_tokens(_KEY)} AS xw FROM documents),
m AS (SELECT doc_id, text, tk, list_intersect(tw, {_sql_list(_TERMS)}) AS t, list_intersect(xw, {_sql_list(_TERMS)}) AS x FROM d)
SELECT doc_id, CASE WHEN trim(text) = '' OR text IS NULL THEN 'no_text'
WHEN NOT (len(t) >= 2 OR (len(t) > 0 AND ({' OR '.join(f"contains(' ' || tk || ' ', ' {p} ')" for p in _PHRASES)}))) THEN 'title_off_topic'
WHEN NOT (len(x) >= 2 OR list_has_any(t, x)) THEN 'text_off_topic' ELSE '' END AS why FROM m""")
def topic_eligibility(spark, sf_dir):
    rows = as_papers(spark, sf_dir).withColumnRenamed("abstract", "text")
    return seeds.eligible(rows, CONTRACT).select("doc_id", "why")


# another list of words than that of eligibility: "platform" counts here, and "ai" doesn't
_CHOSEN = ["thanea", "attion", "eriner", "anea", "license", "rights", "reserved", "thanedble", "apache", "version", "platform"]
_SUBJECT = f"CASE doc_id % 9 WHEN 0 THEN 'A review of platform ai ' WHEN 1 THEN 'Systematic Review ' WHEN 2 THEN 'Study protocol ' WHEN 3 THEN 'Platform ' ELSE '' END || {_TITLE}"
_SUBJECT_KEY = f"trim(regexp_replace(lower({_SUBJECT}), '[^a-z0-9]+', ' ', 'g'))"


@query(f"""WITH d AS (SELECT doc_id, {_SUBJECT} AS title, {_sql_shared(_sql_tokens(_SUBJECT_KEY), _CHOSEN)} AS t, {_sql_shared(_sql_tokens(_KEY), _CHOSEN)} AS x,
row_number() OVER (PARTITION BY CASE WHEN trim({_SUBJECT}) <> '' THEN lower(trim({_SUBJECT})) ELSE 'paper_' || doc_id END ORDER BY doc_id) AS w FROM documents WHERE lang <> 'es')
SELECT doc_id, x AS matches, 10 * t + 5 * x AS score FROM d WHERE w = 1 AND x >= 2 AND NOT contains(lower(title), 'protocol') AND NOT contains(lower(title), 'systematic review')
ORDER BY matches DESC, score DESC, doc_id LIMIT 20""")
def calibration_topk(spark, sf_dir):
    rows = as_papers(spark, sf_dir).withColumn("title", F.concat(F.expr("CASE doc_id % 9 WHEN 0 THEN 'A review of platform ai ' WHEN 1 THEN 'Systematic Review ' WHEN 2 THEN 'Study protocol ' WHEN 3 THEN 'Platform ' ELSE '' END"), "title"))
    rows = rows.select("doc_id", F.lit("").alias("doi"), F.lit("").alias("paper_id"), "title", "abstract", F.col("abstract").alias("text"), F.when(F.col("lang") == "es", "").otherwise("include").alias("scope_decision"))
    wanted = {**CONTRACT, "scope": {**CONTRACT["scope"], "include_criteria": ["version", "platform ai"]}}
    return seeds.calibration_papers(rows, wanted, 20, "doc_id").select("doc_id", F.col("matches").cast("long").alias("matches"), F.col("score").cast("long").alias("score"))


def _answers(urls: DataFrame) -> DataFrame:
    ok = F.col("url").endswith("0")
    return urls.select("url", ok.alias("ok"), F.when(ok, "text/html").otherwise("").alias("content_type"), F.col("url").alias("final_url"), F.when(ok, "").otherwise("HEAD: HTTP 404").alias("error"))


@query("""SELECT l.doc_id::VARCHAR AS provider_id, CASE WHEN l.doc_id % 7 = 0 THEN 'verified' WHEN quality <> 1 THEN 'skipped_not_included' WHEN l.doc_id % 11 = 0 THEN 'candidate_missing'
WHEN l.doc_id % 13 = 0 THEN 'not_available' WHEN l.doc_id % 10 = 0 OR d.n_chars % 10 = 0 THEN 'verified' ELSE 'unverified' END AS status,
CASE WHEN l.doc_id % 7 = 0 THEN 'known' WHEN quality <> 1 OR l.doc_id % 11 = 0 OR l.doc_id % 13 = 0 THEN '' WHEN l.doc_id % 10 <> 0 AND d.n_chars % 10 = 0 THEN 'http://b/' || d.n_chars ELSE 'http://a/' || l.doc_id END AS url
FROM labels l JOIN documents d USING (doc_id)""")
def availability_join(spark, sf_dir):
    docs = as_papers(spark, sf_dir).filter("doc_id % 11 <> 0")  # so many candidates are unknown
    place = lambda url: F.struct(F.lit("provider").alias("source"), url.alias("url"), F.lit("pdf").alias("kind"), F.lit("").alias("license"), F.lit("").alias("is_open_access"))
    places = F.array(place(F.concat(F.lit("http://a/"), "doc_id")), place(F.concat(F.lit("http://b/"), "n_chars")))
    made = docs.select(F.lit("").alias("doi"), F.col("doc_id").cast("string").alias("provider_id"), F.col("doc_id").alias("ordinal"), F.when(F.col("doc_id") % 13 == 0, F.array().cast(availability.LOCATIONS)).otherwise(places).alias("full_text_locations"))
    screening = _screening_rows(spark, sf_dir).withColumn("paper_id", F.col("provider_id"))
    told = {c: F.lit("") for c in availability.ANSWER} | {"full_text_availability_status": F.lit("verified"), "full_text_url": F.lit("known")}
    existing = screening.filter("ordinal % 7 = 0").withColumns(told)
    rows = availability.verified(made, screening, "ordinal", _answers, existing)
    return rows.select("provider_id", F.col("full_text_availability_status").alias("status"), F.col("full_text_url").alias("url"))


_REVIEW_LABELS = [Label("lang", allowed=["en", "fr"], mappings={"de": "en"}, dropped=["es"]), Label("source", "controlled_fixed", allowed=["src1", "src2", "web"], required=True), Label("quotes", "evidence_quote")]
_LANGS = "CASE lang WHEN 'de' THEN 'review_value_mapped' WHEN 'es' THEN 'review_value_dropped' ELSE 'invalid_review_value' END"
_QUALITY = """(SELECT doc_id::VARCHAR AS paper_id, 'venue' AS field, '' AS "value", 'recommended_metadata_missing' AS issue, 'warning' AS severity FROM documents WHERE doc_id % 5 = 0
UNION ALL SELECT doc_id::VARCHAR, 'title', '', 'required_metadata_missing', 'error' FROM documents WHERE trim(""" + _TITLE + f""") = ''
UNION ALL SELECT doc_id::VARCHAR, 'lang', lang, {_LANGS}, 'warning' FROM documents WHERE lang NOT IN ('en', 'fr')
UNION ALL SELECT doc_id::VARCHAR, 'source', source, 'invalid_review_value', 'error' FROM documents WHERE source NOT IN ('src1', 'src2', 'web')
UNION ALL SELECT doc_id::VARCHAR, 'quotes', '', 'quote_missing_section', 'warning' FROM documents WHERE doc_id % 3 = 0)"""


def _reviewed(spark, sf_dir) -> DataFrame:
    rows = as_papers(spark, sf_dir)
    quotes = F.to_json(F.array(F.struct(F.lit("x").alias("quote"), F.when(F.col("doc_id") % 3 == 0, "").otherwise("s").alias("section"))))
    return rows.select(F.col("doc_id").cast("string").alias("paper_id"), "title", F.lit("2020").alias("year"), F.lit("d").alias("doi"), F.lit("A").alias("authors"), F.when(F.col("doc_id") % 5 == 0, "").otherwise("V").alias("venue"), "lang", F.col("provider").alias("source"), quotes.alias("quotes"))


@query(f"SELECT * FROM {_QUALITY} WHERE issue <> ''")
def review_quality(spark, sf_dir):
    return reviews.issues(_reviewed(spark, sf_dir), _REVIEW_LABELS).drop("detail")


@query(f"SELECT DISTINCT paper_id FROM {_QUALITY} WHERE severity = 'error'")
def problem_papers(spark, sf_dir):
    return reviews.problem_papers(reviews.issues(_reviewed(spark, sf_dir), _REVIEW_LABELS), _REVIEW_LABELS)


@query(f"""WITH u AS (SELECT doc_id, lang, source FROM documents WHERE doc_id::VARCHAR NOT IN (SELECT paper_id FROM {_QUALITY} WHERE severity = 'error'))
SELECT doc_id::VARCHAR AS paper_id, 'lang' AS label_id, CASE lang WHEN 'de' THEN 'en' ELSE lang END AS "values", 0 AS n_quotes FROM u WHERE lang IN ('en', 'fr', 'de')
UNION ALL SELECT doc_id::VARCHAR, 'source', source, 0 FROM u UNION ALL SELECT doc_id::VARCHAR, 'quotes', '', 1 FROM u""")
def review_evidence(spark, sf_dir):
    rows = _reviewed(spark, sf_dir)
    found = reviews.evidence(rows, reviews.issues(rows, _REVIEW_LABELS), _REVIEW_LABELS)
    return found.select("paper_id", "label_id", F.array_join("values", "; ").alias("values"), F.size("quotes").alias("n_quotes"))


@query("""SELECT l.doc_id, CASE WHEN quality = 1 THEN 'include' WHEN d.n_chars > 1000 THEN d.lang ELSE 'review' END AS decision,
CASE WHEN quality = 1 THEN 'deterministic_include' WHEN d.n_chars > 1000 THEN 'llm_screened' ELSE 'pending_llm_full_text' END AS status FROM labels l JOIN documents d USING (doc_id)""")
def finalized_screening(spark, sf_dir):
    good = F.col("screening_decision") == "include"
    rows = _screening_rows(spark, sf_dir).withColumns({"screening_decision": F.when(good, "include").otherwise("review"), "screening_status": F.when(good, "deterministic_include").otherwise("pending_llm_full_text")})
    known = as_papers(spark, sf_dir).select(F.lit("").alias("doi"), F.col("doc_id").cast("string").alias("provider_id"), "lang", "n_chars", F.col("doc_id").alias("ordinal"))
    places = known.select("doi", "provider_id", F.when(F.col("n_chars") > 1000, "verified").otherwise("unverified").alias("full_text_availability_status"))
    done = reviews.finalized(rows, known, places, "ordinal", lambda df: df.select("ordinal", F.col("lang").alias("screening_decision")))
    return done.select(F.col("ordinal").alias("doc_id"), F.col("screening_decision").alias("decision"), F.col("screening_status").alias("status"))


@query(f"""SELECT l.doc_id::VARCHAR AS paper_id, {_TITLE.replace('text', 'd.text')} AS title, 'collected:' || d.source AS source, 'provider=' || d.source || '; provider_id=' || d.doc_id || '; source_rank=; retrieval_date=; title_relevance_tier=' || toxic AS notes
FROM labels l JOIN documents d USING (doc_id) WHERE quality = 1""")
def canonical_papers(spark, sf_dir):
    known = as_papers(spark, sf_dir).select(F.lit("").alias("doi"), F.col("doc_id").cast("string").alias("provider_id"), "provider", "title", F.col("doc_id").alias("ordinal"))
    rows = papers.exported(known, _screening_rows(spark, sf_dir).withColumn("paper_id", F.col("provider_id")), "ordinal")
    return papers.canonical(rows, ["title_relevance_tier"]).select("paper_id", "title", "source", "notes")


@query("""WITH f AS (SELECT page_id, CASE WHEN page_id % 2 = 0 THEN trim(url) ELSE '' END AS a, 'http://b/' || page_id % 3 AS b FROM pages)
SELECT page_id, CASE WHEN a <> '' THEN a ELSE b END AS full_text_url, CASE WHEN a <> '' THEN b WHEN b <> 'http://b/1' THEN 'http://b/1' ELSE '' END AS pdf_url FROM f""")
def full_text_places(spark, sf_dir):
    rows = table(spark, sf_dir, "pages").withColumn("a", F.when(F.col("page_id") % 2 == 0, F.col("url")))
    other = F.concat(F.lit("http://b/"), (F.col("page_id") % 3).cast("string"))
    return papers.full_text_places(rows, [F.col("a"), other, F.lit("http://b/1")], F.lit("")).select("page_id", "full_text_url", "pdf_url")


@query("""WITH d AS (SELECT (n_chars % 3)::VARCHAR AS t, source AS q, doc_id % 4 AS d FROM documents)
SELECT 'all' AS kind, '' AS name, count(*) AS candidates, sum(d)::BIGINT AS duplicates_removed FROM d UNION ALL SELECT 'tier', t, count(*), sum(d)::BIGINT FROM d GROUP BY t UNION ALL SELECT 'query', q, count(*), sum(d)::BIGINT FROM d GROUP BY q""")
def fetch_counts(spark, sf_dir):
    rows = table(spark, sf_dir, "documents")
    return state.fetch_counts(rows.select((F.col("n_chars") % 3).alias("retrieval_tier"), F.col("source").alias("retrieval_query_id"), (F.col("doc_id") % 4 + 1).alias("in_fetch_duplicate_count")))


@query("""WITH s AS (SELECT conv_id AS section_id, list(turn ORDER BY turn) AS ids FROM conversations GROUP BY 1), p AS (SELECT section_id, generate_subscripts(ids, 1) - 1 AS place, unnest(ids) AS doc_id FROM s)
SELECT section_id, place::INT AS place, doc_id::VARCHAR AS paper_id FROM p JOIN documents USING (doc_id) WHERE n_chars % 2 = 0""")
def section_papers(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").groupBy(F.col("conv_id").alias("section_id")).agg(F.transform(F.array_sort(F.collect_list("turn")), lambda t: t.cast("string")).alias("paper_ids"))
    known = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("paper_id"), F.lit("T").alias("title"), F.when(F.col("n_chars") % 2 == 0, "2020").otherwise("n.d.").alias("year"), F.lit("A").alias("authors"), F.lit("d").alias("doi"))
    return documents.section_papers(turns, known).select("section_id", F.col("at").alias("place"), "paper_id")


# without SQL: parsing and fuzzy matching


@query()
def html_text(spark, sf_dir):
    from biblion.sources.fulltext import html_text as to_text

    return table(spark, sf_dir, "pages").select("page_id", to_text("html").alias("text"))


@query("""SELECT page_id, regexp_replace(replace(replace(replace(replace(replace(html, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&amp;?', '&', 'g') || ' & <b>é€ ¬it; &zzz; x' AS text FROM pages""")
def html_unescape(spark, sf_dir):
    more = F.lit(" &amp; &lt;b&gt;&eacute;&#x20AC; &notit; &zzz; x")
    return table(spark, sf_dir, "pages").select("page_id", X.html_unescape(F.concat("html", more)).alias("text"))


@query()
def sections(spark, sf_dir):
    from biblion.sources.fulltext import prioritized, split_sections

    rows = table(spark, sf_dir, "documents").select("doc_id", split_sections(F.col("text")).alias("s"))
    return rows.select("doc_id", F.posexplode(prioritized(F.col("s"))).alias("position", "x")).select("doc_id", "position", "x.*")


# one letter more in so long an id is close enough to its own only; two letters changed are too far
@query("SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'paper_on_' || (p_partkey % 7) || repeat('abcdefghij', 3 + (p_partkey % 7)) WHEN 1 THEN '' ELSE 'paper_on_' || (p_partkey % 7) || repeat('abcdefghij', 3 + (p_partkey % 7)) END AS resolved FROM part")
def fuzzy_ids(spark, sf_dir):
    from biblion.operators.fuzzy import resolved

    known = [f"paper_on_{k}" + "abcdefghij" * (3 + k) for k in range(7)]
    own = F.expr("concat('paper_on_', p_partkey % 7, repeat('abcdefghij', int(3 + p_partkey % 7)))")
    asked = F.expr("p_partkey % 3").cast("int")
    typed = F.when(asked == 0, own).when(asked == 1, F.concat(F.lit("other "), F.reverse(own))).otherwise(F.concat(own, F.lit("x")))
    return table(spark, sf_dir, "part").select("p_partkey", resolved(known)(typed).alias("resolved"))
