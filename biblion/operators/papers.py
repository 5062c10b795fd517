"""Paper records: normalization, scope, duplicates, joins between steps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from biblion.functions import text as X

REQUIRED = ["paper_id", "title", "year", "doi", "abstract"]
LAST = 999_999


def normalized(df: DataFrame, ordinal: str) -> DataFrame:
    """Clean fields, an id, availability flags and notes of what is missing; other columns are cleaned too."""
    missing = [c for c in REQUIRED if c not in df.columns]
    if missing:
        raise ValueError("missing columns: " + ", ".join(missing))
    own = {"title": X.clean_whitespace(F.col("title")), "year": X.year_of(F.col("year")), "doi": X.doi_display(F.col("doi"))}
    others = {c: X.clean_whitespace(F.col(c)) for c in df.columns if c not in own and c != ordinal}
    rows = df.withColumns(own | others)
    words = F.slice(F.regexp_extract_all(F.lower("title"), F.lit("[a-z0-9]+"), F.lit(0)), 1, 6)
    stem = F.when(F.size(words) > 0, F.array_join(words, "_")).otherwise(F.format_string("paper_%04d", F.col(ordinal)))
    made = F.when(F.col("year") != "", F.concat(stem, F.lit("_"), "year")).otherwise(stem)
    locator = X.first_value(*(F.col(c) for c in ("full_text_path", "full_text_url") if c in df.columns), F.lit(""))
    checks = {"missing_title": F.col("title"), "missing_year": F.col("year"), "missing_abstract": F.col("abstract"), "missing_full_text_path": locator}
    notes = F.array_join(F.array_compact(F.array(*(F.when(c == "", F.lit(n)) for n, c in checks.items()))), "; ")
    yes_no = lambda c: F.when(c != "", "yes").otherwise("no")
    return rows.withColumns({"paper_id": X.first_value(F.col("paper_id"), made), "abstract_available": yes_no(F.col("abstract")), "full_text_available": yes_no(locator), "metadata_notes": notes})


def matched_terms(normal: Column, terms: Sequence[str], tokens: Column | None = None) -> Column:
    """The terms that a screening_text() holds: by a variant as whole words, or by most of their tokens.

    ``tokens``: the meaningful tokens of the text, where a column holds them already.
    """
    tokens = X.meaningful_tokens(normal) if tokens is None else tokens
    hits = []
    for term in terms:
        found = X.token_overlap(tokens, term)
        for variant in X.term_variants(term):
            found = X.contains_phrase(normal, variant) | found
        hits.append(F.when(found, F.lit(term)))
    return F.array_compact(F.array(*hits)) if hits else F.array().cast("array<string>")


def scoped(df: DataFrame, include: Sequence[str], exclude: Sequence[str], exclude_wins: bool = True, text: Column | None = None, unescape: bool = True) -> DataFrame:
    """scope_decision and the terms behind it; a row that matches nothing is included."""
    if text is None:
        text = F.concat_ws(" ", X.text_of(F.col("title")), X.text_of(F.col("abstract")))
    wanted = sorted({t for term in [*include, *exclude] for t in X.term_tokens(term)})
    # a text is normalized once and split once; of its tokens only those that terms ask for stay
    rows = df.withColumn("_normal", X.screening_text(text, unescape))
    asked = F.array(*map(F.lit, wanted)).cast("array<string>")
    rows = rows.withColumn("_tokens", F.array_intersect(X.meaningful_tokens(F.col("_normal")), asked))
    rows = rows.withColumns({"_in": matched_terms(F.col("_normal"), include, F.col("_tokens")), "_out": matched_terms(F.col("_normal"), exclude, F.col("_tokens"))})
    away = (F.size("_out") > 0) & (F.lit(exclude_wins) | (F.size("_in") == 0))
    return rows.withColumns({"scope_decision": F.when(away, "exclude_or_route_elsewhere").otherwise("include"), "scope_matched_include_terms": F.array_join("_in", "; "), "scope_matched_exclude_terms": F.array_join("_out", "; ")}).drop("_normal", "_tokens", "_in", "_out")


def included(df: DataFrame, lenient: bool = False) -> DataFrame:
    """Rows in scope; leniently also those without a decision."""
    decision = X.text_of(F.col("scope_decision"))
    return df.filter(decision.isin("", "include") if lenient else decision == "include")


# What tells a review by its title, by its metadata, and a paper that isn't primary.
REVIEW_TITLE = r"(?iU)\breviews?\b|\bmeta[-\s]?analys(?:is|es)\b"
REVIEW_COLUMNS = ["type", "work_type", "publication_type", "publication_types", "article_type", "document_type", "paper_type"]
REVIEW_KINDS = ["review", "meta_analysis"]
CANDIDATE_REVIEW_TITLES = ["systematic review", "scoping review", "meta-analysis", "meta analysis", "literature review", "review and meta-analysis"]
NOT_PRIMARY_TITLES = ["protocol", "study protocol", "trial protocol"]


def is_review(title: Column, *kinds: Column) -> Column:
    """A review by a word of its title, or because a list of metadata names just that kind."""
    found = X.clean_whitespace(title).rlike(REVIEW_TITLE)
    for listed in kinds:
        names = F.transform(F.split(F.lower(X.clean_whitespace(listed)), "[;,|]"), lambda k: F.translate(F.trim(k), "- ", "__"))
        found = found | F.arrays_overlap(names, F.array(*map(F.lit, REVIEW_KINDS)))
    return found


def review_papers(df: DataFrame) -> Column:
    """is_review() by the title and all the metadata columns that a table has."""
    return is_review(F.col("title"), *(F.col(c) for c in REVIEW_COLUMNS if c in df.columns))


def is_review_candidate(title: Column, raw_type: Column | None = None) -> Column:
    """The rule for candidates, another than for papers: phrases within the title, or the provider's type."""
    low = F.lower(X.text_of(title))
    found = F.lit(False)
    for phrase in CANDIDATE_REVIEW_TITLES:
        found = found | low.contains(phrase)
    return found if raw_type is None else found | (F.lower(X.text_of(raw_type)) == "review")


def is_not_primary(title: Column) -> Column:
    low = F.lower(X.text_of(title))
    found = F.lit(False)
    for phrase in NOT_PRIMARY_TITLES:
        found = found | low.contains(phrase)
    return found


def split(df: DataFrame, predicate: Column) -> tuple[DataFrame, DataFrame]:
    """The rows for which a predicate holds, and the others."""
    sure = F.coalesce(predicate, F.lit(False))
    return df.filter(sure), df.filter(~sure)


def digest(key: Column) -> Column:
    """The SHA-256 of a key in 32 bytes: equal digests are equal keys; null stays null."""
    return F.unhex(F.sha2(key.cast("string").cast("binary"), 256))


def deduplicated(df: DataFrame, key: Column, has_abstract: Column, rank: Column, ordinal: str, provenance: Sequence[str] = (), locations: str | None = None) -> DataFrame:
    """The best row of each key, with the size of its group, an ordered provenance and merged locations.

    Best is with an abstract, then by rank, then first.  One aggregation with
    map-side combine, by the digest of the key, so that long keys aren't
    shuffled with every row; a key's rows come together as small structs only.
    """
    no_abstract = F.when(F.coalesce(has_abstract, F.lit(False)), 0).otherwise(1)
    order = F.struct(no_abstract.alias("no_abstract"), F.coalesce(rank.try_cast("bigint"), F.lit(LAST)).alias("rank"), F.col(ordinal).alias("ordinal"))
    rows = df.withColumns({"dedupe_key": key, "_order": order}).withColumn("_digest", digest(F.col("dedupe_key")))
    whole = F.struct("_order", F.struct(*df.columns).alias("row"))
    aggregates = [F.min("dedupe_key").alias("dedupe_key"), F.min_by(whole, "_order").alias("_best"), F.count("*").alias("duplicate_count")]
    if provenance:
        aggregates.append(F.array_sort(F.collect_list(F.struct("_order", *provenance))).alias("_all"))
    if locations:
        aggregates.append(F.array_sort(F.collect_list(F.struct("_order", F.col(locations).alias("l")))).alias("_places"))
    best = rows.groupBy("_digest").agg(*aggregates)
    out = best.select("dedupe_key", "duplicate_count", "_best._order", "_best.row.*", *(["_all"] if provenance else []), *(["_places"] if locations else []))
    if provenance:
        out = out.withColumn("duplicate_provenance", F.transform("_all", lambda p: F.struct(*(p[c].alias(c) for c in provenance)))).drop("_all")
    if locations:
        flat = F.flatten(F.transform("_places", lambda p: p["l"]))
        out = out.withColumn(locations, first_seen(flat, lambda x: F.trim(X.text_of(x["url"])))).drop("_places")
    return out


def dedupe_counts(df: DataFrame, key: Column) -> DataFrame:
    """rows_in, groups, duplicates of a deduplication, in one row; keys meet as digests."""
    keys = df.groupBy(digest(key).alias("k")).agg(F.count("*").alias("n"))
    return keys.agg(F.sum("n").alias("rows_in"), F.count("*").alias("groups"), (F.sum("n") - F.count("*")).alias("duplicates"))


def first_seen(items: Column, by) -> Column:
    """The items of an array whose key isn't empty and didn't stand before."""
    keyed = F.filter(items, lambda x: by(x) != "")
    keys = F.transform(keyed, by)
    return F.filter(keyed, lambda x, i: F.array_position(keys, by(x)) == i + 1)


def unseen(new: DataFrame, seen: DataFrame, key: str, ordinal: str) -> DataFrame:
    """New rows whose key isn't seen yet, the first of each key; keys meet as digests."""
    told = seen.select(digest(F.col(key)).alias("_digest")).distinct()
    fresh = new.withColumn("_digest", digest(F.col(key))).join(told, "_digest", "left_anti")
    # rows without a key were never seen, and are one
    best = fresh.groupBy("_digest").agg(F.min_by(F.struct(*new.columns), ordinal).alias("r"))
    return best.select("r.*")


def last_of(df: DataFrame, keys: Sequence[str], ordinal: str) -> DataFrame:
    """One row of each key, the last."""
    return df.groupBy(*keys).agg(F.max_by(F.struct(*df.columns), ordinal).alias("r")).select("r.*")


def join_key(doi: Column, provider_id: Column) -> list[Column]:
    """Lower-cased DOI (prefixes stay) and provider id."""
    return [F.lower(F.trim(X.text_of(doi))).alias("key_doi"), F.trim(X.text_of(provider_id)).alias("key_id")]


def exported(candidates: DataFrame, screening: DataFrame, ordinal: str, limit: int | None = None, availability: DataFrame | None = None, verified_only: bool = False) -> DataFrame:
    """Included screening rows with their candidates, by tier and rank; one without a candidate is an error."""
    keys = ["key_doi", "key_id"]
    left = screening.filter("screening_decision = 'include'").select("*", *join_key(F.col("doi"), F.col("provider_id")))
    right = last_of(candidates.select("*", *join_key(F.col("doi"), F.col("provider_id"))), keys, ordinal)
    right = right.select(*keys, F.struct(*candidates.columns).alias("candidate"), F.lit(True).alias("found"))
    rows = left.join(right, keys, "left")
    said = F.concat(F.lit("no candidate for included row: doi="), "key_doi", F.lit(" provider_id="), "key_id")
    rows = rows.withColumn("candidate", F.when(F.col("found"), F.col("candidate")).otherwise(F.raise_error(said))).drop("found")
    if availability is not None:
        known = availability.select("*", *join_key(F.col("doi"), F.col("provider_id"))).filter("key_doi <> '' OR key_id <> ''")
        known = last_of(known, keys, ordinal).select(*keys, F.struct(*availability.columns).alias("availability"))
        rows = rows.join(known, keys, "left")
        if verified_only:
            rows = rows.filter("availability.full_text_availability_status = 'verified'")
    rows = rows.orderBy(X.safe_int(F.col("title_relevance_tier")), X.safe_int(F.col("source_rank")), F.col(ordinal))
    # a limit of 0 still exports one row
    return rows if limit is None else rows.limit(max(1, limit))


def best_then_fill(df: DataFrame, query: Column, score: Column, ordinal: str, most: int, identity: Column | None = None) -> DataFrame:
    """The best row of each query first, then the best of the rest, ``most`` in all; an empty query blocks nothing."""
    rows = df.withColumns({"_query": X.text_of(query), "_score": score, "_id": identity if identity is not None else F.col(ordinal)})
    order = [F.desc("_score"), F.col(ordinal)]
    rows = rows.withColumn("_n", F.row_number().over(Window.partitionBy("_id").orderBy(*order))).filter("_n = 1")
    within = F.row_number().over(Window.partitionBy("_query").orderBy(*order))
    rows = rows.withColumn("selected_pass", F.when((F.col("_query") == "") | (within == 1), 1).otherwise(2))
    return rows.orderBy("selected_pass", *order).limit(most).drop("_query", "_score", "_id", "_n")


# Fixed values of the export's format.
EXPORT_CORE = ["title", "categoric", "semantic", "paper_id", "year", "doi"]
EXPORTED_FITS = ["core_topic", "adjacent_but_relevant"]


def export_rows(df: DataFrame, fit: str | None = None, target: str | None = None, claim: str = "main_knowledge_claim") -> DataFrame:
    """Six core columns and the tag columns of rows that fit the topic.

    Tags are the columns behind the claim, without one all but id, title, year
    and DOI.  The category is the first value of the fit, else of the target,
    else of any tag; a row without one is an error.  Without the fit's column
    every row is exported.
    """
    lacking = [c for c in ("paper_id", "title") if c not in df.columns]
    if lacking:
        raise ValueError("missing columns: " + ", ".join(lacking))
    tags = df.columns[df.columns.index(claim) + 1 :] if claim in df.columns else [c for c in df.columns if c not in ("paper_id", "title", "year", "doi")]
    cell = lambda c: X.text_of(F.col(c)) if c in df.columns else F.lit("")
    first = lambda c: F.trim(F.substring_index(cell(c), ";", 1))
    if fit in df.columns:
        df = df.filter(F.arrays_overlap(X.multi_values(F.col(fit)), F.array(*map(F.lit, EXPORTED_FITS))))
    category = X.first_value(*(first(c) for c in [fit, target, *tags] if c in df.columns), F.lit(""))
    said = F.concat(F.lit("no tag value for paper_id="), cell("paper_id"))
    core = {
        "title": cell("title"),
        "categoric": F.when(category != "", category).otherwise(F.raise_error(said).cast("string")),
        "semantic": X.first_value(F.trim(cell(claim)), F.trim(cell("title"))),
        "paper_id": cell("paper_id"),
        "year": cell("year"),
        "doi": cell("doi"),
    }
    return df.select(*(core[c].alias(c) for c in EXPORT_CORE), *(cell(c).alias(c) for c in tags if c not in EXPORT_CORE))


def canonical(rows: DataFrame, told: Sequence[str] = ()) -> DataFrame:
    """Papers of what ``exported`` gives: the candidate's cells, else those of the screening, and notes.

    ``told`` names cells of the screening that are noted where they aren't empty.
    """
    has = rows.schema["candidate"].dataType.names
    own = lambda c: F.col(f"candidate.{c}").cast("string") if c in has else F.lit("")
    else_own = lambda c: X.first_value(own(c), F.col(c)) if c in rows.columns else X.text_of(own(c))
    always = [(k, own(c)) for k, c in (("provider", "provider"), ("provider_id", "provider_id"), ("source_rank", "rank"), ("retrieval_date", "retrieval_date"))]
    notes = [F.concat(F.lit(f"{k}="), X.text_of(c)) for k, c in always]
    where = [(c, F.col(c).cast("string")) for c in told if c in rows.columns]
    where += [(k, own(c)) for k, c in (("source_query", "query"), ("source_query_reason", "query_reason"), ("dedupe_key", "dedupe_key"))]
    where.append(("duplicate_count", F.nullif(own("duplicate_count"), F.lit("0"))))
    notes += [F.when(X.text_of(c) != "", F.concat(F.lit(f"{k}="), c)) for k, c in where]
    cells = {"paper_id": X.text_of(F.col("paper_id"))} | {c: else_own(c) for c in ("title", "year", "doi")}
    cells |= {c: X.text_of(own(c)) for c in ("abstract", "authors", "venue", "url")}
    cells |= {"source": F.concat(F.lit("collected:"), X.text_of(own("provider"))), "full_text_path": F.lit(""), "notes": F.concat_ws("; ", *notes)}
    return rows.select(*(v.alias(k) for k, v in cells.items()))


def full_text_places(df: DataFrame, urls: Sequence[Column], url: Column) -> DataFrame:
    """``df`` with full_text_url, pdf_url and url from URLs in order of preference.

    They are the first two that differ; without a URL of its own a row takes
    the third, else the last.
    """
    given = F.array(*(F.trim(X.text_of(u)) for u in [*urls, url]))
    found = F.array_distinct(F.filter(given, lambda u: u != ""))
    own = F.trim(X.text_of(url))
    rest = F.coalesce(F.get(found, 2), F.when(F.size(found) > 0, F.element_at(found, -1)), F.lit(""))
    at = lambda n: F.coalesce(F.get(found, n), F.lit(""))
    return df.withColumns({"full_text_url": at(0), "pdf_url": at(1), "url": F.when(own != "", own).otherwise(rest)})
