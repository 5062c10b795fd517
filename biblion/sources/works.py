"""Records of a scholarly service (one VARIANT column each) as cells: abstract, authors, places of full texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from biblion.functions import text as X
from biblion.operators.papers import first_seen

LOCATIONS = "array<struct<source:string,url:string,kind:string,license:string,is_open_access:string>>"


def _text(record: Column, path: str) -> Column:
    return X.text_of(F.try_variant_get(record, path, "string"))


def guessed_kind(url: Column, otherwise: Column) -> Column:
    """A PDF by the end of its path or a part of it; the query aside."""
    path = F.lower(F.substring_index(url, "?", 1))
    return F.when(path.endswith(".pdf") | path.contains("/pdf"), "pdf").otherwise(otherwise)


def _flag(record: Column, path: str, otherwise: Column) -> Column:
    """``true`` or ``false`` of a boolean, empty for anything else; ``otherwise`` where the path is missing."""
    found = F.try_variant_get(record, path, "variant")
    is_flag = F.schema_of_variant(found) == "BOOLEAN"
    return F.when(found.isNull(), otherwise).when(is_flag, F.try_variant_get(found, "$", "string")).otherwise("")


def work_locations(work: Column, provider: str) -> Column:
    """Where a record's full text may be, in order: the open copy, the best, the primary, and all others; the first of each URL.

    Sources are named after the provider.  Only http and https count.
    """
    own = _flag(work, "$.open_access.is_oa", F.lit(""))

    def place(url: Column, source: str, kind: str, licence: Column, flag: Column) -> Column:
        plain = F.trim(X.text_of(url))
        return F.struct(F.lit(f"{provider}_{source}").alias("source"), plain.alias("url"), guessed_kind(plain, F.lit(kind)).alias("kind"), licence.alias("license"), flag.alias("is_open_access"))

    def both(at: Column, source: str) -> Column:
        licence = X.first_value(_text(at, "$.license"), _text(at, "$.license_id"))
        flag = _flag(at, "$.is_oa", own)
        return F.array(place(_text(at, "$.pdf_url"), source, "pdf", licence, flag), place(_text(at, "$.landing_page_url"), source, "landing_page", licence, flag))

    part = lambda name: F.try_variant_get(work, f"$.{name}", "variant")
    listed = F.coalesce(F.try_variant_get(work, "$.locations", "array<variant>"), F.array().cast("array<variant>"))
    found = F.concat(
        F.array(place(_text(work, "$.open_access.oa_url"), "open_access", "landing_page", F.lit(""), own)),
        both(part("best_oa_location"), "best_oa_location"),
        both(part("primary_location"), "primary_location"),
        F.flatten(F.transform(listed, lambda at: both(at, "location"))),
    )
    return first_seen(F.filter(found, lambda x: x["url"].rlike("^https?://")), lambda x: x["url"])


def checked_locations(given: Column) -> Column:
    """Locations that a candidate carries: absolute URLs, named sources, kinds and flags of one spelling."""

    def made(x: Column) -> Column:
        kind, url = F.lower(F.trim(X.text_of(x["kind"]))), F.trim(X.text_of(x["url"]))
        flag = F.lower(F.trim(X.text_of(x["is_open_access"])))
        told = F.when(flag.isin("yes", "true", "1"), "yes").when(flag.isin("no", "false", "0"), "no").otherwise("")
        return F.struct(X.first_value(x["source"], F.lit("provider_metadata")).alias("source"), url.alias("url"), F.when(kind.isin("pdf", "html", "landing_page"), kind).otherwise(guessed_kind(url, F.lit("landing_page"))).alias("kind"), X.text_of(x["license"]).alias("license"), told.alias("is_open_access"))

    return F.filter(F.transform(F.coalesce(given.cast(LOCATIONS), F.array().cast(LOCATIONS)), made), lambda x: x["url"].rlike("^https?://[^/?#]+"))


def candidate_locations(df: DataFrame) -> Column:
    """checked_locations() of ``full_text_locations``, then the URL columns of a candidate; the first of each URL."""
    parts = [checked_locations(F.col("full_text_locations"))] if "full_text_locations" in df.columns else []
    for column, kind in (("full_text_url", "html"), ("pdf_url", "pdf")):
        if column in df.columns:
            one = F.struct(F.lit("candidate_metadata").alias("source"), F.col(column).alias("url"), F.lit(kind).alias("kind"), F.lit("").alias("license"), F.lit("").alias("is_open_access"))
            parts.append(checked_locations(F.array(one)))
    return first_seen(F.concat(*parts), lambda x: x["url"]) if parts else F.array().cast(LOCATIONS)


def work_cells(df: DataFrame, work: str = "work") -> DataFrame:
    """provider_id, doi, title, year, abstract, authors, venue, url, cited_by_count, raw_type of records."""
    w = F.col(work)
    names = F.transform(F.coalesce(F.try_variant_get(w, "$.authorships", "array<variant>"), F.array().cast("array<variant>")), lambda a: _text(a, "$.author.display_name"))
    index = F.try_variant_get(w, "$.abstract_inverted_index", "map<string,array<int>>")
    cells = {
        "provider_id": _text(w, "$.id"),
        "doi": _text(w, "$.doi"),
        "title": X.first_value(_text(w, "$.display_name"), _text(w, "$.title")),
        "year": _text(w, "$.publication_year"),
        "abstract": F.when(index.isNotNull(), X.inverted_index_text(index)).otherwise(""),
        "authors": F.array_join(F.filter(names, lambda n: n != ""), "; "),
        "venue": _text(w, "$.primary_location.source.display_name"),
        "url": X.first_value(_text(w, "$.doi"), _text(w, "$.primary_location.landing_page_url"), _text(w, "$.id")),
        "cited_by_count": F.coalesce(F.try_variant_get(w, "$.cited_by_count", "bigint"), F.lit(0)),
        "raw_type": _text(w, "$.type"),
    }
    return df.select(*(c for c in df.columns if c != work and c not in cells), *(c.alias(n) for n, c in cells.items()), work)
