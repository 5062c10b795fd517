"""Whether full texts can be had: screening rows, candidates, earlier answers, and checks of locations.

Locations are checked position by position: the next one of a row only if none
before it answers.  Within a position every distinct URL is checked once, in
parallel, and not at all if a position before has its answer.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from http.client import HTTPException
from urllib.parse import quote, urlsplit, urlunsplit
from urllib.request import Request as HttpRequest
from urllib.request import urlopen

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from biblion.operators.papers import join_key, last_of
from biblion.operators.state import held

REUSABLE = ["verified", "provider_claim_only", "not_available", "unverified", "candidate_missing"]
KEYS = ["key_doi", "key_id"]
LOCATIONS = "array<struct<source:string,url:string,kind:string,license:string,is_open_access:string>>"
ANSWER = "full_text_availability_status", "full_text_availability_source", "full_text_url", "full_text_url_kind", "full_text_url_content_type", "full_text_license", "full_text_is_open_access", "full_text_availability_error"

#: (method, url) -> status, content type, final URL; an exception is an error of that method.
Request = Callable[[str, str], tuple[int, str, str]]


#: Seconds that a request may take, and bytes that a GET asks for.
TIMEOUT, FIRST_BYTES = 5.0, 2048


def http_request(timeout: float = TIMEOUT) -> Callable[[], Request]:
    """Requests over the network: a HEAD, or a GET of the first 2 KB."""

    def made() -> Request:
        def ask(method: str, url: str) -> tuple[int, str, str]:
            parts = urlsplit(url)
            safe = urlunsplit((parts.scheme, parts.netloc, quote(parts.path, safe="/%:@!$&'()*+,;="), quote(parts.query, safe="=&%/:;+?,@!$'()*"), parts.fragment))
            headers = {"User-Agent": "biblion"} | ({"Range": f"bytes=0-{FIRST_BYTES - 1}"} if method == "GET" else {})
            with urlopen(HttpRequest(safe, headers=headers, method=method), timeout=timeout) as answer:
                if method == "GET":
                    answer.read(FIRST_BYTES)
                return answer.status, answer.headers.get("Content-Type", ""), answer.geturl()

        return ask

    return made


def url_check(request: Callable[[], Request]) -> Callable[[DataFrame], DataFrame]:
    """A check of a table of URLs: HEAD, then GET; a status from 200 to 399 is a success."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ask = request()
        for batch in batches:
            rows = []
            for url in batch["url"]:
                wrong = []
                for method in ("HEAD", "GET"):
                    try:
                        status, kind, final = ask(method, url)
                    except (OSError, ValueError, HTTPException) as error:
                        wrong.append(f"{method}: {type(error).__name__}: {error}")
                        continue
                    if 200 <= status < 400:
                        rows.append((url, True, kind or "", final or url, ""))
                        break
                    wrong.append(f"{method}: HTTP {status}")
                else:
                    rows.append((url, False, "", url, " | ".join(wrong)))
            yield pd.DataFrame(rows, columns=["url", "ok", "content_type", "final_url", "error"])

    return lambda urls: urls.mapInPandas(run, "url string, ok boolean, content_type string, final_url string, error string")


def check_counts(asked: DataFrame, told: DataFrame) -> DataFrame:
    """locations, tried, checked, reused, spared: what was asked for, tried, checked once, answered from memory, and never needed."""
    n = asked.count()
    one = told.agg(F.count("*").alias("tried"), F.countDistinct("url").alias("checked"))
    return one.select(F.lit(n).cast("long").alias("locations"), "tried", "checked", (F.col("tried") - F.col("checked")).alias("reused"), (F.lit(n) - F.col("tried")).alias("spared"))


def answered(asked: DataFrame, row: str, check: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``asked`` (row, _at, url) with the answers of those locations that were tried, and ``checked``.

    One round for each position; rows that have an answer take no part in the next.
    """
    known = told = None
    places = [r._at for r in asked.select("_at").distinct().orderBy("_at").collect()]  # as many as a row has locations
    for at in places:
        now = asked.filter(F.col("_at") == at)
        if told is not None:
            now = now.join(told.filter("ok").select(row).distinct(), row, "left_anti")
        urls = now.select("url").distinct()
        new = held(check(urls if known is None else urls.join(known.select("url"), "url", "left_anti")))
        known = new if known is None else known.unionByName(new)
        now = now.join(known, "url", "left")
        told = held(now if told is None else told.unionByName(now))
    return told if told is not None else asked.join(check(asked.select("url").distinct()), "url", "left")


def verified(candidates: DataFrame, screening: DataFrame, ordinal: str, check: Callable[[DataFrame], DataFrame], existing: DataFrame | None = None) -> DataFrame:
    """One row of availability for each screening row.

    An earlier answer that can be used again is kept; excluded rows are skipped;
    rows without a candidate are told so; of the others the locations
    (``full_text_locations`` of the candidate) are checked, and the first that
    answers, in their order, counts.
    """
    rows = screening.select(ordinal, "paper_id", "doi", "provider_id", "screening_decision", *join_key(F.col("doi"), F.col("provider_id")))
    known = last_of(candidates.select("*", *join_key(F.col("doi"), F.col("provider_id"))), KEYS, ordinal)
    rows = rows.join(known.select(*KEYS, F.col("full_text_locations").cast(LOCATIONS).alias("_locations"), F.lit(True).alias("_found")), KEYS, "left")
    nothing = [F.lit("").alias(c) for c in ANSWER[1:]]
    if existing is not None:
        old = existing.filter(F.col(ANSWER[0]).isin(REUSABLE)).select(ordinal, *ANSWER, *join_key(F.col("doi"), F.col("provider_id")))
        rows = rows.join(last_of(old, KEYS, ordinal).select(*KEYS, F.struct(*ANSWER).alias("_old")), KEYS, "left")
    else:
        rows = rows.withColumn("_old", F.lit(None).cast("struct<" + ",".join(f"{c}:string" for c in ANSWER) + ">"))
    state = F.when(F.col("_old").isNotNull(), "reused").when(F.col("screening_decision") == "exclude", "skipped").when(F.col("_found").isNull(), "missing").otherwise("asked")
    rows = rows.withColumn("_state", state)

    asked = rows.filter("_state = 'asked'").select(ordinal, F.posexplode("_locations").alias("_at", "_l")).filter("coalesce(trim(_l.url), '') <> ''")
    asked = held(asked.withColumn("url", F.col("_l.url")))
    told = answered(asked, ordinal, check)
    # the first that answers; else the first of all, with the last error
    good = F.coalesce(F.col("ok"), F.lit(False))
    best = F.min(F.struct((~good).alias("bad"), F.col("_at").alias("at"), F.col("_l").alias("l"), F.col("content_type").alias("content_type"), F.col("final_url").alias("final")))
    error = F.max(F.when(F.coalesce(F.col("error"), F.lit("")) != "", F.struct(F.col("_at").alias("at"), F.col("error").alias("e"))))
    told = told.groupBy(ordinal).agg(best.alias("b"), error["e"].alias("e"))
    status = F.when(~F.col("b.bad"), "verified").when(F.col("e").isNull(), "provider_claim_only").otherwise("unverified")
    ok = ~F.col("b.bad")
    answer = [status, F.col("b.l.source"), F.when(ok, F.col("b.final")).otherwise(F.col("b.l.url")), F.col("b.l.kind"), F.when(ok, F.col("b.content_type")), F.col("b.l.license"), F.col("b.l.is_open_access"), F.when(~ok, F.col("e"))]
    told = told.select(ordinal, F.struct(*(F.coalesce(x, F.lit("")).alias(c) for x, c in zip(answer, ANSWER, strict=True))).alias("_new"))

    def plain(said: str, error: str = ""):
        return F.struct(F.lit(said).alias(ANSWER[0]), *nothing[:-1], F.lit(error).alias(ANSWER[-1]))

    rows = rows.join(told, ordinal, "left")
    final = F.when(F.col("_state") == "reused", F.col("_old")).when(F.col("_state") == "skipped", plain("skipped_not_included")).when(F.col("_state") == "missing", plain("candidate_missing", "no candidate matches the screening row"))
    final = final.otherwise(F.coalesce("_new", plain("not_available")))
    return rows.select(ordinal, "paper_id", "doi", "provider_id", "screening_decision", final.alias("a")).select(ordinal, "paper_id", "doi", "provider_id", "screening_decision", "a.*")
