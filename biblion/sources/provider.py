"""Candidates from a paged scholarly service, as a Python data source.

One partition a query, so queries are fetched in parallel; the service itself
is behind a ``Client``, and a client of recorded pages serves tests.
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Protocol
from urllib.error import HTTPError
from urllib.parse import parse_qsl, urlencode, urlsplit, urlunsplit
from urllib.request import Request, urlopen

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

ATTEMPTS = 6
RETRIED = (500, 502, 503, 504)


class Client(Protocol):
    def page(self, query: str, page: int, per_page: int) -> list[dict]: ...


#: Seconds that a request may take.
TIMEOUT = 60
# The parameters and filters of the service.
FLAGS = {"has_full_text": "has_fulltext:true", "has_pdf_url": "has_pdf_url:true", "has_content_pdf": "has_content.pdf:true", "open_access_only": "open_access.is_oa:true"}
SEARCH_FIELDS = {"title": "title.search", "abstract": "abstract.search"}


def service_filters(plan: dict) -> list[str]:
    """What a plan's ``filters`` ask the service to leave out."""
    asked = plan.get("filters") or {}
    found = []
    for key, name, day in (("year_from", "from_publication_date", "01-01"), ("year_to", "to_publication_date", "12-31")):
        if isinstance(asked.get(key), int):
            found.append(f"{name}:{asked[key]}-{day}")
    if isinstance(asked.get("language"), str) and asked["language"]:
        found.append(f"language:{asked['language']}")
    if isinstance(asked.get("has_abstract"), bool):
        found.append(f"has_abstract:{str(asked['has_abstract']).lower()}")
    found += [FLAGS[k] for k in ("open_access_only", "has_full_text", "has_pdf_url", "has_content_pdf") if asked.get(k) is True]
    if asked.get("exclude_reviews") is True:
        found.append("type:!review")
    elif "review" in (asked.get("publication_types") or []):
        found.append("type:review")
    return found


def block_filters(entry: dict) -> list[str]:
    """A query's blocks as filters of fields, their terms as alternatives."""
    found = []
    for block in entry.get("blocks") or []:
        terms = [str(t or "").replace(",", " ").replace("|", " ").strip() for t in block.get("terms") or []]
        if any(terms):
            found.append(f"{SEARCH_FIELDS.get(block.get('field') or 'title', 'title_and_abstract.search')}:{'|'.join(t for t in terms if t)}")
    return found


@dataclass
class Service:
    """A client of the service itself; the key, if any, comes from an environment variable."""

    endpoint: str
    plan: dict = field(default_factory=dict)
    mail: str = ""
    key_variable: str = ""

    def url(self, query: str, page: int, per_page: int, entry: dict | None = None) -> str:
        blocks = block_filters(entry or {})
        if not query and not blocks:
            raise ValueError("a query needs words or blocks")
        asked = {"page": page, "per-page": per_page}
        if not blocks:
            asked["search"] = query
        if filters := [*service_filters(self.plan), *blocks]:
            asked["filter"] = ",".join(filters)
        if self.mail:
            asked["mailto"] = self.mail
        if key := os.environ.get(self.key_variable, "").strip() if self.key_variable else "":
            asked["api_key"] = key
        return f"{self.endpoint}?{urlencode(asked)}"

    def page(self, query: str, page: int, per_page: int, entry: dict | None = None) -> list[dict]:
        request = Request(self.url(query, page, per_page, entry), headers={"User-Agent": "biblion"})
        try:
            with urlopen(request, timeout=TIMEOUT) as answer:
                found = json.loads(answer.read().decode("utf-8"))
        except HTTPError as e:
            raise ServiceError(e.code) from e
        if not isinstance(found, dict):
            raise ValueError("the service's answer is no object")
        return [x for x in found.get("results") or [] if isinstance(x, dict)]


def redacted(url: str, name: str = "api_key") -> str:
    """A URL that can be shown: without the value of the key."""
    parts = urlsplit(url)
    told = [(k, "REDACTED" if k == name else v) for k, v in parse_qsl(parts.query, keep_blank_values=True)]
    return urlunsplit(parts._replace(query=urlencode(told)))


#: Providers by name: options of a reader to its client.
PROVIDERS: dict[str, Callable[[dict], Client]] = {}


def client_of(options: dict) -> Client:
    """The client that options ask for: a registered provider, recorded pages, or the service at an endpoint."""
    if (name := options.get("provider")) is not None:
        if name not in PROVIDERS:
            raise ValueError(f"no provider {name}; known are " + ", ".join(sorted(PROVIDERS)))
        return PROVIDERS[name](options)
    if options.get("recorded") is not None:
        return Recorded(json.loads(options["recorded"]))
    if options.get("endpoint"):
        return Service(options["endpoint"], json.loads(options.get("plan", "{}")), options.get("mail", ""), options.get("key_variable", ""))
    raise ValueError("no client: give a provider, recorded pages or an endpoint")


class ServiceError(Exception):
    def __init__(self, status: int):
        super().__init__(f"status {status}")
        self.status = status


def patient(call: Callable[[], list[dict]], pause: Callable[[float], None] = time.sleep) -> list[dict]:
    """Tried again after server errors with growing pauses; other errors, 429 too, fail at once."""
    for attempt in range(1, ATTEMPTS + 1):
        try:
            return call()
        except (ServiceError, OSError) as e:
            if attempt == ATTEMPTS or (isinstance(e, ServiceError) and e.status not in RETRIED):
                raise
            pause(attempt)
    raise AssertionError


@dataclass
class Query(InputPartition):
    index: int
    text: str
    start: int = 0


class ProviderReader(DataSourceReader):
    def __init__(self, options: dict):
        self.queries = json.loads(options["queries"])
        self.start = json.loads(options.get("consumed", "{}"))
        self.per_page, self.most = int(options.get("per_page", 100)), int(options.get("most", 1000))
        self.options = options
        self.date = options.get("date", "")
        self.years: dict[str, int] = {}

    def partitions(self) -> list[InputPartition]:
        return [Query(i, q, int(self.start.get(q, 0))) for i, q in enumerate(self.queries)]

    def client(self) -> Client:
        plan = json.loads(self.options.get("plan", "{}"))
        plan["filters"] = {**(plan.get("filters") or {}), **self.years}
        return client_of({**self.options, "plan": json.dumps(plan)})

    def read(self, partition: Query) -> Iterator[tuple]:
        client, rank = self.client(), partition.start
        page = rank // self.per_page + 1
        skip = rank % self.per_page
        while rank < self.most:
            rows = patient(lambda page=page: client.page(partition.text, page, self.per_page))
            for r in rows[skip:][: self.most - rank]:
                rank += 1
                yield (str(r.get("id", "")), r.get("doi"), r.get("display_name"), r.get("publication_year"), partition.text, partition.index, rank, self.date, json.dumps(r))
            if len(rows) < self.per_page:
                return
            page, skip = page + 1, 0


class PushingReader(ProviderReader):
    """Gives bounds of the year to the service; for sessions with spark.sql.python.filterPushdown.enabled."""

    def pushFilters(self, filters) -> Iterator:  # noqa: N802
        """Bounds of the year go to the service; all filters are checked again behind."""
        for f in filters:
            if getattr(f, "attribute", None) == ("year",) and isinstance(getattr(f, "value", None), int):
                kind, year = type(f).__name__, f.value
                if kind in ("GreaterThanOrEqual", "GreaterThan", "EqualTo"):
                    self.years["year_from"] = year + (kind == "GreaterThan")
                if kind in ("LessThanOrEqual", "LessThan", "EqualTo"):
                    self.years["year_to"] = year - (kind == "LessThan")
            yield f


class Recorded:
    def __init__(self, pages: dict[str, list[dict]]):
        self.rows = pages

    def page(self, query: str, page: int, per_page: int) -> list[dict]:
        return self.rows.get(query, [])[(page - 1) * per_page : page * per_page]


class Provider(DataSource):
    @classmethod
    def name(cls) -> str:
        return "scholarly"

    def schema(self) -> str:
        return "provider_id string, doi string, title string, year int, query string, query_index int, query_rank int, retrieval_date string, raw_record string"

    def reader(self, schema) -> DataSourceReader:
        options = dict(self.options)
        return (PushingReader if options.get("pushdown") == "true" else ProviderReader)(options)


def query_text(blocks: list[list[str]]) -> str:
    """``(a OR "b c") AND (…)``."""
    quoted = [[f'"{t}"' if " " in t else t for t in b] for b in blocks]
    return " AND ".join("(" + " OR ".join(b) + ")" for b in quoted if b)
