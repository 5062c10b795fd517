"""BibTeX, RIS and JSON records: whole files in, one row an entry out.

Files are parsed in Arrow-fed Python functions, a file a row; the formats nest
and continue over lines, which no built-in reader follows.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "paper_id string, title string, year string, doi string, abstract string, authors string, venue string, url string, source string, full_text_path string, notes string"
COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]
# Names under which the formats carry a field, best first.
CONTAINERS = ["papers", "items", "results", "records", "data", "publications"]
JSON_KEYS = {
    "paper_id": ["paper_id", "id", "key", "citation_key"],
    "title": ["title", "display_name", "name"],
    "year": ["year", "publication_year", "published_year", "date"],
    "doi": ["doi", "DOI"],
    "abstract": ["abstract", "abstractNote", "summary"],
    "authors": ["authors", "author", "creators"],
    "venue": ["venue", "journal", "container-title", "publicationTitle"],
    "url": ["url", "URL", "link"],
    "full_text_path": ["full_text_path", "pdf_path"],
    "notes": ["notes", "note"],
}
RIS_TAGS = {"title": ["TI", "T1"], "year": ["PY", "Y1", "DA"], "doi": ["DO"], "abstract": ["AB", "N2"], "venue": ["JO", "JF", "T2", "JA"], "url": ["UR"], "full_text_path": ["L1"], "notes": ["N1"], "paper_id": ["ID"]}


def plain(value: str) -> str:
    return " ".join(value.split())


def year(value: str) -> str:
    found = re.search(r"\d{4}", value)
    return found[0] if found else ""


def doi(value: str) -> str:
    for part in ("https://doi.org/", "http://doi.org/", "doi:"):
        value = value.replace(part, "")
    return value.strip()


def slug(value: str) -> str:
    return "_".join(re.findall("[a-z0-9]+", value.lower()))


class Ids:
    """Ids in order: a repeated one gets _2, _3 and so on, past those already there."""

    def __init__(self) -> None:
        self.taken: set[str] = set()

    def of(self, wanted: str) -> str:
        found, n = wanted, 1
        while found in self.taken:
            n += 1
            found = f"{wanted}_{n}"
        self.taken.add(found)
        return found


_HEAD = re.compile(r"@\s*([A-Za-z]+)\s*([{(])")
_NAME = re.compile(r"[\s,]*(?:[^\sA-Za-z0-9_,-][\s,]*)*([\w-]+)\s*(=?)\s*", re.ASCII)
# a backslash takes the next character with it; in quotes neither brackets nor commas count
_TOKEN = re.compile(r'\\.?|"(?:[^"\\]|\\.)*"|[{}(),]', re.S)


def bibtex_entries(text: str) -> Iterator[tuple[str, str, dict[str, str]]]:
    """(kind, key, fields) of each entry; comments, preambles and strings are passed over, what isn't an entry is an error."""
    at = 0
    while (at := text.find("@", at)) >= 0:
        head = _HEAD.match(text, at)
        if not head:
            raise ValueError("no BibTeX entry: " + text[at : at + 60])
        end = _close(text, head.end() - 1)
        body, at = text[head.end() : end], end + 1
        if head[1].lower() not in ("comment", "preamble", "string"):
            key, rest = _key(body)
            yield head[1].lower(), key, dict(_fields(rest))


def _close(text: str, at: int) -> int:
    """The place of the partner of the bracket at ``at``."""
    opened, closed = text[at], {"{": "}", "(": ")"}[text[at]]
    depth = 0
    for token in _TOKEN.finditer(text, at):
        depth += (token[0] == opened) - (token[0] == closed)
        if depth == 0 and token[0] == closed:
            return token.start()
    raise ValueError("a BibTeX entry isn't closed: " + text[at : at + 60])


def _key(body: str) -> tuple[str, str]:
    """What stands before the first comma outside of brackets, and what behind."""
    depth = 0
    for token in _TOKEN.finditer(body):
        depth += (token[0] in "{(") - (token[0] in "})")
        if token[0] == "," and depth == 0:
            return body[: token.start()].strip(), body[token.end() :]
    return body.strip(), ""


def _fields(body: str) -> Iterator[tuple[str, str]]:
    at = 0
    while found := _NAME.match(body, at):
        if not found[2]:
            raise ValueError(f"no value for the BibTeX field {found[1]}")
        at, parts = found.end(), []
        while at < len(body) and body[at] != ",":
            if body[at] == "{":
                end = _close(body, at)
                value, at = body[at + 1 : end], end + 1
            elif body[at] == '"':
                quoted = re.compile(r'"((?:[^"\\]|\\.)*)"', re.S).match(body, at)
                if not quoted:
                    raise ValueError(f"the quotes of the BibTeX field {found[1]} aren't closed")
                value, at = quoted[1], quoted.end()
            else:
                bare = re.compile("[^,#]*").match(body, at)
                value, at = bare[0].strip(), bare.end()
            parts.append(value)
            more = re.compile(r"\s*#\s*").match(body, at)
            if not more:
                break
            at = more.end()
        yield found[1].lower(), untexed("".join(parts))
        at = at + len(body[at:].partition(",")[0])


# What stands for what in LaTeX text, replaced in this order.
LATEX_TEXT = {r"\&": "&", r"\%": "%", r"\_": "_", r"\#": "#", r"\$": "$", r"\{": "{", r"\}": "}", "~": " ", r"\textendash": "-", r"\textemdash": "-", "--": "-"}


def untexed(value: str) -> str:
    for old, new in LATEX_TEXT.items():
        value = value.replace(old, new)
    return plain(re.sub("[{}]", "", re.sub(r"\\[A-Za-z]+\s*", "", value)))


def pdf_path(value: str) -> str:
    """The first path of a ``file`` field (parts by colons, files by semicolons) that ends in .pdf."""
    return next((x for x in re.split(r"[:;]", value) if x.strip().lower().endswith(".pdf")), "").strip()


def own_id(value: str) -> str:
    """An id as it stands, in lower case: letters, digits, hyphens and underscores stay, all else becomes one underscore."""
    return re.sub("[^A-Za-z0-9_-]+", "_", value).strip("_").lower()


def bibtex_rows(text: str) -> list[dict[str, str]]:
    ids, out = Ids(), []
    for n, (kind, key, f) in enumerate(bibtex_entries(text), 1):
        first = lambda *names: next((f[x] for x in names if f.get(x)), "")  # noqa: B023, E731
        row = {"title": f.get("title", ""), "year": first("year", "date"), "doi": doi(f.get("doi", "")), "abstract": f.get("abstract", "")}
        row["authors"] = "; ".join(plain(x) for x in re.split(r"\s+and\s+", f.get("author", "")) if x.strip())
        row["venue"] = first("journal", "journaltitle", "booktitle", "conference", "proceedings", "publisher")
        row |= {"url": first("url", "link"), "source": f"bibtex:{kind}", "full_text_path": pdf_path(f.get("file", "")), "notes": f"bibtex_key={key}" if key else ""}
        out.append({"paper_id": ids.of(own_id(key) or f"bibtex_{n:04d}"), **row})
    return out


def _made(row: dict[str, str]) -> str:
    return "_".join(x for x in ["_".join(re.findall("[a-z0-9]+", row["title"].lower())[:6]), row["year"]] if x)


def ris_records(text: str) -> Iterator[dict[str, list[str]]]:
    """Tags of each record, which ends at ER, at the next TY or with the file; a line without a tag goes on with the last."""
    record: dict[str, list[str]] = {}
    last = ""
    for line in filter(None, map(str.strip, text.splitlines())):
        found = re.match(r"([A-Z0-9]{2})\s*-\s*(.*)$", line)
        if not found:
            if last in record:
                record[last][-1] = plain(f"{record[last][-1]} {line}")
            continue
        tag, value = found[1], found[2].strip()
        if tag in ("TY", "ER"):
            if record:
                yield record
            record = {}
        if tag == "ER":
            last = ""
        else:
            record.setdefault(tag, []).append(value)
            last = tag
    if record:
        yield record


def ris_rows(text: str) -> list[dict[str, str]]:
    ids, out = Ids(), []
    for r in ris_records(text):
        row = {c: plain(next((v for t in tags for v in r.get(t, []) if plain(v)), "")) for c, tags in RIS_TAGS.items()}
        row |= {"year": year(row["year"]), "doi": doi(row["doi"]), "authors": "; ".join(plain(a) for t in ("AU", "A1") for a in r.get(t, [])), "source": "ris"}
        words = re.findall("[a-z0-9]+", row["title"].lower())[:6]
        row["paper_id"] = ids.of(own_id(row["doi"]) or "_".join(words) or f"ris_{len(out) + 1:04d}")
        out.append(row)
    return out


def _authors(value) -> str:
    if isinstance(value, str):
        return "; ".join(plain(a) for a in re.split(r"\s+and\s+|;", value) if a.strip())
    names = []
    for a in value if isinstance(value, list) else []:
        if isinstance(a, dict):
            whole = a.get("name") or a.get("display_name") or a.get("literal")
            names.append(str(whole) if whole else " ".join(str(a[k]) for k in ("given", "firstName", "family", "lastName") if a.get(k)))
        else:
            names.append(str(a))
    return "; ".join(plain(n) for n in names if n.strip())


def json_rows(text: str, lines: bool) -> list[dict[str, str]]:
    """An array, one object, the first container that is a list, or an object a line."""
    if lines:
        records = [json.loads(x) for x in text.splitlines() if x.strip()]
    else:
        found = json.loads(text)
        if isinstance(found, dict):
            found = next((found[c] for c in CONTAINERS if isinstance(found.get(c), list)), [found])
        records = found
    if not all(isinstance(r, dict) for r in records):
        raise ValueError("a JSON record is no object")
    ids, out = Ids(), []
    for r in records:
        raw = {c: next((r[k] for k in keys if r.get(k) not in (None, "", [])), "") for c, keys in JSON_KEYS.items()}
        row = {c: plain(str(v[0] if isinstance(v, list) and v else v)) for c, v in raw.items() if c != "authors"}
        row |= {"authors": _authors(raw["authors"]), "year": year(row["year"]), "doi": doi(row["doi"]), "source": plain(str(r.get("source") or "json"))}
        row["paper_id"] = ids.of(slug(row["paper_id"]) if row["paper_id"] else _made(row))
        out.append(row)
    return out


def _read(spark: SparkSession, path: str, parse) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, text in zip(batch["path"], batch["value"], strict=True):
                yield pd.DataFrame(parse(name, text), columns=COLUMNS).astype(str)

    files = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), "value")
    return files.mapInPandas(run, SCHEMA)


def read_bibtex(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, lambda name, text: bibtex_rows(text))


def read_ris(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, lambda name, text: ris_rows(text))


def read_json(spark: SparkSession, path: str) -> DataFrame:
    lines = path.lower().endswith("l")
    return _read(spark, path, lambda name, text: json_rows(text, lines))
