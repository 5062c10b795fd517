"""Reading and writing tables of records: CSV, JSON lines, JSON objects, dispatch by suffix."""

from __future__ import annotations

import json
import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from biblion.sources import bibliographic, yaml_lines


_CSV = {"header": True, "multiLine": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def read_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None, required: Sequence[str] = (), row_number: str | None = None) -> DataFrame:
    """All strings, quoted line breaks allowed, a missing cell empty.

    The columns are those of the file's header, or ``columns`` of them; a
    required one that the header lacks is an error, and so is a file without a
    header.  ``row_number`` names a column for the number of the row, from 1
    (of one file, which a single task reads since records may span lines).
    """
    header = csv_header(spark, path)
    if not header:
        raise ValueError("the file has no header")
    lacking = [c for c in [*required, *(columns or [])] if c not in header]
    if lacking:
        raise ValueError("missing columns: " + ", ".join(dict.fromkeys(lacking)))
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
    rows = spark.read.schema(schema).options(**_CSV, enforceSchema=False).csv(path).na.fill("")
    if row_number is not None:
        # ids of one partition are consecutive
        rows = rows.withColumn(row_number, F.monotonically_increasing_id() + 1)
    return rows.select(*(columns or header), *([row_number] if row_number else []))


def csv_header(spark: SparkSession, path: str) -> list[str]:
    return spark.read.options(**_CSV).csv(path).columns


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Blank lines are skipped; a line that is no object is an error.  Without a schema: one VARIANT column ``record``."""
    if schema is not None:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    lines = spark.read.text(path).filter(F.trim("value") != "")
    parsed = F.try_parse_json(F.col("value"))
    good = F.coalesce(F.schema_of_variant(parsed).startswith("OBJECT"), F.lit(False))
    return lines.select(F.when(good, parsed).otherwise(F.parse_json(F.raise_error(F.concat(F.lit("no JSON object: "), F.substr("value", F.lit(1), F.lit(80)))).cast("string"))).alias("record"))


def read_object(path: str) -> dict:
    """A small configuration: JSON, or YAML in the forms that yaml_lines knows."""
    with open(path, encoding="utf-8") as f:
        if path.endswith((".yaml", ".yml")):
            found = yaml_lines.parsed(f.read())
        else:
            found = json.load(f)
    if not isinstance(found, dict):
        raise ValueError(f"{path} holds no object")
    return found


def read_environment(path: str) -> None:
    """KEY=VALUE lines; what is set already stays."""
    if not os.path.exists(path):
        return
    with open(path, encoding="utf-8") as f:
        for line in map(str.strip, f):
            if line and not line.startswith("#") and "=" in line:
                key, value = line.split("=", 1)
                os.environ.setdefault(key.strip(), value.strip().strip("\"'"))


def read_papers(spark: SparkSession, path: str) -> DataFrame:
    """Papers from CSV, JSON, JSON lines, BibTeX or RIS, by suffix."""
    suffix = path.rsplit(".", 1)[-1].lower()
    if suffix == "csv":
        return read_csv(spark, path)
    readers = {"bib": bibliographic.read_bibtex, "bibtex": bibliographic.read_bibtex, "ris": bibliographic.read_ris, "json": bibliographic.read_json, "jsonl": bibliographic.read_json}
    if suffix not in readers:
        raise ValueError(f"unknown format: {suffix}")
    return readers[suffix](spark, path)


def write_csv(df: DataFrame, path: str, columns: Sequence[str] | None = None, order: Sequence[str] = ()) -> None:
    """One file with a header, also for no rows; missing columns and nulls are empty.

    Without ``columns`` the header is open: the columns of the table.  One task
    writes, as one file is asked for; it streams, so its memory is bounded.
    """
    rows = df.orderBy(*order) if order else df
    rows = rows.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in df.columns else F.lit("").alias(c) for c in columns or df.columns))
    options = {"header": True, "quote": '"', "escape": '"', "emptyValue": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    rows.coalesce(1).write.mode("overwrite").options(**options).csv(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_object(value: dict, path: str) -> None:
    """JSON, or YAML by its suffix; keys in their order."""
    if path.endswith((".yaml", ".yml")):
        text = "".join(_yaml(value, 0))
    else:
        text = json.dumps(value, indent=2, ensure_ascii=False) + "\n"
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def _yaml(value, depth: int):
    """Lines of block style; scalars as JSON, which YAML reads as well."""
    pad = "  " * depth
    if not value:
        yield f"{pad}{json.dumps(value)}\n"
    for key, x in value.items() if isinstance(value, dict) else ((None, x) for x in value):
        head = pad + ("-" if key is None else json.dumps(str(key), ensure_ascii=False) + ":")
        if isinstance(x, dict | list) and x:
            yield head + "\n"
            yield from _yaml(x, depth + 1)
        else:
            yield f"{head} {json.dumps(x, ensure_ascii=False)}\n"
