"""Audits of tags and of review labels, and their statistics."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from biblion.functions import text as X

# Fixed values of the rules below.
LEAST_ROWS_FOR_DISTRIBUTION = 5
DOMINANT = 0.9
LEAST_ROWS_FOR_MISSINGNESS = 2
MUCH_MISSING = 0.5


@dataclass(frozen=True)
class Category:
    """A tag column: what it may hold, and when it applies."""

    category_id: str
    allowed: Sequence[str]
    selection: str = "multi"
    required: bool = False
    parent: str | None = None
    triggers: Sequence[str] = field(default_factory=tuple)
    rule_parent: bool = True  # whether the rule itself, not the category only, has the dependency


def applies(category: Category, row_audit: bool = False) -> Column:
    """Whether the parent column meets the triggers; a row audit knows the rule's dependency only."""
    if category.parent is None or (row_audit and not category.rule_parent):
        return F.lit(True)
    return F.arrays_overlap(X.multi_values(F.col(category.parent)), F.array(*map(F.lit, category.triggers)).cast("array<string>"))


def _issue(value: Column, issue: str) -> Column:
    return F.array(F.struct(value.cast("string").alias("value"), F.lit(issue).alias("issue")))


_NONE = "array<struct<value:string,issue:string>>"


def _row_issues(c: Category) -> Column:
    """array<struct<field, value, issue>> of one category."""
    values = X.multi_values(F.col(c.category_id))
    joined, n = F.array_join(values, "; "), F.size(values)
    none = F.array().cast(_NONE)
    invalid = F.transform(F.filter(values, lambda v: ~v.isin(list(c.allowed))), lambda v: F.struct(v.alias("value"), F.lit("invalid_value").alias("issue")))
    fine = F.concat(
        F.when(F.lit(c.required) & (n == 0), _issue(F.lit(""), "required_missing")).otherwise(none),
        invalid,
        F.when(F.lit(c.selection == "single") & (n > 1), _issue(joined, "single_selection_has_multiple_values")).otherwise(none),
    )
    off = F.when(n > 0, _issue(joined, "inapplicable_category_has_value")).otherwise(none)
    found = F.when(applies(c, row_audit=True), fine).otherwise(off)
    return F.transform(found, lambda i: F.struct(F.lit(c.category_id).alias("field"), i["value"].alias("value"), i["issue"].alias("issue")))


def row_issues(df: DataFrame, key: str, categories: Sequence[Category]) -> DataFrame:
    """key, field, value, issue: what is wrong with each row's tags."""
    parts = [_row_issues(c) for c in categories]
    return df.select(key, F.explode(F.concat(*parts)).alias("i")).select(key, "i.*")


def distribution_issues(df: DataFrame, categories: Sequence[Category]) -> DataFrame:
    """field, value, issue, count, applicable_rows: allowed values never used, and values that dominate.

    All categories are counted in one aggregation over (category, value).
    """
    checked = [c for c in categories if len(c.allowed) >= 2]
    arrays = [F.when(applies(c), F.struct(F.lit(c.category_id).alias("field"), X.multi_values(F.col(c.category_id)).alias("values"))) for c in checked]
    rows = df.select(F.explode(F.array_compact(F.array(*arrays))).alias("c")).select("c.*")
    # a row's own place, as null, counts the rows; its values count beside it
    marked = rows.select("field", F.explode(F.concat(F.array(F.lit(None).cast("string")), "values")).alias("value"))
    counts = marked.groupBy("field", "value").agg(F.count("*").alias("count"))
    spark = df.sparkSession
    allowed = spark.createDataFrame([(c.category_id, v) for c in checked for v in c.allowed], "field string, value string")
    totals = counts.filter("value IS NULL").select("field", F.col("count").alias("applicable_rows")).filter(F.col("applicable_rows") >= LEAST_ROWS_FOR_DISTRIBUTION)
    used = counts.filter("value IS NOT NULL")
    unused = allowed.join(used, ["field", "value"], "left_anti").select("field", "value", F.lit("unused_value_distribution_warning").alias("issue"), F.lit(0).cast("long").alias("count"))
    strong = used.select("field", "value", F.lit("dominant_value_distribution_warning").alias("issue"), "count")
    both = unused.unionByName(strong).join(totals, "field")
    return both.filter((F.col("count") == 0) | (F.col("count") / F.col("applicable_rows") >= DOMINANT))


def without_fallback(values: Column, fallback: str) -> Column:
    """The fallback goes if a concrete value remains."""
    concrete = F.filter(values, lambda v: v != fallback)
    return F.when(F.size(concrete) > 0, concrete).otherwise(values)


def validated_tags(category: Category, values: Column, fallback: str | None) -> Column:
    """The tags of one category as they are stored; a value that isn't allowed is an error."""
    bad = F.filter(values, lambda v: ~v.isin(list(category.allowed)))
    kept = without_fallback(values, fallback) if fallback is not None else values
    if category.selection == "single":
        kept = F.slice(kept, 1, 1)
    if category.required:
        lack = F.array(F.lit(fallback)) if fallback is not None else F.raise_error(F.lit(f"required category {category.category_id} is empty")).cast("array<string>")
        kept = F.when(F.size(kept) == 0, lack).otherwise(kept)
    checked = F.when(F.size(bad) > 0, F.raise_error(F.concat(F.lit(f"{category.category_id}: not allowed: "), F.array_join(bad, ", "))).cast("array<string>")).otherwise(kept)
    return F.when(applies(category), checked).otherwise(F.array().cast("array<string>"))


@dataclass(frozen=True)
class Label:
    """A review label: its mode, and what approved reviews map, drop and allow."""

    label_id: str
    mode: str = "controlled_auto"  # controlled_fixed, controlled_auto, free_text, evidence_quote
    allowed: Sequence[str] = ()
    mappings: dict[str, str] = field(default_factory=dict)
    dropped: Sequence[str] = ()
    selection: str = "multi"
    required: bool = False

    @property
    def controlled(self) -> bool:
        return self.mode.startswith("controlled")


def cleaned_values(c: Column, label: Label) -> Column:
    """Slugs, mapped, without the dropped and the not allowed, unique."""
    values = X.label_values(c)
    if label.mappings:
        table = F.create_map(*(F.lit(x) for pair in label.mappings.items() for x in pair))
        values = F.transform(values, lambda v: F.coalesce(F.try_element_at(table, v), v))
    if label.dropped:
        values = F.filter(values, lambda v: ~v.isin(list(label.dropped)))
    if label.allowed:
        values = F.filter(values, lambda v: v.isin(list(label.allowed)))
    return F.array_distinct(values)


def _told_values(label: Label) -> Column:
    """array<struct<label_id, value, status>> of one label's cell."""

    def told(v: Column) -> Column:
        good = v.isin(list(label.allowed)) if label.mode == "controlled_fixed" and label.allowed else F.lit(True)
        out = X.canonical_value(v) if label.mode == "controlled_auto" else v
        return F.struct(F.lit(label.label_id).alias("label_id"), F.when(good, out).otherwise(v).alias("value"), F.when(good, "valid").otherwise("invalid").alias("status"))

    return F.transform(X.label_values(F.col(label.label_id)), told)


def value_counts(df: DataFrame, labels: Sequence[Label]) -> DataFrame:
    """label_id, value, paper_count, status; fixed labels count what they allow, from 0.

    Two source values that become one value in one paper count twice.
    """
    parts = [_told_values(x) for x in labels]
    counts = df.select(F.explode(F.concat(*parts)).alias("v")).select("v.*").groupBy("label_id", "value", "status").agg(F.count("*").alias("paper_count"))
    fixed = [(x.label_id, v, "valid") for x in labels if x.mode == "controlled_fixed" for v in x.allowed]
    if not fixed:
        return counts
    known = df.sparkSession.createDataFrame(fixed, "label_id string, value string, status string")
    return counts.join(known, ["label_id", "value", "status"], "full").withColumn("paper_count", F.coalesce("paper_count", F.lit(0)))


def _spelled(x: Label):
    """A spelling with its slug and value; null where that isn't allowed."""

    def told(v: Column) -> Column:
        source = X.slug(v)
        good = source.isin(list(x.allowed)) if x.mode == "controlled_fixed" and x.allowed else F.lit(True)
        value = X.canonical_value(source) if x.mode == "controlled_auto" else source
        return F.when(good, F.struct(F.lit(x.label_id).alias("label_id"), value.alias("value"), source.alias("source"), v.alias("form")))

    return told


def _placed(values: Column, name: str, of: str) -> Column:
    """array<struct<name, value, i>>: values with their place."""
    return F.transform(values, lambda v, i: F.struct(F.lit(of).alias(name), v.alias("value"), i.alias("i")))


def surface_counts(df: DataFrame, labels: Sequence[Label]) -> DataFrame:
    """label_id, value, source, form, count: the spellings of each valid value, and the slugs that it was made of."""
    parts = []
    for x in labels:
        cell = F.col(x.label_id)
        raw = F.filter(F.transform(F.split(X.text_of(cell), ";"), lambda v: F.trim(v)), lambda v: X.slug(v) != "")

        parts.append(F.array_compact(F.transform(raw, _spelled(x))))
    rows = df.select(F.explode(F.concat(*parts)).alias("v")).select("v.*")
    return rows.groupBy("label_id", "value", "source", "form").agg(F.count("*").alias("count"))


def label_summary(df: DataFrame, labels: Sequence[Label]) -> DataFrame:
    """label_id, total_rows, empty_count, non_empty_count, valid_values, invalid_values of each label, in one pass and one join."""
    one = df.agg(F.count("*").alias("total_rows"), *(F.count_if(F.size(X.label_values(F.col(x.label_id))) == 0).alias(f"e{k}") for k, x in enumerate(labels)))
    rows = one.select("total_rows", F.explode(F.array(*(F.struct(F.lit(x.label_id).alias("label_id"), F.col(f"e{k}").alias("empty_count")) for k, x in enumerate(labels)))).alias("r"))
    counts = value_counts(df, labels).groupBy("label_id").agg(F.count_if(F.col("status") == "valid").alias("valid_values"), F.count_if(F.col("status") == "invalid").alias("invalid_values"))
    rows = rows.select("r.label_id", "total_rows", "r.empty_count", (F.col("total_rows") - F.col("r.empty_count")).alias("non_empty_count"))
    zero = {c: F.coalesce(c, F.lit(0).cast("long")) for c in ("valid_values", "invalid_values")}
    return rows.join(counts, "label_id", "left").withColumns(zero)


def value_distribution(df: DataFrame, labels: Sequence[Label], ordinal: str, names: dict[str, dict[str, str]] | None = None) -> DataFrame:
    """label_id, place, value, label, paper_count: cleaned values by count, ties by the row and place that they first stand at."""
    parts = [_placed(cleaned_values(F.col(x.label_id), x), "label_id", x.label_id) for x in labels if x.controlled]
    rows = df.select(ordinal, F.explode(F.concat(*parts)).alias("v")).select(ordinal, "v.*")
    counts = rows.groupBy("label_id", "value").agg(F.count("*").alias("paper_count"), F.min(F.struct(F.col(ordinal), "i")).alias("first"))
    # one row a value goes through the window
    place = F.row_number().over(Window.partitionBy("label_id").orderBy(F.desc("paper_count"), "first"))
    told = counts.select("label_id", place.alias("place"), "value", "paper_count")
    return with_value_labels(told, names or {})


def with_value_labels(df: DataFrame, names: dict[str, dict[str, str]]) -> DataFrame:
    """``df`` (label_id, value) and ``label``: the name of each code, else the code itself."""
    table = [(k, code, name or code) for k, codes in names.items() for code, name in codes.items() if code.strip()]
    known = df.sparkSession.createDataFrame(table, "label_id string, value string, label string")
    return df.join(known, ["label_id", "value"], "left").withColumn("label", F.coalesce("label", "value"))


def tag_summary(df: DataFrame, columns: Sequence[str], ordinal: str) -> DataFrame:
    """field, place, value, count: the values of tag columns as they stand, most common first, ties by first place."""
    parts = [_placed(X.multi_values(F.col(c)), "field", c) for c in columns]
    rows = df.select(ordinal, F.explode(F.concat(*parts)).alias("v")).select(ordinal, "v.*")
    counts = rows.groupBy("field", "value").agg(F.count("*").alias("count"), F.min(F.struct(F.col(ordinal), "i")).alias("first"))
    return counts.withColumn("place", F.row_number().over(Window.partitionBy("field").orderBy(F.desc("count"), "first"))).select("field", "place", "value", "count")


def step_counts(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """name, rows of a step: all of them, and those of each value of a column, in one pass."""
    one = df.agg(F.count("*").alias("n"), *(F.count_if(F.col(column) == v).alias(f"n{k}") for k, v in enumerate(values)))
    told = [F.struct(F.lit("all").alias("name"), F.col("n").alias("rows")), *(F.struct(F.lit(v).alias("name"), F.col(f"n{k}").alias("rows")) for k, v in enumerate(values))]
    return one.select(F.explode(F.array(*told)).alias("r")).select("r.*")


def useful(c: Column) -> Column:
    plain = X.clean_whitespace(c)
    return ~plain.isin("", "[]") & (F.lower(plain) != "unclear")


def coverage(df: DataFrame, labels: Sequence[Label]) -> DataFrame:
    """label_id, papers_with_usable_value, total, ratio (4 digits), in one pass."""
    tests = {x.label_id: F.size(cleaned_values(F.col(x.label_id), x)) > 0 if x.controlled else useful(F.col(x.label_id)) for x in labels}
    one = df.agg(F.count("*").alias("total"), *(F.count_if(t).alias(f"n{i}") for i, t in enumerate(tests.values())))
    rows = one.select("total", F.explode(F.array(*(F.struct(F.lit(name).alias("label_id"), F.col(f"n{i}").alias("papers_with_usable_value")) for i, name in enumerate(tests)))).alias("r"))
    n = F.col("r.papers_with_usable_value")
    return rows.select("r.label_id", n.alias("papers_with_usable_value"), "total", F.round(n / F.greatest("total", F.lit(1)), 4).alias("ratio"))


def missingness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """field, empty, total of the columns that are empty in half of the rows or more."""
    one = df.agg(F.count("*").alias("total"), *(F.count_if(F.trim(X.text_of(F.col(c))) == "").alias(f"n{i}") for i, c in enumerate(columns)))
    rows = one.select("total", F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.col(f"n{i}").alias("empty")) for i, c in enumerate(columns)))).alias("r")).select("r.field", "r.empty", "total")
    return rows.filter((F.col("total") >= LEAST_ROWS_FOR_MISSINGNESS) & (F.col("empty") >= MUCH_MISSING * F.col("total")))


def missingness_issues(df: DataFrame, labels: Sequence[Label]) -> DataFrame:
    """field, value, issue, severity, detail: each invalid value that a label shows, and labels that are mostly empty."""
    auto = [x.label_id for x in labels if x.mode == "controlled_auto"]
    bad = value_counts(df, [x for x in labels if x.controlled]).filter("status = 'invalid'")
    bad = bad.select(F.col("label_id").alias("field"), "value", F.lit("observed_invalid_value_summary").alias("issue"), F.when(F.col("label_id").isin(auto), "warning").otherwise("error").alias("severity"), F.concat(F.lit("count="), F.col("paper_count").cast("string")).alias("detail"))
    much = missingness(df, [x.label_id for x in labels])
    said = F.concat(F.col("empty").cast("string"), F.lit("_of_"), F.col("total").cast("string"), F.lit("_rows_empty"))
    return bad.unionByName(much.select("field", F.lit("").alias("value"), F.lit("high_missingness").alias("issue"), F.lit("warning").alias("severity"), said.alias("detail")))


def duplicate_ids(df: DataFrame, key: str) -> DataFrame:
    plain = F.trim(X.text_of(F.col(key)))
    return df.filter(plain != "").groupBy(plain.alias(key)).agg(F.count("*").alias("n")).filter("n > 1")


def issue_counts(df: DataFrame, column: str = "issue") -> DataFrame:
    plain = X.clean_whitespace(F.col(column))
    return df.filter(plain != "").groupBy(plain.alias(column)).agg(F.count("*").alias("n")).orderBy(column)


def year_range(df: DataFrame, year: Column) -> DataFrame:
    digits = F.when(X.text_of(year).rlike("^[0-9]+$"), year.cast("string").try_cast("int"))
    return df.agg(F.min(digits).alias("first_year"), F.max(digits).alias("last_year"))


STATUSES = ["deterministic_include", "deterministic_exclude", "pending_llm_full_text", "llm_screened", "llm_error", "llm_error_auto_excluded"]


def screening_counts(df: DataFrame, by: str) -> DataFrame:
    """Ten counters for each value of a column; an empty one is ``unknown``."""
    decision = lambda d: F.count_if(F.col("screening_decision") == d)
    return df.groupBy(X.first_value(F.col(by), F.lit("unknown")).alias(by)).agg(
        F.count("*").alias("total"), decision("include").alias("included"), decision("exclude").alias("excluded"), decision("review").alias("review"), *(F.count_if(F.col("screening_status") == s).alias(s) for s in STATUSES)
    )


def quote_issues(df: DataFrame, key: str, column: str) -> DataFrame:
    """key, issue, severity of a column of JSON quotes."""
    raw = X.text_of(F.col(column))
    parsed = F.try_parse_json(raw)
    kind = F.schema_of_variant(parsed)
    is_list = kind.startswith("ARRAY")
    items = F.from_json(raw, "array<struct<quote:string,section:string>>")
    issue = lambda name, severity: F.struct(F.lit(name).alias("issue"), F.lit(severity).alias("severity"))
    each = F.flatten(F.transform(F.coalesce(items, F.array().cast("array<struct<quote:string,section:string>>")), lambda q: F.array_compact(F.array(F.when(F.trim(X.text_of(q["quote"])) == "", issue("quote_missing_text", "error")), F.when(F.trim(X.text_of(q["section"])) == "", issue("quote_missing_section", "warning"))))))
    found = F.when(F.trim(raw) == "", F.array().cast("array<struct<issue:string,severity:string>>")).when(parsed.isNull(), F.array(issue("malformed_quote_json", "error"))).when(~is_list, F.array(issue("quote_json_not_list", "error"))).otherwise(each)
    return df.select(key, F.explode(found).alias("i")).select(key, "i.*")


def report(eligible: int, labelled: int, usable: int, evidence: int, citable: int, findings: int) -> dict:
    """Coverage status: critical pauses a run."""
    critical = [m for bad, m in ((usable < 3, "fewer than three usable papers"), (citable < 3, "fewer than three citable papers with evidence"), (labelled > 0 and findings == 0, "no key finding")) if bad]
    warnings = [m for bad, m in ((labelled < eligible, f"{eligible - labelled} eligible papers without labels"), (findings < usable, f"{usable - findings} usable papers without a key finding")) if bad]
    least = citable if citable < 20 else 20
    return {"status": "critical" if critical else "warning" if warnings else "ok", "critical": critical, "warnings": warnings, "minimum_cited": least, "target_cited": least if citable < 20 else min(40, citable), "papers_with_evidence": evidence}
