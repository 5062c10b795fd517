"""Review labels: their validation, which papers may be used, and the evidence that a review is written from."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from biblion.functions import text as X
from biblion.operators import audit
from biblion.operators.audit import Label

# They must be these for the results to be right.
REQUIRED = ["paper_id", "title", "year", "doi"]
RECOMMENDED = ["authors", "venue"]
ISSUES = "array<struct<field:string,value:string,issue:string,severity:string,detail:string>>"


def _issue(field: str, value: Column | str, issue: str, severity: str, detail: Column | str = "") -> Column:
    parts = {"field": F.lit(field), "value": value, "issue": F.lit(issue), "severity": F.lit(severity), "detail": detail}
    return F.struct(*((F.lit(v) if isinstance(v, str) else v).alias(k) for k, v in parts.items()))


def _when(condition: Column, issue: Column) -> Column:
    return F.when(condition, F.array(issue)).otherwise(F.array().cast(ISSUES))


def _empty(name: str) -> Column:
    return F.trim(X.text_of(F.col(name))) == ""


def _quotes(label: Label) -> Column:
    raw = X.text_of(F.col(label.label_id))
    parsed = F.try_parse_json(raw)
    items = F.try_variant_get(parsed, "$", "array<variant>")
    name = label.label_id

    def of(q: Column, i: Column) -> Column:
        is_object = F.schema_of_variant(q).startswith("OBJECT")
        lacks = lambda key: F.trim(X.text_of(F.try_variant_get(q, f"$.{key}", "string"))) == ""
        other = _issue(name, X.text_of(F.try_variant_get(q, "$", "string")), "quote_item_not_object", "error", F.concat(F.lit("quote_index="), (i + 1).cast("string")))
        fine = F.concat(_when(lacks("quote"), _issue(name, "", "quote_missing_text", "error")), _when(lacks("section"), _issue(name, "", "quote_missing_section", "warning")))
        return F.when(F.coalesce(is_object, F.lit(False)), fine).otherwise(F.array(other))

    none = F.array().cast(ISSUES)
    told = F.when(parsed.isNull(), F.array(_issue(name, raw, "malformed_quote_json", "error"))).when(items.isNull(), F.array(_issue(name, raw, "quote_json_not_list", "error")))
    return F.when(_empty(name), none).otherwise(told.otherwise(F.flatten(F.transform(items, of))))


def _values(label: Label) -> Column:
    name, values = label.label_id, X.label_values(F.col(label.label_id))
    none = F.array().cast(ISSUES)
    bad = F.filter(values, lambda v: ~v.isin(list(label.allowed))) if label.allowed else F.array().cast("array<string>")

    def of(v: Column) -> Column:
        if label.mode == "controlled_fixed":
            return _issue(name, v, "invalid_review_value", "error")
        told = F.when(v.isin(list(label.dropped)), _issue(name, v, "review_value_dropped", "warning", "dropped_by_review")).otherwise(_issue(name, v, "invalid_review_value", "warning", "ignored_for_controlled_auto_label"))
        if not label.mappings:
            return told
        to = F.try_element_at(F.create_map(*(F.lit(x) for pair in label.mappings.items() for x in pair)), v)
        return F.when(to.isNotNull(), _issue(name, v, "review_value_mapped", "warning", F.concat(F.lit("mapped_to="), to))).otherwise(told)

    several = _when(F.size(values) > 1, _issue(name, F.array_join(values, "; "), "single_selection_has_multiple_values", "error"))
    return F.concat(F.transform(bad, of), several if label.selection == "single" else none)


def issues(df: DataFrame, labels: Sequence[Label]) -> DataFrame:
    """paper_id, field, value, issue, severity, detail: rows, repeated ids, and labels that are mostly empty.

    Null cells are empty.  Each row is judged in one projection.
    """
    parts = [_when(_empty(c), _issue(c, "", "required_metadata_missing", "error")) for c in REQUIRED]
    parts += [_when(_empty(c), _issue(c, "", "recommended_metadata_missing", "warning")) for c in RECOMMENDED]
    for x in labels:
        if x.required:
            parts.append(_when(_empty(x.label_id), _issue(x.label_id, "", "required_review_label_missing", "error")))
        if x.controlled:
            parts.append(_values(x))
        elif x.mode == "evidence_quote":
            parts.append(_quotes(x))
    rows = df.select(X.text_of(F.col("paper_id")).alias("paper_id"), F.explode(F.concat(*(p.cast(ISSUES) for p in parts))).alias("i")).select("paper_id", "i.*")
    twice = audit.duplicate_ids(df.filter(~_empty("paper_id")).select(F.trim("paper_id").alias("paper_id")), "paper_id")
    rows = rows.unionByName(twice.select("paper_id", F.lit("paper_id").alias("field"), F.col("paper_id").alias("value"), F.lit("duplicate_paper_id").alias("issue"), F.lit("error").alias("severity"), F.lit("").alias("detail")))
    if not labels:
        return rows
    counts = df.agg(F.count("*").alias("n"), *(F.count_if(_empty(x.label_id)).alias(f"e{k}") for k, x in enumerate(labels)))
    each = F.array(*(F.struct(F.lit(x.label_id).alias("field"), F.col(f"e{k}").alias("e")) for k, x in enumerate(labels)))
    much = counts.filter(f"n >= {audit.LEAST_ROWS_FOR_MISSINGNESS}").select("n", F.explode(each).alias("x")).filter(F.col("x.e") / F.col("n") >= audit.MUCH_MISSING)
    return rows.unionByName(much.select(F.lit("").alias("paper_id"), "x.field", F.lit("").alias("value"), F.lit("high_missingness").alias("issue"), F.lit("warning").alias("severity"), F.concat(F.col("x.e").cast("string"), F.lit("_of_"), F.col("n").cast("string"), F.lit("_rows_empty")).alias("detail")))


def problem_papers(found: DataFrame, labels: Sequence[Label]) -> DataFrame:
    """The ids with an error; an invalid value of a label that grows by itself is none."""
    auto = [x.label_id for x in labels if x.mode == "controlled_auto"]
    error = (F.col("severity") == "error") & (F.trim(X.text_of(F.col("paper_id"))) != "")
    return found.filter(error & ~((F.col("issue") == "invalid_review_value") & F.col("field").isin(auto))).select("paper_id").distinct()


def usable(df: DataFrame, found: DataFrame, labels: Sequence[Label]) -> DataFrame:
    """Rows without errors that hold evidence: a controlled value that stays, or a text that says something."""
    holds = F.lit(False)
    for x in labels:
        c = F.col(x.label_id)
        holds = holds | (F.size(audit.cleaned_values(c, x)) > 0 if x.controlled else audit.useful(c))
    return df.filter(holds & ~_empty("paper_id")).join(problem_papers(found, labels), "paper_id", "left_anti")


def evidence(df: DataFrame, found: DataFrame, labels: Sequence[Label]) -> DataFrame:
    """paper_id, label_id, values (cleaned) and quotes of each usable row: what every section is written from."""
    rows, parts = usable(df, found, labels), []
    none, no_quotes = F.array().cast("array<string>"), X.quotes(F.lit("[]"))
    for x in labels:
        c = F.col(x.label_id)
        if x.controlled:
            values = audit.cleaned_values(c, x)
        else:
            values = none if x.mode == "evidence_quote" else F.when(audit.useful(c), F.array(X.clean_whitespace(c))).otherwise(none)
        parts.append(F.struct(F.lit(x.label_id).alias("label_id"), values.alias("values"), (X.quotes(c) if x.mode == "evidence_quote" else no_quotes).alias("quotes")))
    told = rows.select("paper_id", F.explode(F.array(*parts)).alias("e")).select("paper_id", "e.*")
    return told.filter((F.size("values") > 0) | (F.size("quotes") > 0))


def hierarchy(counts: DataFrame, parents: dict[str, Sequence[str]]) -> DataFrame:
    """parent_value, child_value of the configured pairs that both occur in ``counts`` (value)."""
    pairs = [(p, c) for p, children in parents.items() for c in children]
    known = counts.select("value").distinct()
    rows = counts.sparkSession.createDataFrame(pairs, "parent_value string, child_value string")
    for side in ("parent_value", "child_value"):
        rows = rows.join(known.withColumnRenamed("value", side), side, "left_semi")
    return rows.select("parent_value", "child_value").orderBy("parent_value", "child_value")


def finalized(screening: DataFrame, candidates: DataFrame, availability: DataFrame, ordinal: str, decide) -> DataFrame:
    """Screening rows whose decision was put off until a full text was known, decided now.

    Only pending rows with a verified full text and a candidate are given to
    ``decide`` (ordinal and the columns of the candidate in; ordinal and
    screening_decision out); all others stay as they are.
    """
    from biblion.operators.papers import join_key, last_of

    keys = ["key_doi", "key_id"]
    keyed = lambda df: df.select("*", *join_key(F.col("doi"), F.col("provider_id")))
    pending = keyed(screening.filter("screening_status = 'pending_llm_full_text'")).select(ordinal, *keys)
    ready = keyed(availability.filter("full_text_availability_status = 'verified'")).select(*keys).distinct()
    known = last_of(keyed(candidates), keys, ordinal).drop(ordinal)
    told = decide(pending.join(ready, keys, "left_semi").join(known, keys).drop(*keys)).select(ordinal, F.col("screening_decision").alias("_new"))
    rows = screening.join(told, ordinal, "left")
    settled = {"screening_decision": F.coalesce("_new", "screening_decision"), "screening_status": F.when(F.col("_new").isNotNull(), F.lit("llm_screened")).otherwise(F.col("screening_status"))}
    return rows.withColumns(settled).select(screening.columns)
