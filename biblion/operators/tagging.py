"""Tags and review labels from a language model: prompts, calls, checks, flat rows, rules.

Papers are called in parallel, one client a task; a paper whose call or answer
fails becomes a row of errors, and the others go on.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from biblion.functions import text as X
from biblion.operators import audit, model
from biblion.operators.audit import Category, Label
from biblion.sources import fulltext

#: Characters of evidence that a label's packet holds.
LABEL_EVIDENCE = 2_500
CLAIM = "main_knowledge_claim"
METADATA = ["paper_id", "title", "year", "doi", "authors", "venue", "source"]


def prompt_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Only what a prompt is to see, in its order; what a table lacks is empty."""
    return df.select(*(X.text_of(F.col(c)).alias(c) if c in df.columns else F.lit("").alias(c) for c in columns))


def _schema_of(categories: Sequence[Category]) -> dict:
    return {"type": "object", "required": [CLAIM, *(c.category_id for c in categories)], "additionalProperties": False}


def _answered(answer: Column, path: str) -> Column:
    """The texts of a JSON list; of one text, itself."""
    found = F.from_json(F.get_json_object(answer, f"$.{path}"), "array<string>")
    one = F.get_json_object(answer, f"$.{path}")
    plain = F.when(one.isNull() | (one == ""), F.array().cast("array<string>")).otherwise(F.array(one))
    return F.when(F.substr(F.ltrim(X.text_of(one)), F.lit(1), F.lit(1)) == "[", F.coalesce(found, F.array().cast("array<string>"))).otherwise(plain)


def _not_in(values: Column, allowed: Sequence[str]) -> Column:
    return F.filter(values, lambda v: ~v.isin(list(allowed)))


def tagged(df: DataFrame, categories: Sequence[Category], template: str, client: Callable[[], model.JsonClient], fallback: dict[str, str] | None = None, key: str = "paper_id", prompt: Sequence[str] = ("paper_id", "title", "abstract")) -> tuple[DataFrame, DataFrame]:
    """Flat tagged rows, and key, error of the papers that failed.

    A tag that isn't allowed fails its paper.  Children are checked against the
    tags of their parents as they were answered.
    """
    fallback = fallback or {}
    told = model.per_row(prompt_columns(df, list(dict.fromkeys([key, *prompt]))), key, template, _schema_of(categories), client)
    rows = df.join(told.withColumnsRenamed({"answer": "_answer", "error": "_error"}), key)
    answer = F.col("_answer")
    raw = {c.category_id: _answered(answer, c.category_id) for c in categories}
    unknown = {c.category_id: _not_in(raw[c.category_id], c.allowed) for c in categories}
    wrong = [F.when(F.size(u) > 0, F.concat(F.lit(f"{name}: not allowed: "), F.array_join(u, ", "))) for name, u in unknown.items()]
    lost = [F.when(F.size(raw[c.category_id]) == 0, f"required category {c.category_id} is empty") for c in categories if c.required and c.category_id not in fallback and c.parent is None]
    rows = rows.withColumn("_error", X.first_value(F.col("_error"), F.concat_ws("; ", *wrong, *lost)))
    bad = rows.filter("_error <> ''").select(key, F.col("_error").alias("error"))
    # parents first, as texts: their children ask for them
    good = rows.filter("_error = ''").withColumns({c.category_id: F.array_join(raw[c.category_id], "; ") for c in categories})
    cells = {c.category_id: F.array_join(audit.validated_tags(c, X.multi_values(F.col(c.category_id)), fallback.get(c.category_id)), "; ") for c in categories}
    good = good.withColumn(CLAIM, X.text_of(F.get_json_object(answer, f"$.{CLAIM}"))).withColumns(cells)
    own = [c for c in df.columns if c != CLAIM and c not in cells]
    return good.select(*own, CLAIM, *cells), bad


def flat_tags(df: DataFrame, categories: Sequence[str], tags: str = "tags") -> DataFrame:
    """``df`` with a text column for each category of a map<string,array<string>>, values joined by ``; ``."""
    kept = [c for c in df.columns if c != tags]
    return df.select(*(c for c in kept if c not in categories), *(X.text_of(F.array_join(F.try_element_at(F.col(tags), F.lit(c)), "; ")).alias(c) for c in categories))


def flat_labels(df: DataFrame, labels: Sequence[Label], values: str = "values", quotes: str = "quotes") -> DataFrame:
    """Metadata and a text column for each label: lists joined by ``; ``, quotes as JSON."""
    cells = []
    for x in labels:
        if x.mode == "evidence_quote":
            found = F.coalesce(F.try_element_at(F.col(quotes), F.lit(x.label_id)), F.array().cast("array<struct<quote:string,section:string,reason:string>>"))
            cells.append(F.to_json(found).alias(x.label_id))
        else:
            cells.append(X.text_of(F.array_join(F.try_element_at(F.col(values), F.lit(x.label_id)), "; ")).alias(x.label_id))
    return df.select(*(X.text_of(F.col(c)).alias(c) if c in df.columns else F.lit("").alias(c) for c in METADATA), *cells)


# review labels


def packet(sections: Column, words: Sequence[str], most: int = LABEL_EVIDENCE) -> Column:
    """The evidence for one label, of prioritized sections: those that hold a word of it come first."""
    asked = [w for w in (x.lower() for x in words) if len(w) > 2]
    if not asked:
        return fulltext.evidence(sections, most)

    def holds(s: Column) -> Column:
        low = F.lower(F.concat_ws(" ", s["heading"], s["body"]))
        found = F.lit(False)
        for w in asked:
            found = found | low.contains(w)
        return found

    return fulltext.evidence(F.concat(F.filter(sections, holds), F.filter(sections, lambda s: ~holds(s))), most)


def normalized_label(answer: Column, x: Label) -> Column:
    """An answer in the form of its mode: slugs, allowed ones only for fixed lists, one for single choice; plain text; quotes."""
    if x.mode == "evidence_quote":
        return F.to_json(X.quotes(F.get_json_object(answer, f"$.{x.label_id}")))
    if x.mode == "free_text":
        return X.clean_whitespace(F.array_join(_answered(answer, x.label_id), "; "))
    values = F.array_distinct(F.filter(F.transform(_answered(answer, x.label_id), X.slug), lambda v: v != ""))
    if x.mode == "controlled_fixed" and x.allowed:
        values = F.filter(values, lambda v: v.isin(list(x.allowed)))
    if x.selection == "single":
        values = F.slice(values, 1, 1)
    return F.array_join(values, "; ")


def extracted(df: DataFrame, labels: Sequence[Label], template: str, client: Callable[[], model.JsonClient], key: str = "paper_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Rows of review labels of the papers that have a text, and key, error of those whose call failed.

    Papers without a text are in neither.
    """
    asked = df.filter(F.trim(X.text_of(F.col(text))) != "")
    # texts are parted once, for all labels
    told = fulltext.prioritized(fulltext.split_sections(F.col(text)), F.col(text))
    parted = asked.withColumn("_sections", told)
    packets = [packet(F.col("_sections"), x.label_id.split("_")).alias(f"evidence_{x.label_id}") for x in labels]
    schema = {"type": "object", "required": [x.label_id for x in labels], "additionalProperties": False}
    prompts = parted.select(key, *(X.text_of(F.col(c)).alias(c) for c in METADATA if c in df.columns and c != key), *packets)
    told = model.per_row(prompts, key, template, schema, client)
    rows = asked.join(told.withColumnsRenamed({"answer": "_answer", "error": "_error"}), key)
    cells = [normalized_label(F.col("_answer"), x).alias(x.label_id) for x in labels]
    own = [X.text_of(F.col(c)).alias(c) if c in df.columns else F.lit("").alias(c) for c in METADATA]
    return rows.filter("_error = ''").select(*own, *cells), rows.filter("_error <> ''").select(key, F.col("_error").alias("error"))


# rules


def rule_schema() -> dict:
    return {"type": "object", "required": ["rules"]}


def repaired_rules(answer: dict, categories: Sequence[Category]) -> list[dict]:
    """One rule for each category, in its order; what an answer got wrong is mended from the category itself.

    Rules of unknown categories go, missing ones are added, a repeated one counts
    once; values, selection and dependency are those of the category.
    """
    given: dict[str, dict] = {}
    for rule in answer.get("rules") or []:
        if isinstance(rule, dict):
            given.setdefault(str(rule.get("category_id") or "").strip(), rule)
    made = []
    for c in categories:
        rule = given.get(c.category_id, {})
        told = {str(v.get("value") or ""): str(v.get("use_when") or "").strip() for v in rule.get("values") or [] if isinstance(v, dict)}
        made.append(
            {
                "category_id": c.category_id,
                "selection": c.selection,
                "required": c.required,
                "values": [{"value": v, "use_when": told.get(v) or f"The paper is about {v.replace('_', ' ')}."} for v in c.allowed],
                "depends_on": {"category_id": c.parent, "values": list(c.triggers)} if c.parent else None,
            }
        )
    return made


def generated_rules(categories: Sequence[Category], template: str, client: model.JsonClient) -> list[dict]:
    """The rules of tagging from one call, repaired; a call that fails is an error."""
    told = [{"category_id": c.category_id, "values": list(c.allowed)} for c in categories]
    answer, error = model.called(client, model.rendered(template, {"categories": json.dumps(told, ensure_ascii=False)}), rule_schema())
    if error:
        raise ValueError(f"rules: {error}")
    return repaired_rules(json.loads(answer), categories)


def rules_by_category(rules: Sequence[dict], categories: Sequence[Category]) -> dict[str, dict]:
    """Each category's rule; one that lacks its rule is an error."""
    found = {r["category_id"]: r for r in rules}
    lacking = [c.category_id for c in categories if c.category_id not in found]
    if lacking:
        raise KeyError(", ".join(lacking))
    return found
