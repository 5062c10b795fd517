"""Topic terms against texts, tiers, and the screening cascade.

Terms come from a configuration and are few; each becomes an expression, so a
match of all terms is one projection, without a join.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from biblion.functions import text as X

EXCLUDED_TIER = 999
FIELDS = ("title", "abstract", "title_or_abstract")


@dataclass(frozen=True)
class Topic:
    topic_id: str
    terms: Sequence[str]
    field: str = "title_or_abstract"
    kind: str = "main"
    group_id: str = ""


@dataclass(frozen=True)
class TopicSpec:
    topics: Sequence[Topic]
    anchor: str

    @property
    def main(self) -> list[str]:
        return list(dict.fromkeys(t.topic_id for t in self.topics if t.kind == "main"))


def spec_of(contract: dict) -> TopicSpec:
    """The topics of a contract."""
    structure = contract.get("topic_structure") or {}
    found = []
    for x in structure.get("main_topics") or []:
        if isinstance(x, dict) and str(x.get("topic_id") or "").strip():
            found.append(Topic(str(x["topic_id"]).strip(), all_terms(x), field_of(x)))
    found += [Topic(g["main_topic_id"], g["terms"], g["field"], "secondary", g["secondary_topic_id"]) for g in secondary_groups(structure)]
    return TopicSpec(found, str(structure.get("anchor_topic_id") or "").strip())


def field_of(x: dict, default: str = "title") -> str:
    field = str(x.get("field") or default).strip()
    return field if field in FIELDS else default


def all_terms(x: dict) -> list[str]:
    """The terms of a topic for matching, those for retrieval included."""
    return unique_terms([t for key in ("matching_terms", "retrieval_terms", "terms") for t in (x[key] if isinstance(x.get(key), list) else [])])


def unique_terms(terms) -> list[str]:
    """Terms without blanks around them, the first of those that differ in case only."""
    seen: dict[str, str] = {}
    for term in terms if isinstance(terms, list) else []:
        if str(term or "").strip():
            seen.setdefault(str(term).strip().casefold(), str(term).strip())
    return list(seen.values())


def given_groups(structure: dict) -> list[tuple[str, object]]:
    """Main topic and group of each secondary group, as given: one list, or by main topic lists of groups or of terms."""
    given = structure.get("secondary_topics")
    if isinstance(given, list):
        return [(str(g.get("main_topic_id") or "").strip(), g) for g in given if isinstance(g, dict)]
    flat: list[tuple[str, object]] = []
    for topic, groups in given.items() if isinstance(given, dict) else ():
        several = isinstance(groups, list) and any(isinstance(g, dict) for g in groups)
        flat += [(str(topic).strip(), g) for g in (groups if several else [groups])]
    return flat


def secondary_groups(structure: dict) -> list[dict]:
    """The groups of terms that may stand for a main topic, numbered within it."""
    mains = [x for x in structure.get("main_topics") or [] if isinstance(x, dict)]
    fields = {str(x.get("topic_id") or "").strip(): field_of(x) for x in mains}
    counts: dict[str, int] = {}
    found = []
    for topic, g in given_groups(structure):
        counts[topic] = counts.get(topic, 0) + 1
        named = isinstance(g, dict)
        terms = all_terms(g) if named else unique_terms(g)
        if not topic or not terms:
            continue
        own = str((g.get("secondary_topic_id") or g.get("topic_id") or g.get("id") or "") if named else "").strip() or f"{topic}_secondary_{counts[topic]}"
        label = str(g.get("label") or "").strip() or own if named else f"Secondary replacement for {topic}"
        default = fields.get(topic, "title")
        made = {"main_topic_id": topic, "secondary_topic_id": own, "label": label, "field": field_of(g, default) if named else default, "terms": terms}
        if named and unique_terms(g.get("retrieval_terms")):
            made["retrieval_terms"] = unique_terms(g["retrieval_terms"])
        found.append(made)
    return found


def _fields(topic: Topic) -> list[str]:
    return ["title", "abstract"] if topic.field not in ("title", "abstract") else [topic.field]


def topic_hits(spec: TopicSpec) -> Column:
    """array<struct<topic_id, kind, group_id, value, field, ordinal>> over columns _title and _abstract, in lower case."""
    hits, n = [], 0
    for topic in spec.topics:
        for term in topic.terms:
            for field in _fields(topic):
                made = F.struct(F.lit(topic.topic_id).alias("topic_id"), F.lit(topic.kind).alias("kind"), F.lit(topic.group_id).alias("group_id"), F.lit(term).alias("value"), F.lit(field).alias("field"), F.lit(n).alias("ordinal"))
                hits.append(F.when(X.holds_term(F.col("_" + field), term), made))
                n += 1
    return F.array_compact(F.array(*hits))


def matched(df: DataFrame, spec: TopicSpec, unescape: bool = True) -> DataFrame:
    """``df`` with topic_hits, matched and missing topics, anchor_present and local_relevance_tier."""
    rows = df.withColumns({"_title": F.lower(X.match_text(F.col("title"), unescape)), "_abstract": F.lower(X.match_text(F.col("abstract"), unescape))})
    rows = rows.withColumn("topic_hits", topic_hits(spec)).drop("_title", "_abstract")
    main = F.array(*map(F.lit, spec.main))

    def having(kind: str) -> Column:
        ids = F.transform(F.filter("topic_hits", lambda h: h["kind"] == kind), lambda h: h["topic_id"])
        return F.filter(main, lambda t: F.array_contains(ids, t))

    rows = rows.withColumns({"matched_main_topics": having("main"), "matched_secondary_topics": having("secondary")})
    rows = rows.withColumns({"missing_main_topics": F.array_except(main, "matched_main_topics"), "anchor_present": F.array_contains("matched_main_topics", spec.anchor)})
    return rows.withColumn("local_relevance_tier", tier(spec.anchor))


def tier(anchor: str) -> Column:
    """Number of missing main topics if the anchor is there and each missing one has a secondary; else 999."""
    unhelped = F.array_except(F.filter("missing_main_topics", lambda t: t != anchor), "matched_secondary_topics")
    return F.when(F.col("anchor_present") & (F.size(unhelped) == 0), F.size("missing_main_topics")).otherwise(EXCLUDED_TIER)


def matches_long(df: DataFrame, key: str) -> DataFrame:
    """One row for each topic, term and field that matched."""
    # outer, so that no filter is inferred that would work out all matches once more
    return df.select(key, F.explode_outer("topic_hits").alias("h")).filter("h IS NOT NULL").select(key, "h.topic_id", "h.kind", "h.group_id", "h.value", "h.field")


def merged_matches(df: DataFrame, key: str, ordinal: str) -> DataFrame:
    """Matches of a group of duplicates: unique by topic, kind, group, folded value and field; the first spelling stays."""
    long = df.select(key, ordinal, F.explode("topic_hits").alias("h")).select(key, ordinal, "h.*")
    long = long.withColumn("folded", F.lower("value"))
    return long.groupBy(key, "topic_id", "kind", "group_id", "folded", "field").agg(F.min_by("value", F.struct(F.col(ordinal), F.col("ordinal"))).alias("value")).drop("folded")


def strict_title(phase: Column, retrieval_tier: Column, needs_title_screening: Column) -> Column:
    return F.coalesce(phase == "strict_title", F.lit(False)) | F.coalesce((retrieval_tier == 0) & ~needs_title_screening, F.lit(False))


def cascade(df: DataFrame, spec: TopicSpec, strict: Column, retrieval_tier: Column) -> DataFrame:
    """Decision by the first rule that applies; what no rule decides goes to a model."""
    titles = F.transform(F.filter("topic_hits", lambda h: (h["kind"] == "main") & (h["field"] == "title")), lambda h: h["topic_id"])
    all_in_title = F.size(F.array_except(F.array(*map(F.lit, spec.main)), titles)) == 0
    local = F.col("local_relevance_tier")
    rule = (
        F.when(F.coalesce(retrieval_tier == 0, F.lit(False)) & (local == 0) & all_in_title, "tier0_title")
        .when(strict & (local != EXCLUDED_TIER), "local_include")
        .when(strict & ~F.col("anchor_present"), "anchor_missing")
        .otherwise("needs_llm")
    )
    rows = df.withColumn("screening_rule", rule)
    decision = F.when(F.col("screening_rule").isin("tier0_title", "local_include"), "include").when(F.col("screening_rule") == "anchor_missing", "exclude").otherwise("pending")
    status = F.when(decision == "include", "deterministic_include").when(decision == "exclude", "deterministic_exclude").otherwise("pending_llm_full_text")
    return rows.withColumns({"screening_decision": decision, "screening_status": status})


def verdict(anchor_present: Column, missing: Column, confirmed: Column, anchor: str) -> Column:
    """struct<decision, tier> from a model's evidence alone, whatever it decided itself."""
    open_ = F.array_except(F.filter(missing, lambda t: t != anchor), confirmed)
    good = F.coalesce(anchor_present, F.lit(False)) & (F.size(open_) == 0)
    return F.struct(F.when(good, "include").otherwise("exclude").alias("decision"), F.when(good, F.size(missing)).otherwise(EXCLUDED_TIER).alias("tier"))


def failed(anchor_present: Column, message: Column) -> Column:
    """struct<decision, status, error_type, message> for a row whose model call failed."""
    low = F.lower(message)
    kind = F.when(low.contains("timeout") | low.contains("timed out"), "timeout").when(low.contains("rate limit"), "rate_limit").when(low.contains("json"), "invalid_json").otherwise("llm_error")
    away = F.coalesce(~anchor_present, F.lit(False))
    return F.struct(F.when(away, "exclude").otherwise("review").alias("decision"), F.when(away, "llm_error_auto_excluded").otherwise("llm_error").alias("status"), kind.alias("error_type"), F.substr(message, F.lit(1), F.lit(1000)).alias("message"))
