"""Which papers speak of a topic: scores, eligibility and choice by the words of a contract.

The words come from a configuration and are few, so they are literals in the
plan; papers are only projected, and the one sort is a top-k.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from biblion.functions import text as X
from biblion.operators.papers import exported, included, is_not_primary, is_review_candidate

# They must be these for the results to be right.
STOPWORDS = [
    "about", "across", "after", "also", "among", "and", "are", "based", "application", "applications", "been", "being", "between", "both", "can",
    "could", "does", "evidence", "explores", "for", "from", "has", "have", "how", "impact", "into", "its", "may", "methods", "more", "not",
    "outcomes", "research", "settings", "that", "the", "their", "these", "this", "through", "use", "used", "using", "what", "when", "where", "which",
    "with", "within",
]
GENERIC = [
    "abstract", "academic", "adaptive", "affects", "algorithmic", "analyses", "analysis", "analyzing", "application", "applications", "approach",
    "approaches", "aspect", "aspects", "assess", "assessing", "artificial", "automated", "based", "borderline", "chatbot", "chatbots", "chatgpt",
    "clearly", "deep", "directly", "discuss", "effect", "effects", "effectiveness", "evidence", "empirical", "exclude", "explore", "exploring",
    "focused", "focus", "generative", "impact", "impacts", "include", "implementation", "indicate", "indicates", "investigate", "investigates",
    "intelligent", "intelligence", "language", "large", "learning", "literature", "llm", "machine", "method", "methodologies", "methods", "meta",
    "model", "models", "outcome", "outcomes", "paper", "papers", "performance", "platform", "platforms", "processes", "only", "related", "relevant",
    "research", "role", "review", "reviews", "smart", "study", "studies", "studying", "subtopics", "summarizing", "support", "supported",
    "supporting", "systematic", "system", "systems", "technology", "technologies", "they", "title", "tool", "tools", "unrelated",
]
#: Words that say nothing of a topic when primary papers are chosen: another list than that of refinement.
CALIBRATION_GENERIC = [
    "academic", "adaptive", "affects", "algorithmic", "analyses", "analysis", "analyzing", "application", "applications", "approach", "approaches",
    "aspects", "artificial", "automated", "based", "borderline", "chatbot", "chatbots", "chatgpt", "clearly", "deep", "directly", "discuss", "effect",
    "effects", "evidence", "empirical", "exclude", "explore", "exploring", "focused", "generative", "impact", "impacts", "include", "implementation",
    "intelligent", "intelligence", "language", "large", "learning", "literature", "llm", "machine", "method", "methodologies", "methods", "meta",
    "model", "models", "outcome", "outcomes", "paper", "papers", "performance", "processes", "relevant", "research", "role", "review", "reviews",
    "smart", "study", "studies", "studying", "systematic", "system", "systems", "technology", "technologies", "they", "tool", "tools", "unrelated",
]
REVIEW_EVIDENCE = ["systematic review", "scoping review", "rapid review", "umbrella review", "meta-analysis", "review", "overview", "survey"]
LEAST_TITLE_TOKENS = LEAST_TEXT_TOKENS = 2


def plain(text: object) -> str:
    return re.sub("[^a-z0-9]+", " ", str(text or "").lower()).strip()


def words_of(texts: Iterable[object]) -> list[str]:
    """The distinct meaningful tokens of configured texts."""
    found = (w for t in texts for w in plain(t).split() if w not in STOPWORDS and (len(w) >= 3 or w == "ai"))
    return list(dict.fromkeys(found))


def tokens(c: Column) -> Column:
    """The distinct meaningful tokens of a text."""
    return F.array_distinct(F.filter(F.split(X.title_key(c), " "), lambda w: ((F.length(w) >= 3) | (w == "ai")) & ~w.isin(STOPWORDS)))


def _texts(contract: dict, scope: Sequence[str]) -> list[str]:
    topic = contract.get("research_topic") or {}
    found = [topic.get("title"), topic.get("description")]
    for x in (contract.get("topic_structure") or {}).get("main_topics") or []:
        found += [x.get("label"), *(x.get("terms") or [])]
    for key in scope:
        found += (contract.get("scope") or {}).get(key) or []
    for q in (contract.get("collection") or {}).get("search_queries") or []:
        found.append(q.get("query") if isinstance(q, dict) else q)
    return [t for t in found if str(t or "").strip()]


def specific_terms(contract: dict) -> list[str]:
    """Tokens of the contract that aren't general to research."""
    words = words_of(_texts(contract, ["include_criteria", "boundary_rules"]))
    return [w for w in words if (len(w) >= 4 or w == "ai") and w not in GENERIC]


def phrases(contract: dict, longest: int = 4) -> list[str]:
    """Runs of two to four words of the contract, two of them meaningful."""
    found = {}
    for text in _texts(contract, []):
        w = plain(text).split()
        for n in range(2, longest + 1):
            found |= {" ".join(w[i : i + n]): None for i in range(len(w) - n + 1) if len(words_of([" ".join(w[i : i + n])])) >= 2}
    return list(found)


def _shared(of: Column, words: Sequence[str]) -> Column:
    return F.array_intersect(of, F.array(*map(F.lit, words)).cast("array<string>"))


def _held(normal: Column, terms: Sequence[str]) -> Column:
    """How many terms a normalized text holds, as parts of words too."""
    asked = [t for t in map(plain, terms) if t]
    return sum((normal.contains(t).cast("int") for t in asked), F.lit(0))


def scored(df: DataFrame, contract: dict, this_year: int) -> DataFrame:
    """``df`` (title, abstract, venue, cited_by_count, year) with review_score, citation_rate and on_topic.

    Missing texts are empty, missing numbers 0.
    """
    topic, rules, scope = contract.get("research_topic") or {}, contract.get("rule_based_screening") or {}, contract.get("scope") or {}
    include, exclude = rules.get("include_terms") or [], rules.get("exclude_terms") or []
    # the text is normalized and split once, not in each of the terms below
    told = df.withColumn("_text", X.title_key(F.concat_ws(" ", *(X.text_of(F.col(c)) for c in ("title", "abstract", "venue")))))
    told = told.withColumn("_tokens", tokens(F.col("_text")))
    n = {
        "titled": words_of([topic.get("title")]),
        "researched": words_of([topic.get("title"), topic.get("description")]),
        "wanted": words_of(include),
        "scoped": words_of(t for k in ("include_criteria", "exclude_criteria", "boundary_rules") for t in scope.get(k) or []),
    }
    told = told.withColumns({f"_{k}": F.size(_shared(F.col("_tokens"), v)) for k, v in n.items()} | {"_in": _held(F.col("_text"), include), "_out": _held(F.col("_text"), exclude), "_review": _held(F.col("_text"), REVIEW_EVIDENCE)})
    cited, year = F.coalesce(F.col("cited_by_count").cast("long"), F.lit(0)), F.coalesce(F.col("year").cast("int"), F.lit(0))
    rate, near = X.citation_rate(cited, year, this_year), (F.col("_in") > 0) | (F.col("_wanted") > 0) | (F.col("_titled") > 0)
    points = 30 * F.col("_titled") + 18 * F.col("_wanted") + 6 * F.col("_researched") + 2 * F.col("_scoped") + F.least(F.lit(180), 60 * F.col("_in")) - 120 * F.col("_out") - F.when(near, 0).otherwise(120)
    points = points + F.least(F.lit(8.0), F.log1p(cited) * 1.2) + F.least(F.lit(6.0), F.log1p(rate) * 1.5) + X.recency(year, this_year)
    points = points + F.when(X.text_of(F.col("abstract")) != "", 5.0).otherwise(0.0) + F.least(F.lit(12.0), F.col("_review") * 4.0)
    return told.select(*df.columns, points.alias("review_score"), F.round(rate, 3).alias("citation_rate"), near.alias("on_topic"))


def eligible(df: DataFrame, contract: dict, title: str = "title", text: str = "text") -> DataFrame:
    """``df`` with eligible and why: title and full text must both speak of the topic.

    Without a text a row isn't eligible; without specific terms every other row is.
    """
    terms = specific_terms(contract)
    told = df.withColumns({"_t": _shared(tokens(F.col(title)), terms), "_x": _shared(tokens(F.col(text)), terms), "_n": F.concat(F.lit(" "), X.title_key(F.col(title)), F.lit(" "))})
    phrased = F.lit(False)
    for p in phrases(contract):
        phrased = phrased | F.col("_n").contains(f" {p} ")
    by_title = (F.size("_t") >= LEAST_TITLE_TOKENS) | ((F.size("_t") > 0) & phrased)
    by_text = (F.size("_x") >= LEAST_TEXT_TOKENS) | F.arrays_overlap("_t", "_x")
    why = F.when(F.trim(X.text_of(F.col(text))) == "", "no_text")
    if terms:
        why = why.when(~by_title, "title_off_topic").when(~by_text, "text_off_topic")
    return told.select(*df.columns, F.coalesce(why, F.lit("")).alias("why")).withColumn("eligible", F.col("why") == "")


def calibration_terms(contract: dict) -> list[str]:
    """Tokens of four letters and more of the contract that say something of its topic."""
    words = words_of(_texts({**contract, "collection": {}}, ["include_criteria", "boundary_rules"]))
    return [w for w in words if len(w) >= 4 and w not in CALIBRATION_GENERIC]


def calibration_papers(df: DataFrame, contract: dict, most: int, ordinal: str, text: str = "text") -> DataFrame:
    """The ``most`` primary papers in scope whose texts hold most of the topic's words.

    Of rows with one identity (DOI, id or title) the first counts, before
    reviews, protocols and papers without two of the words are left out.
    """
    if most < 1:
        raise ValueError("most must be at least 1.")
    terms = calibration_terms(contract)
    own = X.first_value(*(F.lower(F.trim(X.text_of(F.col(c)))) for c in ("doi", "paper_id", "title")))
    rows = included(df).withColumn("_own", F.when(own != "", own).otherwise(F.concat(F.lit("paper_"), F.col(ordinal).cast("string"))))
    rows = rows.withColumn("_w", F.row_number().over(Window.partitionBy("_own").orderBy(ordinal))).filter("_w = 1")
    rows = rows.filter(~is_review_candidate(F.col("title")) & ~is_not_primary(F.col("title")))
    # tokens are worked out once, in columns of their own
    rows = rows.withColumns({f"_{c}": tokens(F.col(c)) for c in ("title", "abstract", text)})
    n = {c: F.size(_shared(F.col(f"_{c}"), terms)) for c in ("title", "abstract", text)}
    rows = rows.withColumn("matches", n[text]).filter(F.col("matches") >= LEAST_TEXT_TOKENS)
    rows = rows.withColumn("score", 10 * n["title"] + 4 * n["abstract"] + F.col("matches"))
    return rows.orderBy(F.desc("matches"), F.desc("score"), ordinal).limit(most).select(*df.columns, "matches", "score")


def _primary(rows: DataFrame) -> DataFrame:
    """What ``exported`` gives, with ``_kind``: a review, a paper that isn't primary, or a primary one."""
    fields = {f.name: f.dataType.simpleString() for f in rows.schema["candidate"].dataType}
    kind = None
    if "raw_record" in fields:
        raw = F.col("candidate.raw_record")
        kind = F.try_variant_get(raw, "$.type", "string") if fields["raw_record"] == "variant" else F.get_json_object(raw.cast("string"), "$.type")
    title = F.col("candidate.title")
    return rows.withColumn("_kind", F.when(is_review_candidate(title, kind), "review").when(is_not_primary(title), "non_primary").otherwise("primary"))


def selected_for_calibration(candidates: DataFrame, screening: DataFrame, ordinal: str, most: int) -> DataFrame:
    """The first ``most`` included screening rows, by tier and rank, with their candidates, if they are primary papers.

    An included row without a candidate is an error; each row tells why it was chosen.
    """
    if most < 1:
        raise ValueError("most must be at least 1.")
    rows = _primary(exported(candidates, screening, ordinal)).filter("_kind = 'primary'").drop("_kind")
    said = [F.lit("Selected for collection-time contract calibration")]
    for c in ("title_relevance_tier", "source_rank", "screening_confidence"):
        if c in screening.columns:
            said.append(F.when(X.text_of(F.col(c)) != "", F.concat(F.lit(f"{c}="), F.col(c).cast("string"))))
    rows = rows.withColumn("calibration_selection_reason", F.concat_ws("; ", *said))
    return rows.orderBy(*_calibration_order(ordinal)).limit(most)


def _calibration_order(ordinal: str) -> list[Column]:
    return [X.safe_int(F.col("title_relevance_tier")), X.safe_int(F.col("source_rank")), F.col(ordinal)]


def calibration_counts(candidates: DataFrame, screening: DataFrame, ordinal: str, most: int) -> DataFrame:
    """selected, skipped_reviews, skipped_non_primary: what was passed over until ``most`` were chosen."""
    rows = _primary(exported(candidates, screening, ordinal)).select("_kind", F.struct(*_calibration_order(ordinal)).alias("o"))
    chosen = rows.filter("_kind = 'primary'").orderBy("o").limit(most).agg(F.count("*").alias("n"), F.max("o").alias("last"))
    # fewer than asked for: everything was looked at
    seen = rows.join(F.broadcast(chosen), (F.col("n") < most) | (F.col("o") <= F.col("last")))
    return seen.agg(F.count_if(F.col("_kind") == "primary").alias("selected"), F.count_if(F.col("_kind") == "review").alias("skipped_reviews"), F.count_if(F.col("_kind") == "non_primary").alias("skipped_non_primary"))


def review_seeds(df: DataFrame, contract: dict, this_year: int, most: int, ordinal: str) -> DataFrame:
    """The candidates of the best review scores, the first of equals, with their ``place`` from 1."""
    best = scored(df, contract, this_year).orderBy(F.desc("review_score"), ordinal).limit(most)
    return best.withColumn("place", F.row_number().over(Window.orderBy(F.desc("review_score"), ordinal)))
