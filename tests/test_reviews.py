"""Review labels, evidence, papers made of candidates."""

import pytest
from biblion.operators import documents, papers, reviews
from biblion.operators.audit import Label
from pyspark.sql import functions as F

LABELS = [Label("m", allowed=["a", "b"], mappings={"c": "a"}, dropped=["d"]), Label("f", "controlled_fixed", allowed=["x"], selection="single", required=True), Label("q", "evidence_quote"), Label("t", "free_text")]
SCHEMA = "paper_id string, title string, year string, doi string, authors string, venue string, m string, f string, q string, t string"
FULL = ("T", "2020", "d", "A; B", "V")


def found(df):
    return sorted((r.paper_id, r.field, r.value, r.issue, r.severity, r.detail) for r in reviews.issues(df, LABELS).collect())


def test_issues(spark):
    good = '[{"quote": "x", "section": "s"}]'
    rows = [
        ("1", *FULL, "A; c; d; e", "x", good, "text"),
        ("2", *FULL, "a", "x; y", '["n", {"quote": " "}]', ""),
        ("3", *FULL, "b", "", "{}", ""),
        ("4", *FULL, "b", "x", "[", ""),
        (None, None, "", None, None, "", None, "x", None, None),
        ("4", *FULL, "b", "x", "", "unclear"),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(df) == sorted(
        [
            ("1", "m", "c", "review_value_mapped", "warning", "mapped_to=a"),
            ("1", "m", "d", "review_value_dropped", "warning", "dropped_by_review"),
            ("1", "m", "e", "invalid_review_value", "warning", "ignored_for_controlled_auto_label"),
            ("2", "f", "y", "invalid_review_value", "error", ""),
            ("2", "f", "x; y", "single_selection_has_multiple_values", "error", ""),
            ("2", "q", "n", "quote_item_not_object", "error", "quote_index=1"),
            ("2", "q", "", "quote_missing_text", "error", ""),
            ("2", "q", "", "quote_missing_section", "warning", ""),
            ("3", "f", "", "required_review_label_missing", "error", ""),
            ("3", "q", "{}", "quote_json_not_list", "error", ""),
            ("4", "q", "[", "malformed_quote_json", "error", ""),
            ("4", "paper_id", "4", "duplicate_paper_id", "error", ""),
            *(("", c, "", "required_metadata_missing", "error", "") for c in ("paper_id", "title", "year", "doi")),
            *(("", c, "", "recommended_metadata_missing", "warning", "") for c in ("authors", "venue")),
            ("", "t", "", "high_missingness", "warning", "4_of_6_rows_empty"),
        ]
    )
    issues = reviews.issues(df, LABELS)
    assert {r.paper_id for r in reviews.problem_papers(issues, LABELS).collect()} == {"2", "3", "4"}
    got = {r.label_id: (r["values"], len(r.quotes)) for r in reviews.evidence(df, issues, LABELS).collect()}
    assert got == {"m": (["a"], 0), "f": (["x"], 0), "q": ([], 1), "t": (["text"], 0)}
    assert found(df.limit(0)) == []


def test_hierarchy(spark):
    counts = spark.createDataFrame([("ml",), ("svm",), ("svm",), ("dl",)], "value string")
    assert [tuple(r) for r in reviews.hierarchy(counts, {"ml": ["svm", "rf"], "ai": ["dl"]}).collect()] == [("ml", "svm")]


def test_finalized(spark):
    screening = spark.createDataFrame([(1, "d1", "", "review", "pending_llm_full_text"), (2, "d2", "", "review", "pending_llm_full_text"), (3, "d3", "", "include", "screened")], "o int, doi string, provider_id string, screening_decision string, screening_status string")
    candidates = spark.createDataFrame([(1, "D1", "", "t"), (2, "d2", "", "u"), (3, "d3", "", "v")], "o int, doi string, provider_id string, title string")
    available = spark.createDataFrame([("d1", "", "verified"), ("d2", "", "unverified"), ("d3", "", "verified")], "doi string, provider_id string, full_text_availability_status string")
    seen = []

    def decide(df):
        seen.extend(r.title for r in df.collect())
        return df.select("o", F.lit("exclude").alias("screening_decision"))

    got = reviews.finalized(screening, candidates, available, "o", decide).orderBy("o").collect()
    assert [(r.screening_decision, r.screening_status) for r in got] == [("exclude", "llm_screened"), ("review", "pending_llm_full_text"), ("include", "screened")]
    assert seen == ["t"]


def test_canonical_and_places(spark):
    rows = spark.createDataFrame([("p", "S", "1999", "x", "why", ("", 2001, "prov", "i", 3, "q"))], "paper_id string, title string, year string, doi string, screening_reason string, candidate struct<title:string,year:int,provider:string,provider_id:string,rank:int,query:string>")
    r = papers.canonical(rows, ["screening_reason"]).first()
    assert (r.title, r.year, r.doi, r.source, r.abstract) == ("S", "2001", "x", "collected:prov", "")
    assert r.notes == "provider=prov; provider_id=i; source_rank=3; retrieval_date=; screening_reason=why; source_query=q"
    df = spark.createDataFrame([("a", "b", "c", None), ("a", "a", "", ""), (None, None, None, None), ("a", "b", "c", "u")], "x string, y string, z string, url string")
    got = papers.full_text_places(df, [F.col("x"), F.col("y"), F.col("z")], F.col("url")).collect()
    assert [(g.full_text_url, g.pdf_url, g.url) for g in got] == [("a", "b", "c"), ("a", "", "a"), ("", "", ""), ("a", "b", "u")]


def test_edited_sections(spark):
    drafts = spark.createDataFrame([("a",), ("b",)], "section_id string")
    edited = spark.createDataFrame([("b", "B"), ("a", None)], "section_id string, text string")
    assert sorted(tuple(r) for r in documents.edited_sections(drafts, edited).collect()) == [("a", None), ("b", "B")]
    for wrong in (edited.limit(1), edited.unionByName(spark.createDataFrame([("c", "C")], "section_id string, text string"))):
        with pytest.raises(Exception, match="lost or added"):
            documents.edited_sections(drafts, wrong).collect()
