"""Sources, sets, tags, drafts and rounds: cases that the queries don't reach."""

import json

import pytest
from biblion.operators import audit, model, sets, tagging
from biblion.operators.audit import Category, Label
from biblion.plans import contract as contracts
from biblion.plans import drafting, runs, structure
from biblion.plans.catalogue import CONTRACT
from biblion.sources import files, fulltext, provider, tiers, works, yaml_lines
from pyspark.sql import functions as F


def test_yaml():
    text = """# top
a: 1
b:
  - x
  - "y: z"  # told
  - k: v
    l: [1, 2.5, 'it''s']
  -
    - n
c:
- p
d: |
  one
    two

  three
e: >-
  fold
  this
f: {a: b, c: [d]}
g: yes
h:
i: http://x.org/a#b
j: plain text
  goes on
"""
    assert yaml_lines.parsed(text) == {"a": 1, "b": ["x", "y: z", {"k": "v", "l": [1, 2.5, "it's"]}, ["n"]], "c": ["p"], "d": "one\n  two\n\nthree\n", "e": "fold this", "f": {"a": "b", "c": ["d"]}, "g": True, "h": None, "i": "http://x.org/a#b", "j": "plain text goes on"}
    assert yaml_lines.parsed("") is None and yaml_lines.parsed("- 1\n- -2") == [1, -2]
    for wrong in ("a: 1\na: 2", "a: &x 1", "a: [1, 2", "a: 1\n b: 2\nc"):
        with pytest.raises(ValueError):
            yaml_lines.parsed(wrong)


def test_objects(tmp_path):
    value = {"a": [1, {"b": "x: #y", "c": []}, [["z"]]], "t": "line\nbreak", "n": None, "e": {}, "f": 1.5, "yes": "no"}
    for name in ("a.yaml", "a.json"):
        files.write_object(value, str(tmp_path / name))
        assert files.read_object(str(tmp_path / name)) == value
    (tmp_path / "b.yaml").write_text("- 1")
    with pytest.raises(ValueError):
        files.read_object(str(tmp_path / "b.yaml"))


def test_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("paper_id,text\n1,x\n")
    with pytest.raises(ValueError, match="title"):
        files.read_csv(spark, str(tmp_path / "a.csv"), required=["title"])
    assert files.read_csv(spark, str(tmp_path / "a.csv"), ["text"], row_number="n").collect()[0] == ("x", 1)
    (tmp_path / "b.csv").write_text("")
    with pytest.raises(ValueError, match="header"):
        files.read_csv(spark, str(tmp_path / "b.csv"))


def test_pushed_filters(spark):
    spark.dataSource.register(provider.Provider)
    asked = []

    class Client:
        def page(self, query, page, per_page):
            return [{"id": "1", "publication_year": 2000}, {"id": "2", "publication_year": 2010}] if page == 1 else []

    provider.PROVIDERS["fixed"] = lambda options: asked.append(options) or Client()
    reader = provider.PushingReader({"queries": "[\"q\"]", "provider": "fixed"})
    year = lambda kind, value: type(kind, (), {"attribute": ("year",), "value": value})()
    assert len(list(reader.pushFilters([year("GreaterThanOrEqual", 2001), year("LessThan", 2011), year("Other", 1)]))) == 3
    assert len(list(reader.read(reader.partitions()[0]))) == 2
    assert json.loads(asked[0]["plan"])["filters"] == {"year_from": 2001, "year_to": 2010}
    with pytest.raises(ValueError, match="no provider"):
        provider.client_of({"provider": "other"})
    with pytest.raises(ValueError):
        provider.client_of({})


def test_service_errors():
    with pytest.raises(ValueError):
        provider.Service("https://x.org").url("", 1, 10)
    asked = {"filters": {"year_from": 2000, "year_to": 2001, "language": "en", "has_abstract": False, "has_pdf_url": True, "publication_types": ["review"]}}
    assert provider.service_filters(asked) == ["from_publication_date:2000-01-01", "to_publication_date:2001-12-31", "language:en", "has_abstract:false", "has_pdf_url:true", "type:review"]


PAGES = {"x": [{"id": f"X{i}", "display_name": f"T{i}"} for i in range(6)], "y": [{"id": f"Y{i}", "display_name": f"U{i}"} for i in range(6)]}


def test_a_full_share_ends_a_page():
    plan = {"iterations_per_group": 3, "query_groups": [{"tier": 0, "queries": [{"query_id": "x", "query": "x"}, {"query_id": "y", "query": "y"}]}]}
    told = tiers.fetch(provider.Recorded(PAGES), plan, 3, per_page=4)
    # two of each are asked for; the rest of a page isn't asked for again
    assert [(r["provider_id"], r["query_rank"]) for r in told.found] == [("X0", 1), ("X1", 2), ("Y0", 1)] and not told.exhausted
    assert tiers.fetch(provider.Recorded(PAGES), {}, 3).found == []
    fallback = {"query_groups": [{"tier": 0, "queries": [{"query_id": "q", "query": "(x) AND (y)", "fallback_queries": [{"query_id": "q_1", "query": "x", "logical_query_id": "q"}]}]}]}
    rows = tiers.fetch(provider.Recorded(PAGES), fallback, 2, blocks=False).found
    assert [(r["retrieval_query_id"], r["retrieval_logical_query_id"]) for r in rows] == [("q_1", "q")] * 2


def test_works_without_parts(spark):
    df = spark.sql("SELECT parse_json(j) AS work FROM VALUES ('{}'), ('{\"open_access\": null, \"locations\": [1, {\"pdf_url\": 5}], \"authorships\": \"x\"}') AS t(j)")
    assert [r[0] for r in df.select(works.work_locations(F.col("work"), "p")).collect()] == [[], []]
    assert [(r.title, r.abstract, r.authors, r.cited_by_count) for r in works.work_cells(df).collect()] == [("", "", "", 0)] * 2


def test_evidence(spark):
    one = lambda text, most=24_000: spark.createDataFrame([(text,)], "t string").select(fulltext.text_evidence(F.col("t"), most)).first()[0]
    assert one(None) == one(" \n") == ""
    assert one("just words") == "[Body]\njust words"
    text = "lead\n1. Introduction\nwe start\nConclusion\nwe end here"
    assert one(text) == "[Conclusion]\nwe end here\n\n[1. Introduction]\nwe start\n\n[Body]\nlead"
    assert one(text, 20) == "[Conclusion]\nwe end" and one(text, 30) == "[Conclusion]\nwe end here\n\n[1." and one(text, 25) == "[Conclusion]\nwe end here"
    # a text of headings alone has no sections: the whole of it
    assert one("Methods\nResults") == "[Full text]\nMethods Results"


def test_sets(spark):
    a, b = spark.createDataFrame([(2, "x"), (1, None), (3, None)], "i int, k string"), spark.createDataFrame([(1, "x"), (5, "y")], "i int, k string")
    assert sorted(map(tuple, sets.union_distinct([a, b], "k", "i").select("i", "k").collect()), key=str) == [(1, None), (2, "x"), (5, "y")]
    assert [tuple(r) for r in sets.difference(a, b, "k").collect()] == [(None,)] and [tuple(r) for r in sets.intersection(a, b, "k").collect()] == [("x",)]
    scores = spark.createDataFrame([("p", 1, None), ("p", 2, 5), ("p", 3, 5), ("q", 4, None)], "k string, i int, s int")
    assert sorted(tuple(r) for r in sets.best_of(scores, ["k"], "s", "i").collect()) == [("p", 2, 5), ("q", 4, None)]
    with pytest.raises(ValueError):
        sets.union_all([], "i")
    with pytest.raises(ValueError):
        sets.head(a, 0, "i")


def test_tagging_failures(spark):
    rows = spark.createDataFrame([("1", "t"), ("2", "t"), ("3", "t")], "paper_id string, title string")
    answers = {"1": "not json", "2": json.dumps({"main_knowledge_claim": "c", "a": []}), "3": json.dumps({"main_knowledge_claim": "c", "a": "x"})}
    good, bad = tagging.tagged(rows, [Category("a", ["x"], required=True)], "$paper_id", lambda: model.Static(lambda p: answers[p]), prompt=["paper_id"])
    assert [(r.paper_id, r.a) for r in good.collect()] == [("3", "x")]
    told = {r.paper_id: r.error for r in bad.collect()}
    assert told["1"].startswith("invalid json") and told["2"] == "required category a is empty"


def test_packets(spark):
    text = "Introduction\nintro\nMethods\nwe ask\nConclusion\nend"
    df = spark.createDataFrame([(text,)], "t string").select(fulltext.prioritized(fulltext.split_sections(F.col("t")), F.col("t")).alias("s"))
    told = lambda most: df.select(tagging.packet(F.col("s"), ["methods"], most)).first()[0]
    assert told(100) == "[Methods]\nwe ask\n\n[Conclusion]\nend\n\n[Introduction]\nintro" and told(18) == "[Methods]\nwe ask"
    labels = [Label("q", "evidence_quote"), Label("m", "controlled_auto")]
    flat = tagging.flat_labels(spark.sql("SELECT '1' AS paper_id, map('m', array('a', 'b')) AS values, map('q', array(named_struct('quote', 'x', 'section', 's', 'reason', ''))) AS quotes"), labels).first()
    assert (flat.m, json.loads(flat.q)[0]["quote"], flat.year) == ("a; b", "x", "")


def test_rules():
    cats = [Category("a", ["x"])]
    with pytest.raises(KeyError):
        tagging.rules_by_category([], cats)
    with pytest.raises(ValueError):
        tagging.generated_rules(cats, "$categories", model.Static(lambda p: "[]"))


def test_drafts_are_checked():
    with pytest.raises(ValueError):
        drafting.refined_contract(CONTRACT, {"collection": {}})
    with pytest.raises(ValueError):
        drafting.calibrated_contract(CONTRACT, {"tagging": {"categories": {"other": {"values": ["a"]}}}})
    with pytest.raises(ValueError):
        drafting.completed_values({"categories": [{"category_id": "a", "values": ["x"]}]}, ["a"])
    assert drafting.calibration(CONTRACT, [], "", None) is CONTRACT
    # weak categories are warnings after the last attempt; an invalid contract is an error
    weak = {"tagging": {"categories": {"lang": {"values": ["en"]}}, "fallback_policy": {}}}
    made, said = drafting.drafted_contract("t", CONTRACT, "$topic $feedback", model.Static(lambda p: json.dumps(weak)))
    assert contracts.checked(made) and "too_few" in said[0]
    with pytest.raises(ValueError):
        drafting.drafted_contract("t", CONTRACT, "$topic", model.Static(lambda p: json.dumps({"tagging": {}})))
    with pytest.raises(ValueError):
        drafting.search_plan(CONTRACT, "$topic", model.Static(lambda p: json.dumps({"recommended_provider": "x", "provider_specific_plan": {}})))


def test_sections_are_checked():
    section = {"section_id": "s", "paper_ids": ["a_long_paper_id_2020"], "section_type": "abstract"}
    for answer in ({"section_id": "x"}, {"section_id": "s", "cited_paper_ids": ["unknown"]}, {"section_id": "s", "cited_paper_ids": ["a_long_paper_id_2020"]}, {"section_id": "s", "body_markdown": "As Doe (2020) says."}, {"section_id": "s", "body_markdown": "- a list"}):
        with pytest.raises(ValueError):
            drafting.checked_section(section, answer)
    assert drafting.checked_section(section, {"section_id": "s", "body_markdown": "Plain."})["heading_level"] == 1
    papers = [{"paper_id": "p", "label": "Doe", "year": "2020", "title": "T", "authors": "Doe, J", "doi": "10.1/x"}]
    text = drafting.assembled("R", [{"section_id": "s", "label": "S", "body_markdown": "So (Do, 2020).", "cited_paper_ids": ["p"]}], papers)
    assert "So (Doe, 2020)." in text and "10.1/x" in text


def test_settings(tmp_path):
    s = runs.Settings("c", str(tmp_path))
    assert s.path("/abs") == "/abs" and s.path("a/b.txt", make=True).endswith("a/b.txt") and (tmp_path / "a").is_dir()
    assert len(s.run_id) == 25


def test_missing_and_invalid_values(spark):
    df = spark.createDataFrame([("x; z", ""), ("z", "")], "a string, b string")
    got = {(r.field, r["value"], r.issue, r.severity, r.detail) for r in audit.missingness_issues(df, [Label("a", "controlled_fixed", ["x"]), Label("b", "free_text")]).collect()}
    assert got == {("a", "z", "observed_invalid_value_summary", "error", "count=2"), ("b", "", "high_missingness", "warning", "2_of_2_rows_empty")}


def test_descriptions():
    assert structure.pairs("memory and attention in the aging and in the young") == [("memory", "attention"), ("aging", "young")]
    assert structure.replaced("a substitute for the cement paste, instead of steel") == ["cement", "steel"]
    assert [k for k, _ in structure.uses("Use in building materials and school lessons")] == ["building_materials", "school_lessons"]
    assert structure.sources("Can green algae be used to feed fish?") == [{"algae"}]
    assert structure.words("Educational AI uses of buses") == {"educational", "education", "ai", "uses", "use", "buses", "buse"} and structure.words(None) == set()


def test_weak_structures():
    def made(*topics, anchor="a", secondary=None):
        return {"topic_structure": {"anchor_topic_id": anchor, "main_topics": list(topics), "secondary_topics": secondary or {}}}

    buried = made({"topic_id": "cognitive_function", "terms": ["memory", "attention"]})
    assert ("explicit_pair_buried_in_umbrella_topic", "cognitive_function", "memory and attention") in [(i.code, i.topic_id, i.value) for i in structure.issues(buried, "memory and attention")]
    criterion = structure.issues(made({"topic_id": "sustainability", "terms": ["x"]}), "sustainability of materials")
    assert "criterion_topic_instead_of_comparator" in [i.code for i in criterion]
    targets = [(i.code, i.value) for i in structure.issues(made({"topic_id": "a", "terms": ["x"]}), "replace cement in building products")]
    assert ("replacement_target_not_main_topic", "cement") in targets and ("replacement_application_not_main_topic", "building_products") in targets
    fields = made({"topic_id": "a", "terms": ["x"]}, {"topic_id": "school", "field": "abstract", "terms": ["schools for x"]}, secondary={"a": ["y"], "school": ["z"]})
    assert [i.code for i in structure.issues(fields)] == ["abstract_only_main_topic_field", "context_topic_field_not_title"]
    overlap = made({"topic_id": "a", "terms": ["x"]}, secondary={"a": ["X"]})
    assert [i.code for i in structure.issues(overlap)] == ["parent_secondary_term_overlap"]
    crossed = made({"topic_id": "alpha", "terms": ["x"]}, {"topic_id": "beta", "terms": ["beta in alpha"]}, anchor="alpha", secondary={"alpha": ["y"], "beta": ["z"]})
    assert [i.code for i in structure.issues(crossed)] == ["cross_topic_term"]
    with pytest.raises(ValueError):
        structure.checked(overlap)
    fine = made({"topic_id": "alpha", "terms": ["x"]}, anchor="alpha", secondary={"alpha": ["y"]})
    assert structure.checked(fine) is fine
