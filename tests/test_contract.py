"""Contracts, planned queries, scores, eligibility, availability."""

import copy

import pytest
from biblion.operators import availability, matching, seeds
from biblion.operators.audit import Label
from biblion.plans import contract as C
from biblion.plans import ontology, retrieval, runs
from biblion.plans.catalogue import CONTRACT
from pyspark.sql import functions as F


def changed(*path, to):
    made = copy.deepcopy(CONTRACT)
    at = made
    for key in path[:-1]:
        at = at[key]
    at[path[-1]] = to
    return made


@pytest.mark.parametrize(
    ("path", "to"),
    [
        (("topic_id",), " "),
        (("scope",), []),
        (("scope", "boundary_rules"), None),
        (("rule_based_screening", "exclude_wins"), "yes"),
        (("rule_based_screening", "include_terms"), ["a", ""]),
        (("topic_structure", "main_topics"), CONTRACT["topic_structure"]["main_topics"][:1]),
        (("topic_structure", "main_topics", 0, "field"), "body"),
        (("topic_structure", "main_topics", 0, "retrieval_terms"), list("abcdefghijklm")),
        (("topic_structure", "anchor_topic_id"), "x"),
        (("topic_structure", "secondary_topics"), {"x": ["y"]}),
        (("topic_structure", "secondary_topics"), {"license": []}),
        (("topic_structure", "secondary_topics"), None),
        (("tagging", "categories"), {}),
        (("tagging", "categories", "lang", "values"), ["en", "en"]),
        (("tagging", "categories", "lang", "applies_when"), {"category_id": "lang", "values": ["en"]}),
        (("tagging", "categories", "lang", "selection"), "some"),
        (("collection", "preferred_provider"), "other"),
        (("collection", "search_queries"), [{"query": ""}]),
    ],
)
def test_a_problem_is_an_error(path, to):
    with pytest.raises(ValueError):
        C.checked(changed(*path, to=to))


def test_contract_parts():
    assert C.checked(CONTRACT) is CONTRACT
    assert C.screening(CONTRACT)["include_terms"] == ["rights", "thane", "rights reserved", "thanedble anea", "apache license", "version"]
    cats = {"knowledge_goal": {"values": ["a"]}, "x": {"values": ["p"], "applies_when": {"category_id": "knowledge_goal", "values": ["a"]}}, "y": {"values": ["q"], "required": True}}
    assert [(c.category_id, c.required) for c in C.tag_categories(changed("tagging", "categories", to=cats))] == [("y", True)]


def test_reviews():
    label = C.reviewed_label(Label("m"), ["a", "b", "c"], {"values": ["A", "a"], "merge_values": {"b": "New one"}, "drop_values": ["z"]})
    assert (label.allowed, label.mappings, label.dropped) == (("a", "new_one"), {"b": "new_one"}, ("c", "z"))
    cats = {"p": {"values": ["a", "b"]}, "q": {"values": ["c"], "applies_when": {"category_id": "p", "values": ["a", "b"]}}, "gone": {"values": ["d"]}}
    base = changed("tagging", to={"categories": cats, "fallback_policy": {"gone": "d", "missing_information_value": "unclear", "p": "b"}})
    merged, said = C.reviewed_contract(base, {"categories": {"P": ["a"], "q": {"values": "auto"}, "n": []}}, {"q": ["e"], "n": ["f"]})
    assert merged["tagging"]["categories"]["q"] == {"label": "q", "required": False, "selection": "multi", "applies_when": {"category_id": "p", "values": ["a"]}, "values": ["e"]}
    assert merged["tagging"]["fallback_policy"] == {"missing_information_value": "unclear"}
    assert set(said) == {"added n", "removed gone", "no fallback for gone", "no fallback for p"}
    assert base["tagging"]["categories"]["p"]["values"] == ["a", "b"]
    with pytest.raises(ValueError):
        C.reviewed_contract(base, {"categories": {}})


def test_query_groups():
    plan = retrieval.query_groups(CONTRACT, 10)
    assert [(g["group_id"], g["tier"], g["priority"], [q["query_id"] for q in g["queries"]]) for g in plan["query_groups"]] == [
        ("tier_0_title", 0, 0, ["tier_0_all_main_title"]),
        ("tier_0", 0, 1, ["tier_0_all_main"]),
        ("tier_1", 1, 2, ["tier_1_replace_license_with_license_secondary_1"]),
    ]
    last = plan["query_groups"][2]["queries"][0]
    assert last["query"] == '("rights reserved" OR "thanedble anea") AND (version)' and last["requires_title_screening"]
    assert retrieval.plain_queries("q", [{"terms": ["a", "b", "c"]}, {"terms": ["x", "y"]}])[2]["query"] == "c x"
    assert retrieval.query_groups({}) == {} and retrieval.review_queries(CONTRACT) == ["Thanea attion review overview"]
    many = {"anchor_topic_id": "a", "main_topics": [{"topic_id": t, "terms": [t]} for t in "abc"], "secondary_topics": [{"main_topic_id": t, "terms": [t + n]} for t in "bc" for n in "12"]}
    assert [len(g["queries"]) for g in retrieval.query_groups({"topic_structure": many})["query_groups"]] == [1, 4, 4]
    assert [g["secondary_topic_id"] for g in matching.secondary_groups(many)] == ["b_secondary_1", "b_secondary_2", "c_secondary_1", "c_secondary_2"]


def test_words_of_a_contract():
    assert seeds.specific_terms(CONTRACT) == ["thanea", "attion", "eriner", "anea", "license", "rights", "reserved", "thanedble", "apache", "version"]
    assert "rights reserved" in seeds.phrases(CONTRACT) and "of the" not in seeds.phrases(CONTRACT)


def test_scores_of_nulls_and_no_rows(spark):
    schema = "title string, abstract string, venue string, cited_by_count int, year int"
    got = seeds.scored(spark.createDataFrame([(None,) * 5], schema), CONTRACT, 2025).first()
    assert (got.review_score, got.citation_rate, got.on_topic) == (-120.0, 0.0, False)
    assert seeds.scored(spark.createDataFrame([], schema), CONTRACT, 2025).count() == 0
    rows = spark.createDataFrame([("Rights reserved", None), ("Rights reserved", "rights"), (None, "rights version"), ("rights", "nothing")], "title string, text string")
    assert [r.why for r in seeds.eligible(rows, CONTRACT).collect()] == ["no_text", "", "title_off_topic", "title_off_topic"]
    assert all(r.eligible for r in seeds.eligible(rows.filter("text IS NOT NULL"), {}).collect())


def test_availability(spark):
    def request():
        def ask(method, url):
            if url == "http://head-fails" and method == "HEAD" or url == "http://down":
                raise OSError("refused")
            return (404 if url == "http://gone" else 200), "application/pdf", url + "/final"

        return ask

    def at(*urls):
        return [("s", u, "pdf", "cc", "yes") for u in urls]

    found = [("1", at("http://gone", "http://head-fails")), ("2", at("http://gone", "http://down")), ("3", []), ("4", None), ("5", at("", "http://fine"))]
    made = spark.createDataFrame([(n, "", i, x) for n, (i, x) in enumerate(found)], f"o int, doi string, provider_id string, full_text_locations {availability.LOCATIONS}")
    rows = spark.createDataFrame([(n, str(n), "", str(n), "exclude" if n == 7 else "include") for n in range(1, 8)], "o int, paper_id string, doi string, provider_id string, screening_decision string")
    check = availability.url_check(request)
    got = availability.verified(made, rows, "o", check).orderBy("o").collect()
    assert [r.full_text_availability_status for r in got] == ["verified", "unverified", "not_available", "not_available", "verified", "candidate_missing", "skipped_not_included"]
    assert (got[0].full_text_url, got[1].full_text_url, got[4].full_text_url) == ("http://head-fails/final", "http://gone", "http://fine/final")
    assert got[1].full_text_availability_error == "HEAD: OSError: refused | GET: OSError: refused"
    again = availability.verified(made, rows, "o", check, availability.verified(made, rows, "o", check).withColumn("full_text_url", F.lit("old"))).orderBy("o").collect()
    assert [r.full_text_url for r in again] == ["old"] * 6 + [""]


def test_weak_categories():
    cats = {
        "Study Type": {"values": ["cohort", "survey"]},
        "study_design": {"values": ["cohort", "other"]},
        "paper_type": {"values": ["method", "tool", "x"], "applies_when": {"category_id": "dimension", "values": ["method", "y"]}},
        "fine": {"values": ["a_b", "c"]},
        "odd": {"values": ["A b", "c", "unclear"]},
        "none": {"values": ["unknown"]},
    }
    found = [(i.code, i.category_id, i.values) for i in ontology.issues(changed("tagging", "categories", to=cats))]
    assert found == [
        ("non_snake_category_id", "Study Type", ()),
        ("boilerplate_category_id", "Study Type", ()),
        ("boilerplate_category_id", "study_design", ()),
        ("too_few_values", "study_design", ("cohort",)),
        ("catchall_values", "study_design", ("other",)),
        ("meta_category_id", "paper_type", ()),
        ("meta_values", "paper_type", ("method", "tool")),
        ("meta_dependency", "paper_type", ("dimension",)),
        ("broad_dependency_values", "paper_type", ("method",)),
        ("catchall_values", "odd", ("unclear",)),
        ("non_snake_values", "odd", ("A b",)),
        ("too_few_values", "none", ()),
        ("catchall_values", "none", ("unknown",)),
    ]
    assert ontology.issues(CONTRACT)[0].code == "too_few_categories"
    assert [i.code for i in ontology.warnings(changed("tagging", "categories", to=cats))] == ["boilerplate_category_id", "boilerplate_values"] * 2


def test_labels_of_a_review():
    told = {"Topics": {"values_from": "topic_structure.main_topics", "required": True}, "m": {"values": ["A", "a", "b c"]}, "n": {"values": "auto", "selection": "single"}, "q": {"value_mode": "evidence_quote"}}
    got = C.review_labels({**CONTRACT, "review": {"labels": told}})
    assert [(x.label_id, x.mode, x.allowed, x.selection, x.required) for x in got] == [("topics", "controlled_fixed", ("rights", "license"), "multi", True), ("m", "controlled_fixed", ("a", "b_c"), "multi", False), ("n", "controlled_auto", (), "single", False), ("q", "evidence_quote", (), "multi", False)]
    for bad in ({"value_mode": "other"}, {"value_mode": "controlled_fixed"}, {"max_words_per_item": 0}, {"values": "x"}):
        with pytest.raises(ValueError):
            C.review_labels({**CONTRACT, "review": {"labels": {"x": bad}}})


def test_plans():
    assert runs.main_plan() == runs.MAIN
    full = runs.main_plan(True, True, write_review=True, review_values=True)
    assert full[:9] == ["normalize", "screen_scope", "full_text", "filter_reviews", "calibrate_contract", "review_categories", "tagging_config", "tagging_rules", "review_config"]
    assert full[-9:] == ["export", "label_values", "review_values", *runs.REVIEW[1:]]
    assert runs.main_plan(extract_labels=True)[-1] == "export"
    assert runs.collection_plan(True)[4] == "plan_search"
