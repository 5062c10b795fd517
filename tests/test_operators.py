import json

import pytest
from biblion.operators import audit, fuzzy, matching, model, papers, state
from biblion.operators.audit import Category, Label
from biblion.operators.matching import Topic, TopicSpec
from biblion.sources import bibliographic, files, fulltext, provider
from pyspark.sql import functions as F


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_normalized(spark):
    df = spark.createDataFrame([(1, "", " A  Title, of the: best kind ever ", "2021-05", "doi:10.1/X", "text", None), (2, "own", "", "", "", "", "x.pdf")], "n int, paper_id string, title string, year string, doi string, abstract string, full_text_path string")
    a, b = papers.normalized(df, "n").orderBy("n").collect()
    assert (a.paper_id, a.title, a.year, a.doi, a.full_text_available, a.metadata_notes) == ("a_title_of_the_best_kind_2021", "A Title, of the: best kind ever", "2021", "10.1/X", "no", "missing_full_text_path")
    assert (b.paper_id, b.abstract_available, b.full_text_available, b.metadata_notes) == ("own", "no", "yes", "missing_title; missing_year; missing_abstract")
    with pytest.raises(ValueError):
        papers.normalized(df.drop("doi"), "n")


def test_scope(spark):
    df = spark.createDataFrame([(1, "Heat in cities", "uhi"), (2, "Urban heat islands", "veterinary"), (3, "Other", ""), (4, "Veterinary", "x")], "n int, title string, abstract string")
    wins = papers.scoped(df, ["urban heat island"], ["veterinary"])
    assert [r.scope_decision for r in wins.orderBy("n").collect()] == ["include", "exclude_or_route_elsewhere", "include", "exclude_or_route_elsewhere"]
    soft = papers.scoped(df, ["urban heat island"], ["veterinary"], exclude_wins=False)
    assert [r.scope_decision for r in soft.orderBy("n").collect()] == ["include", "include", "include", "exclude_or_route_elsewhere"]
    assert wins.filter("n = 1").first().scope_matched_include_terms == "urban heat island"


def test_deduplicated_merges(spark):
    df = spark.createDataFrame([(1, "k", "", "3", [("u1", "a")]), (2, "k", "abs", "9", [("u2", "b"), ("u1", "c")]), (3, "k", "abs", "x", []), (4, "z", "", None, [])], "o int, k string, abstract string, rank string, places array<struct<url:string,kind:string>>")
    out = papers.deduplicated(df, F.col("k"), F.col("abstract") != "", F.col("rank"), "o", ["o"], "places").orderBy("o").collect()
    assert [(r.o, r.duplicate_count, [p.o for p in r.duplicate_provenance]) for r in out] == [(2, 3, [2, 3, 1]), (4, 1, [4])]
    assert [tuple(p) for p in out[0].places] == [("u2", "b"), ("u1", "c")]


def test_deduplicated_by_ranks_beyond_32_bits(spark):
    ranks = ["4000000000", "3000000000", "1500000", "x", None]
    df = spark.createDataFrame([(n, "k", r) for n, r in enumerate(ranks)], "o int, k string, rank string")
    out = papers.deduplicated(df, F.col("k"), F.lit(True), F.col("rank"), "o", ["o"]).first()
    # a rank that is no number is 999,999
    assert (out.o, out.duplicate_count, [p.o for p in out.duplicate_provenance]) == (3, 5, [3, 4, 2, 1, 0])


def test_export_joins(spark):
    cands = spark.createDataFrame([(1, "10.1/A", "p1", "old"), (2, "10.1/a ", "p1", "new"), (3, "", "p2", "c")], "ordinal int, doi string, provider_id string, title string")
    screen = spark.createDataFrame([(1, "10.1/a", "p1", "include", "1", "5"), (2, "", "p2", "include", "0", "x"), (3, "", "p9", "exclude", "", "")], "ordinal int, doi string, provider_id string, screening_decision string, title_relevance_tier string, source_rank string")
    got = papers.exported(cands, screen, "ordinal").collect()
    assert [(r.candidate.title, r.key_id) for r in got] == [("c", "p2"), ("new", "p1")]
    assert len(papers.exported(cands, screen, "ordinal", limit=0).collect()) == 1
    lost = screen.withColumn("screening_decision", F.lit("include"))
    with pytest.raises(Exception, match="no candidate"):
        papers.exported(cands, lost, "ordinal").collect()
    av = spark.createDataFrame([(1, "10.1/a", "p1", "verified")], "ordinal int, doi string, provider_id string, full_text_availability_status string")
    assert [r.candidate.title for r in papers.exported(cands, screen, "ordinal", None, av, True).collect()] == ["new"]


SPEC = TopicSpec([Topic("a", ["heat"]), Topic("b", ["city"], "title"), Topic("b", ["town"], "abstract", "secondary", "g")], "a")


def test_matching_and_cascade(spark):
    df = spark.createDataFrame([(1, "Heat in Cities", ""), (2, "Heat", "a town"), (3, "Heat", ""), (4, "City", "town")], "n int, title string, abstract string")
    m = matching.matched(df, SPEC)
    assert [r.local_relevance_tier for r in m.orderBy("n").collect()] == [0, 1, 999, 999]
    assert rows(matching.matches_long(m, "n").select("n", "topic_id", "field"), "n", "topic_id", "field")[:3] == [(1, "a", "title"), (1, "b", "title"), (2, "a", "title")]
    c = matching.cascade(m, SPEC, F.col("n") > 1, F.lit(0)).orderBy("n").collect()
    assert [(r.screening_rule, r.screening_decision) for r in c] == [("tier0_title", "include"), ("local_include", "include"), ("needs_llm", "pending"), ("anchor_missing", "exclude")]
    spec = matching.spec_of({"topic_structure": {"anchor_topic_id": "a", "main_topics": [{"topic_id": "a", "terms": ["x", "X"]}], "secondary_topics": [{"main_topic_id": "a", "terms": ["y"]}]}})
    assert [(t.topic_id, list(t.terms), t.kind, t.group_id) for t in spec.topics] == [("a", ["x"], "main", ""), ("a", ["y"], "secondary", "a_secondary_1")]


def test_audits(spark):
    cats = [Category("c", ["x", "y"], "single", True), Category("d", ["p", "q"], parent="c", triggers=["x"])]
    df = spark.createDataFrame([(1, "x; y", ""), (2, "", "p"), (3, "z", "")] + [(n, "x", "p") for n in range(4, 14)], "n int, c string, d string")
    assert rows(audit.row_issues(df, "n", cats), "n", "field", "issue") == [(1, "c", "x; y", "single_selection_has_multiple_values"), (2, "c", "", "required_missing"), (2, "d", "p", "inapplicable_category_has_value"), (3, "c", "z", "invalid_value")]
    dist = rows(audit.distribution_issues(df, cats).select("field", "value", "count", "applicable_rows"), "field", "value")
    assert dist == [("d", "p", 10, 11), ("d", "q", 0, 11)]
    assert audit.distribution_issues(df.limit(4), cats).collect() == []
    assert rows(audit.missingness(df, ["c", "d"]), "field") == []
    assert rows(audit.missingness(df.filter("n < 4"), ["c", "d"]), "field") == [("d", 2, 3)]


def test_labels(spark):
    df = spark.createDataFrame([(1, "Survey methods; surveys method"), (2, "unclear"), (3, "")], "n int, m string")
    counts = rows(audit.value_counts(df, [Label("m")]), "value")
    assert ("m", "survey_method", "valid", 1) in counts
    label = Label("m", mappings={"unclear": "other"}, allowed=["other"])
    assert rows(audit.coverage(df, [label]), "label_id") == [("m", 1, 3, 0.3333)]
    r = audit.report(20, 19, 18, 18, 18, 17)
    assert (r["status"], r["target_cited"]) == ("warning", 18) and audit.report(1, 1, 1, 1, 1, 0)["status"] == "critical"
    assert audit.report(50, 50, 45, 45, 45, 45)["target_cited"] == 40


def test_state(spark):
    df = spark.createDataFrame([("q", 7, [("q", 12), ("r", 3)]), ("r", 1, [])], "query string, rank int, prov array<struct<query:string,rank:int>>")
    assert rows(state.resume_state(df, "query", "rank", 5, "prov"), "query") == [("q", 12, 3, 2), ("r", 3, 1, 3)]
    ids = spark.range(0, 50)
    assert {(r.id, r["rank"]) for r in state.ranked(ids, [F.col("id")], after=10).collect()} == {(i, i + 11) for i in range(50)}
    new, done = spark.createDataFrame([(1,), (2,), (3,)], "k int"), spark.createDataFrame([(1, "ok"), (2, "skipped"), (9, "ok")], "k int, s string")
    got = state.reused(new, done, ["k"], lambda d: d.withColumn("s", F.lit("new")), F.col("s") == "skipped")
    assert rows(got, "k") == [(1, "ok"), (2, "new"), (3, "new")]
    fetched = {1: [(1, 1), (2, 2)], 2: [(2, 3), (3, 4)], 3: [(3, 5)]}
    frame = lambda r: spark.createDataFrame(r, "k int, o int")
    out, why = state.topped_up(frame([(0, 0)]), lambda n: frame(fetched[n]), lambda d: d.count() >= 9, "k", "o", lambda d, n: d)
    assert why == "nothing_new" and {r.k for r in out.collect()} == {0, 1, 2, 3}


def test_importers(spark, tmp_path):
    bib = '@comment{x}\n@article{Key One, title = {A {Nested} \\& Title}, author = "Doe, J and Roe, R", year = 2020, month = jan # " 1", file = {:/p/a.pdf:PDF}}\n@book{Key One, title={B}}\n'
    got = bibliographic.bibtex_rows(bib)
    assert [(r["paper_id"], r["title"], r["authors"], r["year"]) for r in got] == [("key_one", "A Nested & Title", "Doe, J; Roe, R", "2020"), ("key_one_2", "B", "", "")]
    more = bibliographic.bibtex_rows('@article{Doe-2021_x, title = "a } {b, c", year = 2021, file = {Full:/p/A.PDF:application/pdf}, journaltitle={J -- K}}')[0]
    assert (more["paper_id"], more["title"], more["full_text_path"], more["venue"], more["source"]) == ("doe-2021_x", "a b, c", "/p/A.PDF", "J - K", "bibtex:article")
    for wrong in ("@article{x, title}", "@ nothing", '@article{x, title="open}'):
        with pytest.raises(ValueError):
            bibliographic.bibtex_rows(wrong)
    with pytest.raises(ValueError):
        bibliographic.bibtex_rows("@article{x, title={open}")
    ris = "TY  - JOUR\nTI  - A long\n title\nAU  - Doe, J\nAU  - Roe, R\nPY  - 2019/01\nDO  - doi:10.1/x\nER  - \n"
    assert [(r["title"], r["authors"], r["year"], r["doi"]) for r in bibliographic.ris_rows(ris)] == [("A long title", "Doe, J; Roe, R", "2019", "10.1/x")]
    (tmp_path / "a.json").write_text(json.dumps({"results": [{"display_name": "T", "publication_year": 2001, "authors": [{"given": "J", "family": "Doe"}, "R Roe"]}]}))
    (tmp_path / "b.ris").write_text(ris)
    (tmp_path / "c.csv").write_text('paper_id,title\n1,"a ""quoted""\nline"\n2,\n')
    assert [(r.title, r.authors) for r in files.read_papers(spark, str(tmp_path / "a.json")).collect()] == [("T", "J Doe; R Roe")]
    assert files.read_papers(spark, str(tmp_path / "b.ris")).first().title == "A long title"
    assert rows(files.read_papers(spark, str(tmp_path / "c.csv")), "paper_id") == [("1", 'a "quoted"\nline'), ("2", "")]
    with pytest.raises(ValueError):
        files.read_papers(spark, "x.doc")
    (tmp_path / "d.jsonl").write_text('{"a": 1}\n\n[1]\n')
    with pytest.raises(Exception, match="no JSON object"):
        files.read_jsonl(spark, str(tmp_path / "d.jsonl")).selectExpr("to_json(record)").collect()
    files.write_csv(spark.createDataFrame([(2, None), (1, "x")], "n int, t string"), str(tmp_path / "out"), ["n", "t", "u"], ["n"])
    assert rows(files.read_csv(spark, str(tmp_path / "out"), ["n", "t", "u"]), "n") == [("1", "x", ""), ("2", "", "")]


def test_references_cut_before_their_semicolon():
    assert fulltext.page_text("<title>this and&amp</title><p>token = &quot</p>") == 'this and&\ntoken = "'


def test_full_text(spark):
    assert fulltext.page_text("<html><script>x</script><nav>n</nav><p>A &amp; B</p></html>") == "A & B"
    text = "intro line\n1. Introduction\nwe start\nMETHODS AND DATA\nwe do\nwe do more.\nI think so\nlast"
    df = spark.createDataFrame([(text,)], "t string").select(fulltext.split_sections(F.col("t")).alias("s"))
    assert [(s["key"], s["body"]) for s in df.first().s] == [("body", "intro line"), ("introduction", "we start"), ("methods", "we do we do more."), ("body", "last")]
    df = spark.createDataFrame([("Methods\nm\nAbstract\na",)], "t string").select(fulltext.split_sections(F.col("t")).alias("s"))
    assert [x.key for x in df.select(fulltext.prioritized(F.col("s"))).first()[0]] == ["abstract", "methods"]


def test_provider(spark):
    pages = {"q1": [{"id": f"W{i}", "display_name": f"T{i}", "publication_year": 2000 + i} for i in range(7)], "q2": [{"id": "V"}]}
    spark.dataSource.register(provider.Provider)
    df = spark.read.format("scholarly").option("queries", json.dumps(["q1", "q2"])).option("per_page", 3).option("recorded", json.dumps(pages)).option("consumed", json.dumps({"q1": 4})).load()
    assert rows(df.select("query", "query_rank", "provider_id"), "query", "query_rank") == [("q1", 5, "W4"), ("q1", 6, "W5"), ("q1", 7, "W6"), ("q2", 1, "V")]
    calls = []

    def failing():
        calls.append(1)
        if len(calls) < 3:
            raise provider.ServiceError(503)
        return [{}]

    assert provider.patient(failing, lambda s: None) == [{}] and len(calls) == 3
    with pytest.raises(provider.ServiceError):
        provider.patient(lambda: (_ for _ in ()).throw(provider.ServiceError(429)), lambda s: None)
    assert provider.query_text([["a", "b c"], ["d"]]) == '(a OR "b c") AND (d)'


def test_model_and_fuzzy():
    answers = iter(["not json", '{"x": 1}'])
    assert model.called(model.Static(lambda p: next(answers)), "p", {"required": ["x"]}) == ('{"x": 1}', "")
    assert model.called(model.Static(lambda p: "[]"), "p", {"required": ["x"]})[1].startswith("invalid json")
    known = ["smith_heat_islands_2020", "jones_city_2019"]
    assert fuzzy.closest("smith_heat_island_2020", known) == known[0] and fuzzy.closest("other", known) == ""


def test_stream(spark, tmp_path):
    from biblion.streaming.dedupe import first_seen_stream

    spark.createDataFrame([("a", "2020-01-01 00:00:00"), ("a", "2020-01-01 01:00:00"), ("b", "2020-01-01 00:30:00")], "k string, t string").selectExpr("k", "timestamp(t) AS t").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("k string, t timestamp").parquet(str(tmp_path / "in"))
    q = first_seen_stream(stream, "k", "t").writeStream.format("memory").queryName("seen").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r.k for r in spark.table("seen").collect()) == ["a", "b"]


def test_top_up_goes_on_until_there_is_enough(spark):
    def frame(k):
        return spark.createDataFrame([(k, k)], "k long, o long").coalesce(1)

    out, why = state.topped_up(frame(0), frame, lambda d: d.count() >= 23, "k", "o", lambda d, n: d)
    assert why == "enough" and sorted(r.k for r in out.collect()) == list(range(23))
