"""Further queries on the given tables: sources and sinks, text functions, audits, model steps behind fixed clients, runs.

Files that a query writes and reads again stand in the shared folder; small
configurations that only the driver reads, in a folder of its own.
"""

from __future__ import annotations

import json
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from biblion.functions import text as X
from biblion.operators import audit, availability, documents, matching, model, papers, reviews, seeds, sets, tagging
from biblion.operators.audit import Category, Label
from biblion.plans import contract as contracts
from biblion.plans import backfill, drafting, ontology, retrieval, runs, structure
from biblion.plans.catalogue import _TITLE, CONTRACT, ORACLE_SQL, QUERIES, _screening_rows, as_papers, query, table
from biblion.sources import files, fulltext, provider, tiers, works


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir() or tempfile.mkdtemp(prefix="catalogue-")
    return f"{folder.rstrip('/')}/{uuid.uuid4().hex}-{name}"


def rows_of(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


# sources and sinks


@query("SELECT doc_id::VARCHAR AS doc_id, lang, coalesce(source, '') AS source, coalesce(text, '') AS text, '' AS missing FROM documents")
def csv_round_trip(spark, sf_dir):
    path, columns = scratch(spark, "documents.csv"), ["doc_id", "lang", "source", "text", "missing"]
    files.write_csv(table(spark, sf_dir, "documents"), path, columns)
    return files.read_csv(spark, path, columns, required=["doc_id", "text"])


@query("SELECT n_nationkey::VARCHAR AS n_nationkey, n_name, row_number() OVER (ORDER BY n_nationkey DESC) AS row_number FROM nation")
def csv_row_numbers(spark, sf_dir):
    path = scratch(spark, "nation.csv")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    files.write_csv(nation.withColumn("o", -F.col("n_nationkey")), path, order=["o"])
    return files.read_csv(spark, path, required=["n_name"], row_number="row_number").drop("o")


@query("SELECT doc_id, lang, length(text) AS n FROM documents")
def jsonl_round_trip(spark, sf_dir):
    path = scratch(spark, "documents.jsonl")
    files.write_jsonl(table(spark, sf_dir, "documents").select("doc_id", "lang", "text"), path)
    r = F.col("record")
    return files.read_jsonl(spark, path).select(F.variant_get(r, "$.doc_id", "bigint").alias("doc_id"), F.variant_get(r, "$.lang", "string").alias("lang"), F.length(F.variant_get(r, "$.text", "string")).cast("long").alias("n"))


@query("SELECT f AS file, r_name AS name, r_regionkey AS number FROM region, (SELECT unnest(['a.json', 'a.yaml']) AS f)")
def object_round_trip(spark, sf_dir):
    folder, found = tempfile.mkdtemp(prefix="objects-"), []
    regions = [(r.r_name, int(r.r_regionkey)) for r in table(spark, sf_dir, "region").collect()]  # five
    for name in ("a.json", "a.yaml"):
        files.write_object({"regions": [{"name": n, "number": k, "text": 'x: "#y"\n- z'} for n, k in regions], "none": []}, os.path.join(folder, name))
        found += [(name, x["name"], x["number"]) for x in files.read_object(os.path.join(folder, name))["regions"] if x["text"] == 'x: "#y"\n- z']
    return rows_of(spark, found, "file string, name string, number long")


@query("""SELECT 'paper_' || c_custkey AS paper_id, c_name AS title, '19' || lpad((c_custkey % 100)::VARCHAR, 2, '0') AS year, '10.1/A' || c_custkey AS doi, 'Ann ' || c_mktsegment || '; Roe, R' AS authors, 'json' AS source FROM customer""")
def json_import(spark, sf_dir):
    path = scratch(spark, "papers.jsonl")
    year = F.concat(F.lit("19"), F.lpad((F.col("c_custkey") % 100).cast("string"), 2, "0"), F.lit("-05-01"))
    authors = F.array(F.to_variant_object(F.struct(F.lit("Ann").alias("given"), F.col("c_mktsegment").alias("family"))), F.parse_json(F.lit('"Roe,  R"')))
    rows = table(spark, sf_dir, "customer").select(F.concat(F.lit("Paper "), "c_custkey").alias("id"), F.col("c_name").alias("display_name"), year.alias("date"), F.concat(F.lit("https://doi.org/10.1/A"), "c_custkey").alias("DOI"), authors.alias("author"))
    # one file, in which ids are unique
    rows.select(F.to_json(F.struct(*rows.columns)).alias("value")).coalesce(1).write.text(path)
    return files.read_papers(spark, path).select("paper_id", "title", "year", "doi", "authors", "source")


def _lines(df: DataFrame, path: str, order: str) -> None:
    """One text file of the column ``value``, in order."""
    df.orderBy(order).select("value").coalesce(1).write.text(path)


@query("""SELECT '10_1_x' || s_suppkey AS paper_id, s_name || ' goes on' AS title, '2019' AS year, '10.1/X' || s_suppkey AS doi, 'Doe, J; Roe, R' AS authors, 'Journal of ' || s_nationkey AS venue FROM supplier""")
def ris_import(spark, sf_dir):
    path = scratch(spark, "papers.ris")
    lines = F.concat_ws("\n", F.lit("TY  - JOUR"), F.concat(F.lit("TI  - "), "s_name"), F.lit("  goes on"), F.lit("AU  - Doe, J"), F.lit("AU  - Roe, R"), F.lit("PY  - 2019/01"), F.concat(F.lit("DO  - doi:10.1/X"), "s_suppkey"), F.concat(F.lit("JO  - Journal  of "), "s_nationkey"), F.lit("ER  - "))
    _lines(table(spark, sf_dir, "supplier").withColumn("value", lines), path, "s_suppkey")
    return files.read_papers(spark, path).select("paper_id", "title", "year", "doi", "authors", "venue")


@query("""WITH s AS (SELECT *, row_number() OVER (PARTITION BY s_suppkey % 7 ORDER BY s_suppkey) AS k FROM supplier)
SELECT 'key-' || (s_suppkey % 7) || '_x' || CASE WHEN k > 1 THEN '_' || k ELSE '' END AS paper_id, 'A ' || s_name || ' & more' AS title, '2020' AS year, 'Doe, J; Roe, R' AS authors, 'J, one' AS venue, '/p/' || s_suppkey || '.pdf' AS full_text_path,
'bibtex:article' AS source, 'bibtex_key=Key-' || (s_suppkey % 7) || '_x' AS notes FROM s""")
def bibtex_import(spark, sf_dir):
    path = scratch(spark, "papers.bib")
    key = F.concat(F.lit("Key-"), (F.col("s_suppkey") % 7).cast("string"), F.lit("_x"))
    entry = F.concat(F.lit("@comment{not } this\n@article{"), key, F.lit(", title = {A {\\emph "), "s_name", F.lit('} \\& more}, author = "Doe, J and Roe, R", year = 2020, journaltitle = "J" # {, one}, file = {:/p/'), F.col("s_suppkey").cast("string"), F.lit(".pdf:PDF}}"))
    _lines(table(spark, sf_dir, "supplier").withColumn("value", entry), path, "s_suppkey")
    return files.read_papers(spark, path).select("paper_id", "title", "year", "authors", "venue", "full_text_path", "source", "notes")


@query("SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN 'extracted' ELSE 'too_short' END AS status, length(n_name) * CASE WHEN n_nationkey % 2 = 0 THEN 1000 ELSE 1 END AS n FROM nation")
def text_files(spark, sf_dir):
    path = scratch(spark, "texts")
    table(spark, sf_dir, "nation").select("n_nationkey", F.expr("repeat(n_name, if(n_nationkey % 2 = 0, 1000, 1))").alias("value")).repartition("n_nationkey").write.partitionBy("n_nationkey").text(path)
    read = fulltext.read_documents(spark, path + "/n_nationkey=*/*.txt")
    return read.select(F.regexp_extract("path", "n_nationkey=([0-9]+)", 1).cast("int").alias("n_nationkey"), "status", F.length(F.regexp_replace("text", "\n$", "")).cast("long").alias("n"))


@query("SELECT 'BIBLION_R' || r_regionkey AS name, CASE WHEN r_regionkey = 0 THEN 'set before' ELSE r_name END AS \"value\" FROM region")
def environment(spark, sf_dir):
    path = os.path.join(tempfile.mkdtemp(prefix="environment-"), ".env")
    regions = [(f"BIBLION_R{r.r_regionkey}", r.r_name) for r in table(spark, sf_dir, "region").collect()]  # five
    with open(path, "w", encoding="utf-8") as f:
        f.write("# a comment\n\nno value\n" + "".join(f"{k} = '{v}'\n" for k, v in regions))
    os.environ["BIBLION_R0"] = "set before"
    try:
        files.read_environment(path)
        return rows_of(spark, [(k, os.environ[k]) for k, _ in regions], "name string, value string")
    finally:
        for k, _ in regions:
            os.environ.pop(k, None)


_NATION_PAPERS = "SELECT 'p' || n_nationkey AS paper_id, 'On ' || n_name || ' & more_' AS title, '20' || lpad(n_nationkey::VARCHAR, 2, '0') AS year, n_name || ', A' AS authors, '10.1/' || n_nationkey AS doi, n_name AS label FROM nation"


def _cited(spark, sf_dir) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    return n.select(F.concat(F.lit("p"), "n_nationkey").alias("paper_id"), F.concat(F.lit("On "), "n_name", F.lit(" & more_")).alias("title"), F.concat(F.lit("20"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("year"), F.concat("n_name", F.lit(", A")).alias("authors"), F.concat(F.lit("10.1/"), "n_nationkey").alias("doi"))


@query(f"""WITH p AS ({_NATION_PAPERS}), b AS (SELECT string_agg('See (' || label || ', ' || year || ').', ' ' ORDER BY lower(label)) AS t FROM p)
SELECT 'md' AS kind, '# A & B' || chr(10) || chr(10) || '## One' || chr(10) || chr(10) || t || chr(10) || chr(10) || '## References' || chr(10) || chr(10) ||
(SELECT string_agg('- ' || authors || ' (' || year || '). ' || title || '. https://doi.org/' || doi, chr(10) ORDER BY lower(label)) FROM p) || chr(10) AS text FROM b
UNION ALL SELECT 'bib', (SELECT string_agg('@article{{' || paper_id || ',' || chr(10) || '  title = {{On ' || replace(label, '_', '\\_') || ' \\& more\\_}},' || chr(10) || '  author = {{' || replace(authors, '_', '\\_') || '}},' || chr(10) || '  year = {{' || year || '}},' || chr(10) || '  doi = {{' || doi || '}}' || chr(10) || '}}' || chr(10), chr(10) ORDER BY lower(label)) FROM p)
UNION ALL SELECT 'cited', (SELECT string_agg('See \\citep{{' || paper_id || '}}.', ' ' ORDER BY lower(label)) FROM p)""")
def assembled_documents(spark, sf_dir):
    known = [r.asDict() for r in documents.references(documents.citable(_cited(spark, sf_dir))).collect()]  # those that are cited
    text = " ".join(f"See ({p['label']}, {p['year']})." for p in known)
    tex = documents.latex("A & B", [("One", text)], known)
    body = tex[tex.index("See ") : tex.index("\n\\bibliographystyle")]
    return rows_of(spark, [("md", documents.markdown("A & B", [("One", text)], known)), ("bib", documents.bibtex(known)), ("cited", body)], "kind string, text string")


@query(f"WITH p AS ({_NATION_PAPERS}) SELECT paper_id, label, row_number() OVER (ORDER BY lower(label), lower(year), lower(title), paper_id) AS place FROM p WHERE substr(paper_id, 2)::INT % 3 > 0")
def reference_list(spark, sf_dir):
    cited = [f"p{k}" for k in range(25) if k % 3]
    rows = documents.references(documents.citable(_cited(spark, sf_dir)), cited).select("paper_id", "label", F.monotonically_increasing_id().alias("o"))
    return rows.coalesce(1).select("paper_id", "label", (F.monotonically_increasing_id() + 1).alias("place"))


@query("""SELECT n_nationkey, 'As (' || n_name || ', 20' || lpad(n_nationkey::VARCHAR, 2, '0') || ') and (' || n_name || ', 20' || lpad(n_nationkey::VARCHAR, 2, '0') || '; ' || n_name || ', 20' || lpad(n_nationkey::VARCHAR, 2, '0') || ') say.' AS text, 0 AS gaps FROM nation""")
def repaired_citations(spark, sf_dir):
    known = [r.asDict() for r in documents.references(documents.citable(_cited(spark, sf_dir))).collect()]
    found = []
    for p in known:
        told = f"As (Mistyped, {p['year']}) and ({p['label']}, {p['year']}; Other, {p['year']}) say."
        text = documents.repaired(told, known)
        found.append((int(p["paper_id"][1:]), text, len(documents.coverage_gaps(text, [p]))))
    return rows_of(spark, found, "n_nationkey int, text string, gaps int")


@query("SELECT conv_id::VARCHAR AS section_id, 'edited ' || max(turn) AS text FROM conversations GROUP BY conv_id")
def edited_sections(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").groupBy(F.col("conv_id").cast("string").alias("section_id")).agg(F.max("turn").alias("n"))
    return documents.edited_sections(turns.select("section_id"), turns.select("section_id", F.concat(F.lit("edited "), "n").alias("text")))


# predicates of rows


@query("SELECT doc_id, 'strict' AS kind FROM labels WHERE doc_id % 3 = 1 UNION ALL SELECT doc_id, 'lenient' FROM labels WHERE doc_id % 3 <> 2")
def included_rows(spark, sf_dir):
    rows = table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("doc_id") % 3 == 1, "include").when(F.col("doc_id") % 3 == 2, "exclude_or_route_elsewhere").alias("scope_decision"))
    return papers.included(rows).select("doc_id", F.lit("strict").alias("kind")).unionByName(papers.included(rows, lenient=True).select("doc_id", F.lit("lenient").alias("kind")))


@query("SELECT doc_id, CASE WHEN quality = 1 THEN true WHEN doc_id % 2 = 0 THEN toxic = 1 ELSE false END AS strict FROM labels WHERE quality IS NOT NULL")
def strict_titles(spark, sf_dir):
    rows = table(spark, sf_dir, "labels").filter("quality IS NOT NULL")
    phase = F.when(F.col("quality") == 1, "strict_title").otherwise("field_relaxed")
    tier = (F.col("doc_id") % 2).cast("int")
    return rows.select("doc_id", matching.strict_title(phase, tier, F.col("toxic") != 1).alias("strict"))


@query("""SELECT doc_id, CASE WHEN toxic = 1 THEN 'exclude' ELSE 'review' END AS decision, CASE WHEN toxic = 1 THEN 'llm_error_auto_excluded' ELSE 'llm_error' END AS status,
CASE doc_id % 4 WHEN 0 THEN 'timeout' WHEN 1 THEN 'rate_limit' WHEN 2 THEN 'invalid_json' ELSE 'llm_error' END AS error_type FROM labels""")
def model_failures(spark, sf_dir):
    said = F.when(F.col("doc_id") % 4 == 0, "Request timed out").when(F.col("doc_id") % 4 == 1, "Rate limit reached").when(F.col("doc_id") % 4 == 2, "invalid JSON").otherwise("refused")
    return table(spark, sf_dir, "labels").select("doc_id", matching.failed(F.coalesce(F.col("toxic"), F.lit(0)) != 1, said).alias("f")).select("doc_id", "f.decision", "f.status", "f.error_type")


# sections of full texts; the pieces of a document's first line stand for headings

_FULL = "CASE doc_id % 6 WHEN 0 THEN 'lead' || chr(10) ELSE '' END || 'ABSTRACT' || chr(10) || text || chr(10) || '2. Materials and methods' || chr(10) || lang || ' one.' || chr(10) || 'Findings of this work' || chr(10) || source"
_NAMED = """CASE WHEN regexp_matches(n, 'abstract') THEN 'abstract' WHEN regexp_matches(n, 'introduct') THEN 'introduction' WHEN regexp_matches(n, 'background|context') THEN 'background'
WHEN regexp_matches(n, 'literature\\s+review|review\\s+of\\s+literature') THEN 'literature_review' WHEN regexp_matches(n, 'related\\s+work') THEN 'related_work' WHEN regexp_matches(n, 'method') THEN 'methods'
WHEN regexp_matches(n, 'study\\s+design|research\\s+design|\\bdesign\\b') THEN 'study_design' WHEN regexp_matches(n, 'procedure') THEN 'procedure' WHEN regexp_matches(n, 'approach') THEN 'approach'
WHEN regexp_matches(n, 'protocol') THEN 'protocol' WHEN regexp_matches(n, 'data') THEN 'data' WHEN regexp_matches(n, 'sample') THEN 'sample' WHEN regexp_matches(n, 'participant|subject') THEN 'participants'
WHEN regexp_matches(n, 'population') THEN 'population' WHEN regexp_matches(n, 'cohort') THEN 'cohort' WHEN regexp_matches(n, 'analys') THEN 'analysis' WHEN regexp_matches(n, 'result|outcome') THEN 'results'
WHEN regexp_matches(n, 'finding') THEN 'findings' WHEN regexp_matches(n, 'discussion') THEN 'discussion' WHEN regexp_matches(n, 'limitation') THEN 'limitations'
WHEN regexp_matches(n, 'future\\s+work|future\\s+direction|future\\s+research|research\\s+gap|open\\s+question') THEN 'future_work' WHEN regexp_matches(n, 'conclusion|summary|implication') THEN 'conclusion' END"""
_SECTIONS = f"""WITH l AS (SELECT doc_id, unnest(string_split(f, chr(10))) AS x, generate_subscripts(string_split(f, chr(10)), 1) AS i FROM (SELECT doc_id, {_FULL} AS f FROM documents)),
t AS (SELECT doc_id, i, trim(x, ' ' || chr(9) || chr(13)) AS x FROM l),
w AS (SELECT *, len(list_filter(regexp_split_to_array(x, '\\s+'), lambda v: v <> '')) AS k, trim(regexp_replace(regexp_replace(regexp_replace(lower(x), '^[0-9]+(\\.[0-9]+)*[.)]?\\s+', ''), '^[ivxlcdm]+[.)]\\s+', ''), '\\s+', ' ', 'g')) AS n FROM t),
h AS (SELECT *, {_NAMED} AS key FROM w),
g AS (SELECT *, len(x) BETWEEN 1 AND 120 AND NOT (x LIKE '%.' AND k > 4) AND (regexp_matches(x, '^([0-9]+(\\.[0-9]+)*|[IVXLCDM]+)[.)]?\\s+\\S') OR (upper(x) = x AND lower(x) <> x AND k <= 8) OR (k <= 10 AND key IS NOT NULL)) AS head FROM h)"""


@query(_SECTIONS + " SELECT doc_id, count_if(head) AS heads, count(*) AS lines FROM g GROUP BY doc_id")
def heading_lines(spark, sf_dir):
    text = F.expr(_FULL.replace("chr(10)", "'\\n'"))
    rows = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.split(text, "\n")).alias("x"))
    return rows.groupBy("doc_id").agg(F.count_if(fulltext.is_heading(F.trim(F.regexp_replace("x", r"^\s+|\s+$", "")))).alias("heads"), F.count("*").alias("lines"))


@query(_SECTIONS + """, s AS (SELECT *, sum(head::INT) OVER (PARTITION BY doc_id ORDER BY i) AS sec FROM g),
b AS (SELECT doc_id, sec, coalesce(max(CASE WHEN head THEN coalesce(key, 'body') END), 'body') AS key, coalesce(max(CASE WHEN head THEN x END), 'body') AS heading,
regexp_replace(string_agg(CASE WHEN NOT head AND x <> '' THEN x END, ' ' ORDER BY i), '\\s+', ' ', 'g') AS body FROM s GROUP BY doc_id, sec HAVING count_if(NOT head AND x <> '') > 0)
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY coalesce(nullif(list_position(['abstract', 'conclusion', 'discussion', 'limitations', 'future_work', 'results', 'findings', 'introduction', 'background', 'literature_review', 'related_work', 'methods', 'methodology',
'materials_and_methods', 'study_design', 'procedure', 'approach', 'protocol', 'data', 'sample', 'participants', 'population', 'cohort', 'analysis'], key), 0), 99), sec) - 1 AS position, key, heading, body FROM b""")
def prioritized_sections(spark, sf_dir):
    text = F.expr(_FULL.replace("chr(10)", "'\\n'"))
    rows = table(spark, sf_dir, "documents").select("doc_id", fulltext.prioritized(fulltext.split_sections(text), text).alias("s"))
    return rows.select("doc_id", F.posexplode("s").alias("position", "x")).select("doc_id", F.col("position").cast("long").alias("position"), "x.key", "x.heading", "x.body")


@query("""SELECT p_partkey, '[Methods]' || chr(10) || p_name || chr(10) || chr(10) || '[Body]' || chr(10) || p_type AS whole, '[Methods]' || chr(10) || split_part(p_name, ' ', 1) AS "cut" FROM part WHERE length(p_name) > 2""")
def evidence_texts(spark, sf_dir):
    rows = table(spark, sf_dir, "part").filter("length(p_name) > 2")
    part = lambda k, h, b: F.struct(F.lit(k).alias("key"), F.lit(h).alias("heading"), b.alias("body"))
    both = F.array(part("methods", "Methods", F.col("p_name")), part("body", "body", F.col("p_type")))
    # the first word, and one character of the second
    most = F.length(F.substring_index("p_name", " ", 1))
    cuts = [n[0] for n in rows.select(most.alias("n")).distinct().collect()]  # as many as words have lengths
    told = F.lit(None).cast("string")
    for n in cuts:
        told = F.when(most == n, fulltext.evidence(both, 10 + n + 2)).otherwise(told)
    return rows.select("p_partkey", fulltext.evidence(both).alias("whole"), told.alias("cut"))


@query("""SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'existing_text_available' ELSE '' END AS full_text_status, CASE WHEN doc_id % 3 = 0 THEN length(text) ELSE 0 END AS full_text_chars FROM documents WHERE doc_id % 3 <> 0 OR length(text) >= 1000
UNION ALL SELECT doc_id, '', 0 FROM documents WHERE doc_id % 3 = 0 AND length(text) < 1000""")
def cached_texts(spark, sf_dir):
    path = scratch(spark, "texts")
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("title"), F.concat(F.lit("http://x.org/"), "doc_id").alias("url"), "text")
    fulltext.cached(docs.filter("doc_id % 3 = 0"), path)
    asked = docs.drop("text").withColumn("text_key", fulltext.text_key(F.col("title"), F.col("url")))
    known, rest = fulltext.reused(asked, spark.read.parquet(path))
    told = known.select("doc_id", "full_text_status", F.col("full_text_chars").cast("long").alias("full_text_chars"))
    return told.unionByName(rest.select("doc_id", F.lit("").alias("full_text_status"), F.lit(0).cast("long").alias("full_text_chars")))


@query("SELECT doc_id, regexp_replace(lower(source), '[^a-z0-9]+', '_', 'g') || '_' || substr(sha1('http://x.org/' || doc_id), 1, 16) AS text_key FROM documents")
def text_keys(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", fulltext.text_key(F.col("source"), F.concat(F.lit("http://x.org/"), "doc_id")).alias("text_key"))


def _finders():
    def down(doi, title):
        raise OSError("down")

    return {"open_copies": lambda doi, title: [(f"http://o/{doi}", "cc"), ("", "")], "archive": down, "aggregator": lambda doi, title: [(f"http://a/{title}", ""), (f"http://o/{doi}", "other")]}


@query("""SELECT s_suppkey, 'http://f/' || s_suppkey || ' provider_metadata|https://doi.org/10.1/' || s_suppkey || ' doi_landing|http://o/10.1/' || s_suppkey || ' open_copies|http://a/' || s_name || ' aggregator' AS places FROM supplier""")
def full_text_locations(spark, sf_dir):
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_name").alias("title"), F.concat(F.lit("doi:10.1/"), "s_suppkey").alias("doi"), F.concat(F.lit(" http://f/"), "s_suppkey").alias("full_text_url"), F.concat(F.lit("http://f/"), "s_suppkey").alias("pdf_url"), F.lit("ftp://no").alias("url"))
    found = fulltext.candidate_locations(rows, "s_suppkey", _finders)
    return found.select("s_suppkey", F.array_join(F.transform("locations", lambda x: F.concat_ws(" ", x["url"], x["source"])), "|").alias("places"))


# records of a service


def _works(spark, sf_dir) -> DataFrame:
    places = F.array(F.struct(F.concat(F.lit("http://x/"), "s_suppkey").alias("pdf_url"), F.lit("").alias("landing_page_url"), F.lit(False).alias("is_oa")), F.struct(F.lit("ftp://y").alias("pdf_url"), F.lit("http://b/l").alias("landing_page_url"), F.lit(True).alias("is_oa")))
    best = F.struct(F.lit("http://b/p").alias("pdf_url"), F.lit("http://b/l").alias("landing_page_url"), F.lit("cc-by").alias("license"))
    work = F.struct(
        F.concat(F.lit("W"), "s_suppkey").alias("id"), F.col("s_name").alias("display_name"), (1990 + F.col("s_suppkey") % 30).alias("publication_year"), F.lit("article").alias("type"),
        F.struct(F.concat(F.lit("http://o/"), "s_suppkey", F.lit(".PDF?x=1")).alias("oa_url"), (F.col("s_suppkey") % 2 == 0).alias("is_oa")).alias("open_access"), best.alias("best_oa_location"), places.alias("locations"),
        F.array(F.struct(F.struct(F.lit("Ann Lee").alias("display_name")).alias("author")), F.struct(F.struct(F.col("s_name").alias("display_name")).alias("author"))).alias("authorships"),
        F.struct(F.array(F.lit(1)).alias("world"), F.array(F.lit(0), F.lit(2)).alias("hello")).alias("abstract_inverted_index"),
    )
    return table(spark, sf_dir, "supplier").select("s_suppkey", F.parse_json(F.to_json(work)).alias("work"))


@query("""SELECT s_suppkey, 'p_open_access http://o/' || s_suppkey || '.PDF?x=1 pdf  ' || (s_suppkey % 2 = 0) || '|p_best_oa_location http://b/p pdf cc-by ' || (s_suppkey % 2 = 0) || '|p_best_oa_location http://b/l landing_page cc-by ' || (s_suppkey % 2 = 0) || '|p_location http://x/' || s_suppkey || ' pdf  false' AS places FROM supplier""")
def work_locations(spark, sf_dir):
    found = works.work_locations(F.col("work"), "p")
    told = F.array_join(F.transform(found, lambda x: F.concat_ws(" ", x["source"], x["url"], x["kind"], x["license"], x["is_open_access"])), "|")
    return _works(spark, sf_dir).select("s_suppkey", told.alias("places"))


@query("SELECT s_suppkey, 'W' || s_suppkey AS provider_id, s_name AS title, (1990 + s_suppkey % 30)::VARCHAR AS year, 'hello world hello' AS abstract, 'Ann Lee; ' || s_name AS authors, 'W' || s_suppkey AS url, 'http://b/p' AS pdf FROM supplier")
def work_cells(spark, sf_dir):
    rows = works.work_cells(_works(spark, sf_dir))
    return rows.select("s_suppkey", "provider_id", "title", "year", "abstract", "authors", "url", X.nested(F.col("work"), ["best_oa_location", "pdf_url"]).alias("pdf"))


@query("""SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'provider_metadata http://x/a.pdf pdf yes|candidate_metadata http://x/' || page_id || ' html ' ELSE 'provider_metadata http://x/a.pdf pdf no|candidate_metadata http://x/' || page_id || ' html ' END AS places FROM pages""")
def checked_locations(spark, sf_dir):
    one = lambda url, kind, flag: F.struct(F.lit("").alias("source"), url.alias("url"), F.lit(kind).alias("kind"), F.lit(None).cast("string").alias("license"), flag.alias("is_open_access"))
    flag = F.when(F.col("page_id") % 3 == 0, "TRUE").otherwise("0")
    given = F.array(one(F.lit(" http://x/a.pdf"), "", flag), one(F.lit("http://x/a.pdf"), "html", flag), one(F.lit("ftp://x"), "pdf", flag), one(F.lit("http://"), "pdf", flag))
    rows = table(spark, sf_dir, "pages").select("page_id", given.alias("full_text_locations"), F.concat(F.lit("http://x/"), "page_id").alias("full_text_url"))
    return rows.select("page_id", F.array_join(F.transform(works.candidate_locations(rows), lambda x: F.concat_ws(" ", x["source"], x["url"], x["kind"], x["is_open_access"])), "|").alias("places"))


@query("SELECT o_custkey, string_agg(DISTINCT 'http://x/' || (o_orderkey % 3), '|' ORDER BY 'http://x/' || (o_orderkey % 3)) AS urls, count(*) AS duplicate_count FROM orders GROUP BY o_custkey")
def merged_locations(spark, sf_dir):
    place = F.array(F.struct(F.concat(F.lit("http://x/"), (F.col("o_orderkey") % 3).cast("string")).alias("url")), F.struct(F.lit(" ").alias("url")))
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", place.alias("places"))
    out = papers.deduplicated(rows, F.col("o_custkey"), F.lit(True), (F.col("o_orderkey") % 3).cast("string"), "o_orderkey", locations="places")
    return out.select("o_custkey", F.array_join(F.array_sort(F.transform("places", lambda x: x["url"])), "|").alias("urls"), "duplicate_count")


@query("""WITH h AS (SELECT c_nationkey AS k, c_custkey AS o, CASE WHEN c_custkey % 2 = 0 THEN 'Term' ELSE 'TERM' END AS v, CASE WHEN c_custkey % 3 = 0 THEN 'title' ELSE 'abstract' END AS f FROM customer)
SELECT k, 't' AS topic_id, f AS field, arg_min(v, o) AS "value" FROM h GROUP BY k, f""")
def merged_topic_matches(spark, sf_dir):
    hit = F.struct(F.lit("t").alias("topic_id"), F.lit("main").alias("kind"), F.lit("").alias("group_id"), F.when(F.col("c_custkey") % 2 == 0, "Term").otherwise("TERM").alias("value"), F.when(F.col("c_custkey") % 3 == 0, "title").otherwise("abstract").alias("field"), F.lit(0).alias("ordinal"))
    rows = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k"), "c_custkey", F.array(hit).alias("topic_hits"))
    return matching.merged_matches(rows, "k", "c_custkey").select("k", "topic_id", "field", "value")


# keys, ids, texts

_DOIS = "CASE c_custkey % 5 WHEN 0 THEN ' HTTPS://doi.org/10.1/Ab' || c_custkey WHEN 1 THEN 'doi:10.2/X ' || c_custkey WHEN 2 THEN 'http://doi.org/10.3/y' WHEN 3 THEN '' ELSE 'DOI:10.4/Z' END"


@query(f"""WITH c AS (SELECT c_custkey, c_name, {_DOIS} AS d FROM customer), k AS (SELECT *, trim(replace(replace(replace(lower(trim(d)), 'https://doi.org/', ''), 'http://doi.org/', ''), 'doi:', '')) AS own,
trim(replace(replace(replace(trim(regexp_replace(d, '\\s+', ' ', 'g')), 'https://doi.org/', ''), 'http://doi.org/', ''), 'doi:', '')) AS shown FROM c)
SELECT c_custkey, own AS doi_key, shown AS doi_display, CASE WHEN own <> '' THEN 'doi:' || own WHEN c_custkey % 2 = 0 THEN 'title_year:' || trim(regexp_replace(lower(c_name), '[^a-z0-9]+', ' ', 'g')) || ':2020' ELSE 'title:' || trim(regexp_replace(lower(c_name), '[^a-z0-9]+', ' ', 'g')) END AS dedupe_key FROM k""")
def doi_keys(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.expr(_DOIS).alias("d"))
    year = F.when(F.col("c_custkey") % 2 == 0, " 2020").otherwise("")
    return rows.select("c_custkey", X.doi_key(F.col("d")).alias("doi_key"), X.doi_display(F.col("d")).alias("doi_display"), X.dedupe_key(F.col("d"), F.col("c_name"), year, F.lit("p"), F.lit("1")).alias("dedupe_key"))


@query("""WITH p AS (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN '' ELSE p_name || ' of a very, long: Title of more words' END AS t, CASE p_partkey % 3 WHEN 0 THEN '' ELSE '2001' END AS y FROM part), w AS (SELECT *, array_to_string(regexp_extract_all(lower(t), '[a-z0-9]+')[1:6], '_') AS s FROM p)
SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN 'own id' ELSE CASE WHEN s <> '' THEN s ELSE 'paper_' || lpad(p_partkey::VARCHAR, greatest(4, length(p_partkey::VARCHAR))::INT, '0') END || CASE WHEN y <> '' THEN '_' || y ELSE '' END END AS paper_id FROM w""")
def paper_ids(spark, sf_dir):
    title = F.when(F.col("p_partkey") % 4 == 0, "").otherwise(F.concat("p_name", F.lit(" of a very, long: Title of more words")))
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("int").alias("p_partkey"), F.when(F.col("p_partkey") % 5 == 0, " own  id ").otherwise("").alias("paper_id"), title.alias("title"), F.when(F.col("p_partkey") % 3 == 0, "n.d.").otherwise("c. 2001").alias("year"), F.lit("").alias("doi"), F.lit("").alias("abstract"))
    return papers.normalized(rows, "p_partkey").select(F.col("p_partkey").cast("long").alias("p_partkey"), "paper_id")


@query("""SELECT p_partkey, p_name || ' & 5% of ' || p_type || ' x' AS plain FROM part""")
def latex_texts(spark, sf_dir):
    raw = F.concat(F.lit("{\\textbf "), "p_name", F.lit("} \\& 5\\% of  {"), "p_type", F.lit("} \\emph{x}"))
    return table(spark, sf_dir, "part").select("p_partkey", X.latex_to_text(raw).alias("plain"))


@query(f"""SELECT doc_id, CASE WHEN length(text) <= 300 THEN text WHEN contains(substr(text, 1, 300), ' ') THEN rtrim(regexp_replace(substr(text, 1, 300), ' [^ ]*$', '', 's'), ' ') ELSE substr(text, 1, 300) END AS bounded,
array_to_string(list_filter(string_split(trim(regexp_replace({_TITLE}, '\\s+', ' ', 'g')), ' '), lambda w: w <> '')[1:3], ' ') AS words, lang || '; ' || source AS items FROM documents""")
def bounded_texts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("title", F.substring_index("text", "\n", 1))
    items = X.capped_items(F.concat_ws(";", "lang", F.lit(" "), "source", "lang"), 2)
    return docs.select("doc_id", X.bounded_text(F.col("text"), 300).alias("bounded"), X.capped_words(F.col("title"), 3).alias("words"), items.alias("items"))


@query("SELECT c_custkey, 'a=' || c_mktsegment || '@title|x@abstract; b=' || c_name || '@title' AS told FROM customer")
def topic_maps(spark, sf_dir):
    v = lambda value, field: F.struct(value.alias("value"), F.lit(field).alias("field"))
    none = F.filter(F.array(v(F.lit("x"), "y")), lambda x: F.lit(False))
    made = F.create_map(F.lit("b"), F.array(v(F.col("c_name"), "title")), F.lit("c"), none, F.lit("a"), F.array(v(F.col("c_mktsegment"), "title"), v(F.lit("x"), "abstract")))
    return table(spark, sf_dir, "customer").select("c_custkey", X.topic_map_text(made).alias("told"))


@query("SELECT doc_id, len(list_distinct([lower(lang), regexp_replace(lower(source), '[^a-z0-9]+', ' ', 'g')])) AS n FROM documents")
def distinct_terms(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.distinct_terms(F.array("lang", F.upper("lang"), F.lit(" "), "source", F.lit(None).cast("string"))).cast("long").alias("n"))


@query("SELECT n, least(greatest(5 * n, n + 10), 100) AS pool, least(greatest(30, 4 * n), 5000) AS budget FROM (SELECT unnest([1, 2, 3, 10, 25, 100, 2000]) AS n)")
def pool_sizes(spark, sf_dir):
    return rows_of(spark, [(n, X.review_pool(n), X.search_budget(n)) for n in (1, 2, 3, 10, 25, 100, 2000)], "n int, pool int, budget int")


# tables as sets


@query("SELECT 1 AS source_ordinal, doc_id AS id, lang, NULL AS text FROM documents UNION ALL SELECT 2, item_id, NULL, text FROM benchmark")
def union_all(spark, sf_dir):
    one = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "lang")
    return sets.union_all([one, table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), "text")], "id")


@query("SELECT doc_id, source FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS n FROM documents) WHERE n <= 3")
def head_by_source(spark, sf_dir):
    return sets.head(table(spark, sf_dir, "documents").select("doc_id", "source"), 3, "doc_id", by="source")


@query("SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 50")
def head_of_table(spark, sf_dir):
    return sets.head(table(spark, sf_dir, "documents").select("doc_id", "lang"), 50, "doc_id")


# audits

_LABELS = [Label("lang", "controlled_fixed", ["en", "fr"]), Label("kind", "controlled_auto", selection="multi"), Label("note", "free_text")]


def _labelled(spark, sf_dir) -> DataFrame:
    kind = F.when(F.col("doc_id") % 3 == 0, "Survey methods; case study").when(F.col("doc_id") % 3 == 1, "survey  Method").otherwise("")
    return table(spark, sf_dir, "documents").select("doc_id", "lang", kind.alias("kind"), F.when(F.col("doc_id") % 4 == 0, "x").otherwise("").alias("note"))


@query("""SELECT 'lang' AS field, lang AS "value", 'observed_invalid_value_summary' AS issue, 'error' AS severity, 'count=' || count(*) AS detail FROM documents WHERE lang NOT IN ('en', 'fr') GROUP BY lang
UNION ALL SELECT 'note', '', 'high_missingness', 'warning', count_if(doc_id % 4 <> 0) || '_of_' || count(*) || '_rows_empty' FROM documents""")
def missingness_issues(spark, sf_dir):
    return audit.missingness_issues(_labelled(spark, sf_dir), _LABELS)


@query("""SELECT 'lang' AS label_id, count(*) AS total_rows, count_if(lang IS NULL) AS empty_count, count(lang) AS non_empty_count, 2::BIGINT AS valid_values, count(DISTINCT CASE WHEN lang NOT IN ('en', 'fr') THEN lang END) AS invalid_values FROM documents
UNION ALL SELECT 'kind', count(*), count_if(doc_id % 3 = 2), count_if(doc_id % 3 < 2), 2, 0 FROM documents""")
def label_summary(spark, sf_dir):
    return audit.label_summary(_labelled(spark, sf_dir), _LABELS[:2])


@query("""SELECT 'kind' AS label_id, 'survey_method' AS "value", 'survey_methods' AS source, 'Survey methods' AS form, count(*) AS "count" FROM documents WHERE doc_id % 3 = 0
UNION ALL SELECT 'kind', 'case_study', 'case_study', 'case study', count(*) FROM documents WHERE doc_id % 3 = 0 UNION ALL SELECT 'kind', 'survey_method', 'survey_method', 'survey  Method', count(*) FROM documents WHERE doc_id % 3 = 1
UNION ALL SELECT 'lang', lang, lang, lang, count(*) FROM documents WHERE lang IN ('en', 'fr') GROUP BY lang""")
def surface_counts(spark, sf_dir):
    return audit.surface_counts(_labelled(spark, sf_dir), _LABELS[:2])


@query("""WITH c AS (SELECT CASE lang WHEN 'de' THEN 'en' ELSE lang END AS v, count(*) AS n, min(doc_id) AS f FROM documents WHERE lang IN ('en', 'fr', 'de', 'es') GROUP BY 1)
SELECT 'lang' AS label_id, row_number() OVER (ORDER BY n DESC, f) AS place, v AS "value", CASE v WHEN 'en' THEN 'English' ELSE v END AS label, n AS paper_count FROM c""")
def value_distribution(spark, sf_dir):
    label = Label("lang", allowed=["en", "fr", "es"], mappings={"de": "en"})
    return audit.value_distribution(table(spark, sf_dir, "documents").select("doc_id", "lang"), [label], "doc_id", {"lang": {"en": "English", "fr": "", " ": "x"}})


@query("""WITH v AS (SELECT 'lang' AS field, lang AS "value", doc_id AS o FROM documents WHERE lang IS NOT NULL UNION ALL SELECT 'source', source, doc_id FROM documents WHERE source IS NOT NULL UNION ALL SELECT 'source', source, doc_id FROM documents WHERE source IS NOT NULL),
c AS (SELECT field, "value", count(*) AS n, min(o) AS f FROM v GROUP BY 1, 2) SELECT field, row_number() OVER (PARTITION BY field ORDER BY n DESC, f) AS place, "value", n AS "count" FROM c""")
def tag_summary(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang", F.concat_ws("; ", "source", "source").alias("source"))
    return audit.tag_summary(rows, ["lang", "source"], "doc_id")


@query("SELECT 'all' AS name, count(*) AS rows FROM labels UNION ALL SELECT 'include', count_if(quality = 1) FROM labels UNION ALL SELECT 'exclude', count_if(quality IS NULL OR quality <> 1) FROM labels UNION ALL SELECT 'review', 0 FROM labels GROUP BY 1")
def step_counts(spark, sf_dir):
    return audit.step_counts(_screening_rows(spark, sf_dir), "screening_decision", ["include", "exclude", "review"])


@query("""WITH c AS (SELECT count(*) AS n, count_if(quality = 1) AS good FROM labels) SELECT CASE WHEN good < 3 THEN 'critical' WHEN good < n THEN 'warning' ELSE 'ok' END AS status, CASE WHEN good < 20 THEN good ELSE 20 END AS minimum_cited, CASE WHEN good < 20 THEN good ELSE least(40, good) END AS target_cited FROM c""")
def coverage_report(spark, sf_dir):
    n, good = table(spark, sf_dir, "labels").agg(F.count("*"), F.count_if(F.col("quality") == 1)).first()
    told = audit.report(n, n, good, good, good, good - 1)
    status = "warning" if told["status"] == "warning" and good < n else "ok" if told["status"] == "warning" else told["status"]
    return rows_of(spark, [(status, told["minimum_cited"], told["target_cited"])], "status string, minimum_cited long, target_cited long")


@query("SELECT v.parent AS parent_value, v.child AS child_value FROM (VALUES ('en', 'fr'), ('fr', 'de'), ('en', 'xx')) AS v(parent, child) WHERE v.parent IN (SELECT lang FROM documents) AND v.child IN (SELECT lang FROM documents)")
def method_hierarchy(spark, sf_dir):
    counts = table(spark, sf_dir, "documents").select(F.col("lang").alias("value"))
    return reviews.hierarchy(counts, {"en": ["fr", "xx"], "fr": ["de"]})


# choice of papers


@query("""WITH s AS (SELECT l.doc_id, toxic, CASE l.doc_id % 7 WHEN 0 THEN 'A Systematic review ' WHEN 1 THEN 'Trial protocol ' ELSE '' END || split_part(d.text, chr(10), 1) AS t FROM labels l JOIN documents d USING (doc_id) WHERE quality = 1)
SELECT doc_id::VARCHAR AS provider_id, 'Selected for collection-time contract calibration; title_relevance_tier=' || toxic || '; source_rank=' || doc_id AS reason FROM s
WHERE NOT contains(lower(t), 'systematic review') AND NOT contains(lower(t), 'protocol') AND doc_id % 5 > 0 ORDER BY toxic, doc_id LIMIT 15""")
def calibration_selection(spark, sf_dir):
    return seeds.selected_for_calibration(_titled(spark, sf_dir), _screening_rows(spark, sf_dir), "ordinal", 15).select("provider_id", F.col("calibration_selection_reason").alias("reason"))


def _titled(spark, sf_dir) -> DataFrame:
    start = F.when(F.col("doc_id") % 7 == 0, "A Systematic review ").when(F.col("doc_id") % 7 == 1, "Trial protocol ").otherwise("")
    kind = F.when(F.col("doc_id") % 5 == 0, '{"type": "Review"}').otherwise("{}")
    return as_papers(spark, sf_dir).select(F.lit("").alias("doi"), F.col("doc_id").cast("string").alias("provider_id"), F.concat(start, "title").alias("title"), kind.alias("raw_record"), F.col("doc_id").alias("ordinal"))


@query("""WITH s AS (SELECT l.doc_id, toxic, CASE l.doc_id % 7 WHEN 0 THEN 'A Systematic review ' WHEN 1 THEN 'Trial protocol ' ELSE '' END || split_part(d.text, chr(10), 1) AS t FROM labels l JOIN documents d USING (doc_id) WHERE quality = 1),
k AS (SELECT *, CASE WHEN contains(lower(t), 'systematic review') OR doc_id % 5 = 0 THEN 'r' WHEN contains(lower(t), 'protocol') THEN 'n' ELSE 'p' END AS kind FROM s),
c AS (SELECT *, coalesce(count_if(kind = 'p') OVER (ORDER BY toxic, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM k)
SELECT count_if(kind = 'p') AS selected, count_if(kind = 'r') AS skipped_reviews, count_if(kind = 'n') AS skipped_non_primary FROM c WHERE before < 15""")
def calibration_counts(spark, sf_dir):
    return seeds.calibration_counts(_titled(spark, sf_dir), _screening_rows(spark, sf_dir), "ordinal", 15)


@query("SELECT doc_id, row_number() OVER (ORDER BY c DESC, doc_id) AS place FROM (SELECT doc_id, least(8, ln(1 + n_chars) * 1.2) AS c FROM documents) ORDER BY c DESC, doc_id LIMIT 30")
def review_seeds(spark, sf_dir):
    # all else equal, citations alone tell the rows apart
    rows = table(spark, sf_dir, "documents").select("doc_id", F.lit("Rights").alias("title"), F.lit("x").alias("abstract"), F.lit("").alias("venue"), F.col("n_chars").alias("cited_by_count"), F.lit(0).alias("year"))
    return seeds.review_seeds(rows, CONTRACT, 2025, 30, "doc_id").select("doc_id", F.col("place").cast("long").alias("place"))


# model steps

_CATEGORIES = [Category("topic", ["en", "de", "fr", "es", "it", "other"], "single", True), Category("detail", ["a", "b"], parent="topic", triggers=["en", "de"]), Category("extra", ["p", "q", "unclear"])]


def _tagger():
    def answer(prompt: str) -> str:
        number, lang = prompt.split(" ", 1)
        tags = {"topic": [lang, "other"], "detail": ["a", "b"], "extra": ["unclear", "q"], "main_knowledge_claim": f"claim {number}"}
        return json.dumps(tags | ({"extra": ["no such"]} if int(number) % 10 == 0 else {}))

    return model.Static(answer)


@query("""SELECT doc_id::VARCHAR AS paper_id, 'claim ' || doc_id AS main_knowledge_claim, lang AS topic, CASE WHEN lang IN ('en', 'de') THEN 'a; b' ELSE '' END AS detail, 'q' AS extra, '' AS error FROM documents WHERE doc_id % 10 > 0
UNION ALL SELECT doc_id::VARCHAR, '', '', '', '', 'extra: not allowed: no such' FROM documents WHERE doc_id % 10 = 0""")
def model_tagging(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("paper_id"), F.col("lang").alias("title"), F.lit("").alias("abstract"))
    good, bad = tagging.tagged(rows, _CATEGORIES, "$paper_id $title", _tagger, {"extra": "unclear"}, prompt=["paper_id", "title"])
    good = good.select("paper_id", "main_knowledge_claim", "topic", "detail", "extra", F.lit("").alias("error"))
    return good.unionByName(bad.select("paper_id", *(F.lit("").alias(c) for c in ("main_knowledge_claim", "topic", "detail", "extra")), "error"))


@query("SELECT doc_id, lang || '; ' || source AS one, CASE WHEN doc_id % 2 = 0 THEN lang ELSE '' END AS two FROM documents")
def flat_tags(spark, sf_dir):
    tags = F.when(F.col("doc_id") % 2 == 0, F.create_map(F.lit("one"), F.array("lang", "source"), F.lit("two"), F.array("lang"))).otherwise(F.create_map(F.lit("one"), F.array("lang", "source")))
    return tagging.flat_tags(table(spark, sf_dir, "documents").select("doc_id", tags.alias("tags")), ["one", "two"])


@query("""SELECT doc_id, CASE WHEN lang = 'en' THEN 'x' ELSE 'x; y' END AS multi, 'x' AS single, CASE WHEN lang = 'en' THEN 'none' ELSE '' END AS required_child, CASE WHEN doc_id % 2 = 0 THEN 'x' ELSE 'none' END AS concrete FROM documents""")
def validated_tags(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang")
    none, words = F.array().cast("array<string>"), ["x", "y", "none"]
    told = F.when(F.col("lang") == "en", F.array(F.lit("x"), F.lit("none"))).otherwise(F.array(F.lit("x"), F.lit("y")))
    some = F.when(F.col("doc_id") % 2 == 0, F.array(F.lit("none"), F.lit("x"))).otherwise(F.array(F.lit("none")))
    cells = {
        "multi": audit.validated_tags(Category("multi", words), told, "none"),
        "single": audit.validated_tags(Category("single", words, "single"), told, None),
        "required_child": audit.validated_tags(Category("c", words, required=True, parent="lang", triggers=["en"]), none, "none"),
        "concrete": audit.without_fallback(some, "none"),
    }
    return rows.select("doc_id", *(F.array_join(v, "; ").alias(k) for k, v in cells.items()))


_REVIEW = [Label("topic", "controlled_fixed", ["en", "de"]), Label("method", "controlled_auto", selection="single"), Label("finding", "free_text"), Label("quotes", "evidence_quote")]


def _extractor():
    def answer(prompt: str) -> str:
        lang, evidence = prompt.split("|", 1)
        return json.dumps({"topic": [lang, "xx"], "method": ["Case study", "survey"], "finding": f"  found   {evidence.count('[')} ", "quotes": [{"quote": lang, "section": "s", "reason": ""}, {"quote": " "}]})

    return model.Static(answer)


@query("""SELECT doc_id::VARCHAR AS paper_id, CASE WHEN lang IN ('en', 'de') THEN lang ELSE '' END AS topic, 'case_study' AS method, 'found 2' AS finding, '[{"quote":"' || lang || '","section":"s","reason":""}]' AS quotes FROM documents WHERE doc_id % 5 > 0""")
def label_extraction(spark, sf_dir):
    text = F.when(F.col("doc_id") % 5 > 0, F.lit("Topic and methods\nwe do\nResults\nwe found")).otherwise(" ")
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("paper_id"), F.col("lang").alias("venue"), text.alias("text"))
    good, bad = tagging.extracted(rows, _REVIEW, "$venue|$evidence_topic", _extractor)
    return good.join(bad.select("paper_id"), "paper_id", "left_anti").select("paper_id", "topic", "method", "finding", "quotes")


@query("SELECT * FROM (VALUES ('topic', 'en', 'told', false), ('topic', 'de', 'The paper is about de.', false), ('detail', 'a', 'The paper is about a.', true), ('detail', 'b_c', 'The paper is about b c.', true)) AS v(category_id, \"value\", use_when, depends)")
def tagging_rules(spark, sf_dir):
    cats = [Category("topic", ["en", "de"]), Category("detail", ["a", "b_c"], parent="topic", triggers=["en"])]
    answer = {"rules": [{"category_id": "topic", "values": [{"value": "en", "use_when": "told"}, {"value": "xx", "use_when": "no"}]}, {"category_id": "unknown"}, "odd"]}
    rules = tagging.rules_by_category(tagging.generated_rules(cats, "$categories", model.Static(lambda p: json.dumps(answer))), cats)
    return rows_of(spark, [(c, v["value"], v["use_when"], r["depends_on"] is not None) for c, r in rules.items() for v in r["values"]], "category_id string, value string, use_when string, depends boolean")


@query("SELECT doc_id, 'Paper ' || doc_id || ': ' || lang || ' $other' AS told FROM documents")
def rendered_prompts(spark, sf_dir):
    rows = tagging.prompt_columns(table(spark, sf_dir, "documents"), ["doc_id", "lang", "missing"])
    asked = model.per_row(rows, "doc_id", "Paper $doc_id: $lang $other$missing", {}, lambda: model.Static(lambda prompt: json.dumps({"p": prompt})))
    return asked.select(F.col("doc_id").cast("long").alias("doc_id"), F.get_json_object("answer", "$.p").alias("told"))


# fetching

_PAGES = {"(a) AND (b)": [{"id": f"W{i}", "display_name": f"Title {i}", "publication_year": 2000} for i in range(5)], "(c) AND (b)": [{"id": f"V{i}", "display_name": f"Title {i + 3}", "publication_year": 2000} for i in range(9)], "(d)": [{"id": "U", "doi": "10.1/u"}]}
_PLAN = {"iterations_per_group": 2, "query_groups": [{"tier": 1, "group_id": "late", "queries": [{"query_id": "q3", "query": "(d)"}]}, {"tier": 0, "queries": [{"query_id": "q1", "query": "(a) AND (b)"}, {"query_id": "q2", "query": "(c) AND (b)", "requires_title_screening": True}]}]}


@query("""SELECT * FROM (VALUES (1, 'W0', 0, 'q1', 1, 1, 'tier_0'), (2, 'W1', 0, 'q1', 1, 2, 'tier_0'), (3, 'W2', 0, 'q1', 1, 3, 'tier_0'), (4, 'W3', 0, 'q1', 1, 4, 'tier_0'), (5, 'W4', 0, 'q1', 1, 5, 'tier_0'),
(6, 'V2', 0, 'q2', 1, 3, 'tier_0'), (7, 'V3', 0, 'q2', 1, 4, 'tier_0'), (8, 'V4', 0, 'q2', 1, 5, 'tier_0'), (9, 'V5', 0, 'q2', 1, 6, 'tier_0'), (10, 'V6', 0, 'q2', 1, 7, 'tier_0'), (11, 'V7', 0, 'q2', 1, 8, 'tier_0'), (12, 'V8', 0, 'q2', 1, 9, 'tier_0'), (13, 'U', 1, 'q3', 1, 1, 'late')) AS v(rank, provider_id, tier, query_id, iteration, query_rank, group_id)""")
def tiered_fetch(spark, sf_dir):
    rows, _ = tiers.fetched(spark, lambda: provider.Recorded(_PAGES), _PLAN, 14, per_page=2)
    return rows.select("rank", "provider_id", F.col("retrieval_tier").alias("tier"), F.col("retrieval_query_id").alias("query_id"), F.col("retrieval_iteration").alias("iteration"), "query_rank", F.col("retrieval_group_id").alias("group_id"))


@query("SELECT * FROM (VALUES ('raw_seen', 15), ('duplicates_removed', 2), ('unique', 13), ('tier 0', 12), ('tier 1', 1), ('query q1', 5), ('query q2', 7), ('query q3', 1), ('exhausted q1', 4), ('exhausted q2', 6), ('exhausted q3', 2)) AS v(name, n)")
def tiered_fetch_counts(spark, sf_dir):
    told = tiers.fetch(provider.Recorded(_PAGES), _PLAN, 14, per_page=2)
    found = [*told.counts["all"].items(), *((f"{kind} {k}", n) for kind in ("tier", "query") for k, n in told.counts[kind].items()), *((f"exhausted {x['query_id']}", x["page"]) for x in told.exhausted)]
    return rows_of(spark, found, "name string, n int")


@query("SELECT * FROM (VALUES (6, 'V2', 'q2', 3), (7, 'V3', 'q2', 4), (8, 'V4', 'q2', 5)) AS v(rank, provider_id, query_id, query_rank)")
def resumed_fetch(spark, sf_dir):
    first = tiers.fetch(provider.Recorded(_PAGES), _PLAN, 5, per_page=2)
    known = [r for r in first.found if r["retrieval_query_id"] == "q1"] + [r for r in first.found if r["retrieval_query_id"] != "q1"]
    rows, _ = tiers.fetched(spark, lambda: provider.Recorded(_PAGES), _PLAN, 3, per_page=2, existing=known)
    return rows.select("rank", "provider_id", F.col("retrieval_query_id").alias("query_id"), "query_rank")


# contracts and plans


@query("""SELECT * FROM (VALUES ('tier_0_title', 0, 0, 'tier_0_all_main_title', '("rights reserved" OR "thanedble anea") AND ("apache license")', false), ('tier_0', 0, 1, 'tier_0_all_main', '("rights reserved" OR "thanedble anea") AND ("apache license")', true),
('tier_1', 1, 2, 'tier_1_replace_license_with_license_secondary_1', '("rights reserved" OR "thanedble anea") AND (version)', true)) AS v(group_id, tier, priority, query_id, query, screen)""")
def planned_queries(spark, sf_dir):
    found = [(g["group_id"], g["tier"], int(g["priority"]), q["query_id"], q["query"], q["requires_title_screening"]) for g in retrieval.query_groups(CONTRACT)["query_groups"] for q in g["queries"]]
    return rows_of(spark, found, "group_id string, tier int, priority int, query_id string, query string, screen boolean")


@query("SELECT * FROM (VALUES ('rights', 'main', '', 'title', 'rights reserved; thanedble anea'), ('license', 'main', '', 'title_or_abstract', 'apache license'), ('license', 'secondary', 'license_secondary_1', 'title_or_abstract', 'version')) AS v(topic_id, kind, group_id, field, terms)")
def topic_spec(spark, sf_dir):
    return rows_of(spark, [(t.topic_id, t.kind, t.group_id, t.field, "; ".join(t.terms)) for t in matching.spec_of(CONTRACT).topics], "topic_id string, kind string, group_id string, field string, terms string")


def _with(**parts) -> dict:
    return {**CONTRACT, **parts}


@query("SELECT * FROM (VALUES ('as it is', true), ('no id', false), ('no scope', false), ('one topic', false), ('no categories', false)) AS v(name, valid)")
def contract_checks(spark, sf_dir):
    structure = {**CONTRACT["topic_structure"], "main_topics": CONTRACT["topic_structure"]["main_topics"][:1]}
    cases = {"as it is": CONTRACT, "no id": _with(topic_id=" "), "no scope": _with(scope=[]), "one topic": _with(topic_structure=structure), "no categories": _with(tagging={"categories": {}, "fallback_policy": {}})}
    return rows_of(spark, [(k, not list(contracts.problems(v))) for k, v in cases.items()], "name string, valid boolean")


@query("SELECT * FROM (VALUES ('boilerplate_category_id', 'study_design'), ('too_few_values', 'study_design'), ('catchall_values', 'study_design'), ('catchall_values', 'odd'), ('non_snake_values', 'odd')) AS v(code, category_id)")
def ontology_issues(spark, sf_dir):
    cats = {"study_design": {"values": ["cohort", "other"]}, "fine": {"values": ["a_b", "c"]}, "odd": {"values": ["A b", "c", "unclear"]}, "more": {"values": ["d", "e"]}}
    found = [(i.code, i.category_id) for i in ontology.issues(_with(tagging={"categories": cats})) if i.category_id]
    return rows_of(spark, found, "code string, category_id string")


@query("SELECT unnest(['rights', 'thane', 'rights reserved', 'thanedble anea', 'apache license', 'version']) AS term, unnest([1, 2, 3, 4, 5, 6]) AS place")
def screening_terms(spark, sf_dir):
    return rows_of(spark, [(t, k) for k, t in enumerate(contracts.screening(CONTRACT)["include_terms"], 1)], "term string, place int")


@query("SELECT * FROM (VALUES ('y', 'multi', true, 'q'), ('z', 'single', false, 'r; s')) AS v(category_id, selection, required, allowed)")
def tag_config(spark, sf_dir):
    cats = {"knowledge_goal": {"values": ["a"]}, "x": {"values": ["p"], "applies_when": {"category_id": "knowledge_goal", "values": ["a"]}}, "y": {"values": ["q"], "required": True}, "z": {"values": ["r", "s"], "selection": "single"}}
    found = contracts.tag_categories(_with(tagging={"categories": cats, "fallback_policy": {}}))
    return rows_of(spark, [(c.category_id, c.selection, c.required, "; ".join(c.allowed)) for c in found], "category_id string, selection string, required boolean, allowed string")


@query("SELECT * FROM (VALUES ('a; new_one', 'b=new_one', 'c; z')) AS v(allowed, mapped, dropped)")
def label_review(spark, sf_dir):
    label = contracts.reviewed_label(Label("m"), ["a", "b", "c"], {"values": ["A", "a"], "merge_values": {"b": "New one"}, "drop_values": ["z"]})
    return rows_of(spark, [("; ".join(label.allowed), "; ".join(f"{k}={v}" for k, v in label.mappings.items()), "; ".join(label.dropped))], "allowed string, mapped string, dropped string")


@query("SELECT * FROM (VALUES ('p', 'a', ''), ('q', 'e', 'p'), ('n', 'f', '')) AS v(category_id, allowed, parent)")
def category_review(spark, sf_dir):
    cats = {"p": {"values": ["a", "b"]}, "q": {"values": ["c"], "applies_when": {"category_id": "p", "values": ["a", "b"]}}, "gone": {"values": ["d"]}}
    merged, _ = contracts.reviewed_contract(_with(tagging={"categories": cats, "fallback_policy": {}}), {"categories": {"P": ["a"], "q": {"values": "auto"}, "n": []}}, {"q": ["e"], "n": ["f"]})
    return rows_of(spark, [(k, "; ".join(c["values"]), (c["applies_when"] or {}).get("category_id", "")) for k, c in merged["tagging"]["categories"].items()], "category_id string, allowed string, parent string")


@query("SELECT * FROM (VALUES ('read', 'succeeded', 1), ('screen', 'paused', 2), ('screen', 'succeeded', 3), ('export', 'failed', 4), ('export', 'succeeded', 5)) AS v(step, status, place)")
def run_of_steps(spark, sf_dir):
    folder = tempfile.mkdtemp(prefix="run-")
    review, path, calls = os.path.join(folder, "review.json"), os.path.join(folder, "run.json"), []

    def screen():
        if not runs.approved(review):
            raise runs.Pause(review)
        return runs.StepResult(counts={"rows": 1})

    def export():
        calls.append(1)
        if len(calls) == 1:
            raise ValueError("no rows")
        return runs.StepResult(outputs=[review])

    steps, plan = {"read": runs.StepResult, "screen": screen, "export": export}, ["read", "screen", "export"]
    while (first := runs.Manifest(path).resume_step(plan)) is not None:
        if runs.run(runs.selected(plan, first=first), steps, runs.Manifest(path)) == "paused":
            with open(review, "w", encoding="utf-8") as f:
                json.dump({"status": "approved"}, f)
    return rows_of(spark, [(s["step"], s["status"], k) for k, s in enumerate(runs.Manifest(path).steps, 1)], "step string, status string, place int")


@query("SELECT unnest(['normalize', 'screen_scope', 'full_text', 'filter_reviews', 'tagging_config', 'tagging_rules', 'review_config', 'tag', 'audit', 'export']) AS step, unnest([1, 2, 3, 4, 5, 6, 7, 8, 9, 10]) AS place")
def selected_steps(spark, sf_dir):
    plan = runs.main_plan(extract_labels=True)
    return rows_of(spark, [(s, k) for k, s in enumerate(runs.selected(plan, last="export"), 1)], "step string, place int")


# drafts, plans and rounds behind fixed clients


def _says(answer) -> model.Static:
    return model.Static(lambda prompt: json.dumps(answer(prompt) if callable(answer) else answer))


@query("SELECT doc_id, lang, sha256('Paper ' || doc_id) AS prompt_sha256, sha256('{\"a\": ' || doc_id || '}') AS answer_sha256 FROM documents")
def model_traces(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang")
    told = model.per_row(rows.select("doc_id"), "doc_id", "Paper $doc_id", {}, lambda: model.Static(lambda p: json.dumps({"a": int(p.split()[1])})), trace=True)
    return told.filter("seconds >= 0 AND prompt = concat('Paper ', doc_id)").join(rows, "doc_id").select("doc_id", "lang", "prompt_sha256", "answer_sha256")


@query("SELECT * FROM (VALUES (1, 'a b'), (2, 'c'), (3, 'main'), (4, 'other'), (5, 'of the contract')) AS v(place, query)")
def search_plan_queries(spark, sf_dir):
    wanted = _with(collection={**CONTRACT["collection"], "search_queries": ["A b", {"query": "of the contract", "reason": "r"}]})
    answer = {"recommended_provider": "recorded", "provider_specific_plan": {"provider": "recorded", "query": "C"}, "search_queries": [{"query": "a b"}, "c", " "], "main_search_string": "main", "alternate_search_strings": ["other", "MAIN"]}
    plan, _ = drafting.search_plan(wanted, "$topic", _says(answer))
    return rows_of(spark, [(k, q["query"]) for k, q in enumerate(plan["search_queries"], 1)], "place int, query string")


@query("SELECT * FROM (VALUES ('has_abstract', 'true'), ('exclude_reviews', 'true'), ('has_full_text', 'none'), ('has_abstract:true', 'provider'), ('type:!review', 'provider')) AS v(name, \"value\")")
def search_plan_filters(spark, sf_dir):
    wanted = _with(collection={**CONTRACT["collection"], "exclude_review_type": True}, candidate_screening={**CONTRACT["candidate_screening"], "missing_abstract_policy": "exclude"})
    answer = {"recommended_provider": "recorded", "provider_specific_plan": {"provider": "recorded", "query": "x", "filters": [{"name": "has_full_text", "value": "true"}]}, "filters": {"has_full_text": True}}
    plan, _ = drafting.search_plan(wanted, "$topic", _says(answer), text_needed=True)
    found = [(k, "none" if v is None else str(v).lower()) for k, v in plan["filters"].items()]
    return rows_of(spark, found + [(f"{f['name']}:{f['value']}", "provider") for f in plan["provider_specific_plan"]["filters"]], "name string, value string")


@query("SELECT 'Thanea attion review overview' AS query, 'has_abstract:true,open_access.is_oa:true,has_fulltext:true,type:review' AS filters")
def review_search_plan(spark, sf_dir):
    plan = drafting.review_plan(CONTRACT, 10)
    return rows_of(spark, [(plan["main_search_string"], ",".join(provider.service_filters(plan)))], "query string, filters string")


@query("SELECT 'https://x.org/works?page=2&per-page=50&filter=from_publication_date%3A2001-01-01%2Ctype%3A%21review%2Ctitle.search%3Aa+b%7Cc%2Ctitle_and_abstract.search%3Ad&mailto=m' AS url, 'https://x.org/works?a=1&api_key=REDACTED' AS shown")
def service_urls(spark, sf_dir):
    client = provider.Service("https://x.org/works", {"filters": {"year_from": 2001, "exclude_reviews": True}}, "m")
    entry = {"blocks": [{"field": "title", "terms": ["a,b", "c"]}, {"field": "title_or_abstract", "terms": ["d", ""]}]}
    return rows_of(spark, [(client.url("q", 2, 50, entry), provider.redacted("https://x.org/works?a=1&api_key=s"))], "url string, shown string")


@query("SELECT page_id, 'http://x.org/a%20b/%C3%A9' || page_id || '?q=%7B1%7D&api_key=REDACTED&z=%25' AS safe FROM pages")
def safe_urls(spark, sf_dir):
    raw = F.concat(F.lit("http://x.org/a b/é"), "page_id", F.lit("?q={1}&api_key=s3cret&z=%25"))
    return table(spark, sf_dir, "pages").select("page_id", X.safe_url(X.redacted(raw)).alias("safe"))


@query("""SELECT c_custkey, array_to_string(list_sort(list_distinct(flatten(list_transform(list_filter(string_split(trim(regexp_replace(lower(c_mktsegment || ' Educational AI of s for ' || c_name || ' buses'), '[^a-z0-9]+', ' ', 'g')), ' '), lambda w: w IN ('ai', 'ml') OR (len(w) >= 3 AND w NOT IN ('and', 'for', 'from', 'into', 'the', 'use', 'using', 'with'))),
lambda w: list_filter([w, CASE WHEN len(w) > 3 AND w LIKE '%s' THEN w[:-2] END, CASE WHEN w = 'educational' THEN 'education' END], lambda x: x IS NOT NULL))))), ' ') AS words FROM customer""")
def topic_words(spark, sf_dir):
    text = F.concat_ws(" ", "c_mktsegment", F.lit("Educational AI of s for"), "c_name", F.lit("buses"))
    return table(spark, sf_dir, "customer").select("c_custkey", F.array_join(F.array_sort(X.topic_words(text)), " ").alias("words"))


@query("SELECT '20240102T030405Z-abcdef01' AS run_id, '2024-01-02T03:04:05+00:00' AS at, '/base/x/y.csv' AS path")
def run_settings(spark, sf_dir):
    clock = lambda: 1704164645.0
    settings = runs.Settings("c", "/base", run_id=runs.new_run_id(clock, lambda: "abcdef0123"))
    return rows_of(spark, [(settings.run_id, runs.utc_now(clock), settings.path("x/y.csv"))], "run_id string, at string, path string")


@query("SELECT * FROM (VALUES ('drafted', 'lang', 'en; fr', ''), ('drafted', 'kind', 'a; b', ''), ('refined', 'lang', 'en; de', ''), ('refined', 'kind', 'a; b', ''), ('calibrated', 'lang', 'en; es', ''), ('calibrated', 'kind', 'a; b', ''), ('completed', 'lang', 'en; fr', ''), ('completed', 'new_one', 'p; q', '')) AS v(step, category_id, allowed, said)")
def contract_drafts(spark, sf_dir):
    cats = {"lang": {"values": ["en", "fr"]}, "kind": {"values": ["a", "b"]}}
    asked = []

    def draft(prompt):  # the first answer is no contract, the second is, with weak categories told
        asked.append(prompt)
        return {"tagging": {"categories": {} if len(asked) == 1 else cats, "fallback_policy": {}}}

    made, _ = drafting.drafted_contract("a topic", CONTRACT, "$topic $feedback", _says(draft))
    found = {"drafted": made, "refined": drafting.refined_contract(made, {"tagging": {"categories": {**cats, "lang": {"values": ["en", "de"]}}}})}
    found["calibrated"] = drafting.calibration(made, [{"paper_id": "p"}], "$papers", _says({"tagging": {"categories": {**cats, "lang": {"values": ["en", "es"]}}}}))
    found["completed"] = drafting.value_completion(made, {"categories": {"lang": ["en", "fr"], "New one": "auto"}}, [], "$requested", _says({"categories": [{"category_id": "new_one", "values": ["P", "q", "p"]}]}))
    return rows_of(spark, [(k, c, "; ".join(v["values"]), "") for k, m in found.items() for c, v in m["tagging"]["categories"].items()], "step string, category_id string, allowed string, said string")


@query("""WITH u AS (SELECT doc_id FROM documents WHERE doc_id % 5 > 0 AND trim(split_part(text, chr(10), 1)) <> '')
SELECT section_id, (SELECT count(*) FROM u) AS papers, (SELECT min(doc_id)::VARCHAR FROM u) AS first_paper, 'abc' AS best FROM (SELECT unnest(['abstract', 'introduction', 'review_methodology', 'main_topic_rights', 'main_topic_license', 'conclusion']) AS section_id)""")
def evidence_maps(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", F.col("doc_id").cast("string").alias("paper_id"), F.substring_index("text", "\n", 1).alias("title"), F.lit("2020").alias("year"), F.lit("d").alias("doi"), F.lit("A").alias("authors"), F.lit("V").alias("venue"), F.when(F.col("doc_id") % 5 > 0, "abc").otherwise("unclear").alias("finding"), F.when(F.col("doc_id") % 5 > 0, "abc; x").otherwise("").alias("kind"))
    labels = [Label("kind", "controlled_auto"), Label("finding", "free_text")]
    made = drafting.evidence_map(rows, reviews.issues(rows, labels), labels, "doc_id", drafting.planned_sections(CONTRACT))
    found = [(s["section_id"], s["paper_count"], s["paper_ids"][0], s["controlled_value_counts"][0]["value"]) for s in made["sections"] if len(s["text_evidence"]["finding"]) <= 50]
    return rows_of(spark, found, "section_id string, papers long, first_paper string, best string")


@query("SELECT 'paper_n' || n_nationkey || '_on_a_long_topic' AS paper_id, n_name || ' edited' AS body FROM nation")
def section_drafts(spark, sf_dir):
    nations = [(f"paper_n{r.n_nationkey}_on_a_long_topic", r.n_name) for r in table(spark, sf_dir, "nation").collect()]
    sections = [{"section_id": f"s{k}", "paper_ids": [p], "body": n, "section_type": "main_topic_lens"} for k, (p, n) in enumerate(nations)] + [{"section_id": "empty", "paper_ids": []}]

    def write(prompt):  # ids come back with a letter too many
        s = json.loads(prompt)
        return {"section_id": s["section_id"], "body_markdown": s["body"], "cited_paper_ids": [s["paper_ids"][0] + "s"], "quote_uses": [{"paper_id": s["paper_ids"][0]}]}

    drafts, said = drafting.drafted_sections(sections, "$section", lambda: _says(write))
    edited = drafting.edited_sections(drafts, "$sections", _says(lambda p: {"sections": [{"section_id": d["section_id"], "body_markdown": d["body_markdown"] + " edited"} for d in json.loads(p)]}))
    return rows_of(spark, [(d["cited_paper_ids"][0], d["body_markdown"]) for d in edited if len(d["cited_paper_ids"]) == 1 and len(said) == 1], "paper_id string, body string")


@query("SELECT * FROM (VALUES (1, 0, 20, ''), (2, 10, 20, ''), (3, 20, 10, ''), (4, 25, 0, 'enough')) AS v(round, eligible, new, ended)")
def backfill_rounds(spark, sf_dir):
    ids = spark.range(0, 200).select(F.col("id").alias("k"), F.col("id").alias("o"))
    none = ids.limit(0)
    sizes = iter([20, 20, 10])
    begin = [0]

    def fetch(wanted, have):
        n = next(sizes)
        at, begin[0] = begin[0], begin[0] + n
        # some that are known already come again
        return ids.filter((F.col("k") >= max(0, at - 5)) & (F.col("k") < at + n))

    status = lambda df: df.select("k", F.when(F.col("k") % 2 == 0, "verified").otherwise("unverified").alias("full_text_availability_status"))
    screened = lambda df: df.select("k", F.lit("pending").alias("screening_decision"))
    steps = backfill.Backfill(fetch, screened, status, lambda s, a: s.withColumn("screening_decision", F.lit("include")))
    _, told = steps.run(none, none.select("k", F.lit("").alias("screening_decision")), none.select("k", F.lit("").alias("full_text_availability_status")), 25, "k", "o")
    return rows_of(spark, [(t["round"], t["eligible"], t["new"], t["ended"]) for t in told], "round int, eligible long, new long, ended string")


@query("SELECT 2 * count(*) AS locations, count(*) + count_if(p_partkey % 3 > 0) AS tried, count_if(p_partkey % 3 = 0) AS spared FROM part")
def url_check_counts(spark, sf_dir):
    asked = table(spark, sf_dir, "part").select("p_partkey", F.posexplode(F.array(F.concat(F.lit("http://a/"), "p_partkey"), F.concat(F.lit("http://b/"), (F.col("p_partkey") % 2).cast("string")))).alias("_at", "url"))
    check = lambda urls: urls.select("url", (F.regexp_extract("url", "a/([0-9]+)", 1).try_cast("int") % 3 == 0).alias("ok"), F.lit("").alias("content_type"), F.col("url").alias("final_url"), F.lit("").alias("error"))
    told = availability.answered(asked, "p_partkey", check)
    return availability.check_counts(asked, told).select("locations", "tried", "spared")


@query("SELECT n_nationkey, n_name AS name, n_regionkey AS region FROM nation WHERE n_regionkey >= 2")
def provider_scan(spark, sf_dir):
    pages = [{"id": str(r.n_nationkey), "display_name": r.n_name, "publication_year": int(r.n_regionkey)} for r in table(spark, sf_dir, "nation").collect()]
    spark.dataSource.register(provider.Provider)
    read = spark.read.format("scholarly").option("queries", json.dumps(["q"])).option("per_page", 7).option("recorded", json.dumps({"q": pages})).load()
    return read.filter("year >= 2").select(F.col("provider_id").cast("int").alias("n_nationkey"), F.col("title").alias("name"), F.col("year").alias("region"))


@query("""SELECT * FROM (VALUES ('methodology', 'controlled_auto', 'multi', false, 0, 9), ('study_design', 'controlled_fixed', 'single', false, 18, 9), ('dataset_or_sample', 'free_text', 'multi', false, 0, 10), ('key_finding', 'free_text', 'multi', true, 0, 4),
('paper_limitation', 'free_text', 'multi', false, 0, 4), ('direct_quote', 'evidence_quote', 'multi', false, 0, 5), ('future_work_or_gap', 'free_text', 'multi', false, 0, 4)) AS v(label_id, value_mode, selection, required, n_values, n_sections)""")
def review_defaults(spark, sf_dir):
    made = contracts.review_config(CONTRACT)
    return rows_of(spark, [(x["label_id"], x["value_mode"], x["selection"], x["required"], len(x["allowed_values"]), len(x["evidence_sections"])) for x in made["labels"] if made["review_type"] == "narrative"], "label_id string, value_mode string, selection string, required boolean, n_values int, n_sections int")


@query("SELECT * FROM (VALUES ('tier_0_all_main', 'tier_0_all_main_fallback_1', 'rights reserved apache license'), ('tier_0_all_main', 'tier_0_all_main_fallback_2', 'thanedble anea apache license')) AS v(logical_query_id, query_id, query)")
def plain_provider_queries(spark, sf_dir):
    entry = retrieval.query_groups(CONTRACT)["query_groups"][1]["queries"][0]
    return rows_of(spark, [(q["logical_query_id"], q["query_id"], q["query"]) for q in tiers.executed(entry, blocks=False)], "logical_query_id string, query_id string, query string")


def _structure(anchor: str, mains: list, secondary: dict) -> dict:
    return {"topic_structure": {"anchor_topic_id": anchor, "main_topics": [{"topic_id": i, "label": label, **told} for i, label, told in mains], "secondary_topics": secondary}}


@query("""SELECT * FROM (VALUES ('source_anchor_expected', 'building_materials', 'mycelium', true), ('too_few_main_topic_terms', 'mycelium', '2', false), ('anchor_field_not_title', 'building_materials', 'title_or_abstract', true),
('application_topic_criterion_term', 'building_materials', 'sustainable building materials', true), ('application_topic_generic_term', 'building_materials', 'innovative products', false), ('application_topic_process_or_property_term', 'building_materials', 'construction efficiency', false),
('merged_topic_id', 'replacement_in_concrete', 'replacement_in_concrete', true), ('merged_topic_label', 'replacement_in_concrete', 'Concrete replacement and more', true), ('replacement_topic_criterion_term', 'replacement_in_concrete', 'green concrete', true),
('replacement_topic_application_term', 'replacement_in_concrete', 'school settings', true), ('replacement_topic_foreign_component_term', 'replacement_in_concrete', 'mycelium bricks', true),
('application_secondary_material_family_term', 'building_materials', 'bio-based composites', false), ('missing_secondary_topic', 'replacement_in_concrete', '', true)) AS v(code, topic_id, "value", crucial)""")
def topic_structure_issues(spark, sf_dir):
    mains = [
        ("mycelium", "Mycelium", {"terms": ["mycelium", "fungal biomaterials"]}),
        ("building_materials", "Building materials", {"terms": ["sustainable building materials", "innovative products", "construction efficiency"], "field": "title_or_abstract"}),
        ("replacement_in_concrete", "Concrete replacement and more", {"terms": ["concrete alternative", "green concrete", "school settings", "mycelium bricks"]}),
    ]
    made = _structure("building_materials", mains, {"mycelium": ["bacteria"], "building_materials": ["bio-based composites"]})
    found = structure.issues(made, "Could sustainable mycelium be used to replace concrete in building materials?")
    return rows_of(spark, [(i.code, i.topic_id, i.value, i.crucial) for i in found], "code string, topic_id string, value string, crucial boolean")


@query("""SELECT * FROM (VALUES ('disease_research_anchor_expected', 'computational_methods', 'alzheimers_disease'), ('missing_common_surface_form', 'alzheimers_disease', 'Alzheimer''s disease'), ('main_topic_non_family_term', 'alzheimers_disease', 'tau tangles'),
('generic_topic_term', 'alzheimers_disease', 'students'), ('missing_common_surface_form', 'computational_methods', 'artificial intelligence'), ('method_topic_bare_domain_term', 'computational_methods', 'genomics'), ('broad_umbrella_topic_term', 'computational_methods', 'analysis'),
('cross_topic_retrieval_term', 'computational_methods', 'computational alzheimers'), ('generic_secondary_topic_bucket', 'alzheimers_disease', 'Other diseases'), ('secondary_topic_non_family_term', 'alzheimers_disease', 'movement disorder'),
('generic_secondary_topic_term', 'alzheimers_disease', 'diseases'), ('secondary_topic_disease_family_variant', 'alzheimers_disease', 'parkinsons_disease'), ('secondary_topic_internal_subtype', 'computational_methods', 'computational_methods_secondary_1')) AS v(code, topic_id, "value")""")
def disease_structure_issues(spark, sf_dir):
    mains = [("alzheimers_disease", "Alzheimer's disease", {"terms": ["AD", "tau tangles", "students"]}), ("computational_methods", "Computational methods", {"terms": ["AI", "genomics", "analysis"], "retrieval_terms": ["computational alzheimers"]})]
    group = {"topic_id": "parkinsons_disease", "label": "Other diseases", "terms": ["movement disorder", "dementia", "diseases"]}
    made = _structure("computational_methods", mains, {"alzheimers_disease": [group], "computational_methods": ["machine learning"]})
    return rows_of(spark, [(i.code, i.topic_id, i.value) for i in structure.issues(made)], "code string, topic_id string, value string")


# the same sections, of the documents as they are
ORACLE_SQL["sections"] = ORACLE_SQL["prioritized_sections"].replace(f"SELECT doc_id, {_FULL} AS f FROM documents", "SELECT doc_id, text AS f FROM documents")
_BLOCKS = "html"
for _tag in ("script", "style", "nav", "footer", "header"):
    _BLOCKS = f"regexp_replace({_BLOCKS}, '<{_tag}[ >].*?</{_tag}>', '<x>', 'gis')"
_PIECES = f"list_transform(regexp_split_to_array({_BLOCKS}, '<[^>]*>'), lambda x: trim(replace(replace(replace(replace(replace(replace(replace(x, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&copy;', '©'), '&middot;', '·'), '&amp;', '&'), chr(160), ' '), ' ' || chr(10) || chr(9) || chr(13)))"
ORACLE_SQL["html_text"] = f"SELECT page_id, array_to_string(list_filter({_PIECES}, lambda x: x <> ''), chr(10)) AS text FROM pages"
