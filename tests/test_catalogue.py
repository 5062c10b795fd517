"""Every query with SQL gives the same rows in DuckDB."""

import duckdb
import pytest
from biblion.plans import catalogue_parts as catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if v is None or v != v:
        return None
    return f"{v:.9g}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_same_rows(spark, duck, name):
    df = catalogue.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    rows = df.select(*[f"`{c}`" for c in columns]).collect()
    got = sorted((tuple(map(plain, r)) for r in rows), key=str)
    found = duck.execute(catalogue.ORACLE_SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert got == sorted((tuple(plain(r[i]) for i in at) for r in found.fetchall()), key=str)


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLE_SQL)))
def test_runs(spark, name):
    assert catalogue.QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(catalogue.QUERIES) <= set(__spark_entry__.queries())


WIDE_IDS = [(4_000_000_000, "same text"), (3_000_000_000, "Same text."), (1_500_000, "same text"), (5_000_000_000, "alone")]


def over_documents(spark, folder, name, texts):
    """Rows of a query and of its SQL over documents of these ids and texts."""
    data = [(i, t, "en", f"src{n % 2}", len(t)) for n, (i, t) in enumerate(texts)]
    spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(f"{folder}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    return sorted(map(tuple, catalogue.QUERIES[name](spark, str(folder)).collect())), sorted(con.execute(catalogue.ORACLE_SQL[name]).fetchall())


def test_dedupe_documents_of_wide_ids(spark, tmp_path):
    got, told = over_documents(spark, tmp_path, "dedupe_documents", WIDE_IDS)
    assert got == told == [(1_500_000, "src0", 3), (5_000_000_000, "src1", 1)]


def test_dedupe_provenance_of_wide_ids(spark, tmp_path):
    got, told = over_documents(spark, tmp_path, "dedupe_provenance", WIDE_IDS)
    assert got == told == [(1_500_000, 3, "src0/1500000|src1/3000000000|src0/4000000000")]


def test_documents_without_a_key_are_no_duplicates(spark, tmp_path):
    """As the SQL of dedupe_key tells them apart; the SQL of dedupe_stats itself takes them for one."""
    texts = [(1, "Привет"), (2, "你好"), (3, ""), (4, ""), (5, "A title"), (6, "a title.")]
    got, told = over_documents(spark, tmp_path, "dedupe_key", texts)
    assert got == told and len({key for _, key in told}) == 5
    stats = catalogue.QUERIES["dedupe_stats"](spark, str(tmp_path)).first()
    assert (stats.rows_in, stats.groups, stats.duplicates) == (6, 5, 1)
    assert sorted(map(tuple, catalogue.QUERIES["dedupe_documents"](spark, str(tmp_path)).collect())) == [(1, "src0", 1), (2, "src1", 1), (3, "src0", 1), (4, "src1", 1), (5, "src0", 2)]
    assert [tuple(r) for r in catalogue.QUERIES["dedupe_provenance"](spark, str(tmp_path)).collect()] == [(5, 2, "src0/5|src1/6")]
