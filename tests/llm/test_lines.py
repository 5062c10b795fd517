import hashlib
import random

from biblion.llm import lines
from biblion.llm.base import table

SCHEMA = "doc_id long, text string, start int"


def chunks(text):
    rows = text.split("\n")
    h = [int(hashlib.md5(r.encode()).hexdigest()[:8], 16) for r in rows]
    rolled = []
    for i in range(len(h) + 1):
        total = 0
        for x in [0] * (4 - min(i, 4)) + h[max(0, i - 4) : i]:
            total = (total * 1103515245 + x) % 2147483647
        rolled.append(total)

    def within(i):
        return 2 <= i < len(h) - 1 and len(set(h[i - 2 : i + 2])) == 1

    def begins(i):
        if within(i):
            return i % 2 == 0
        return rolled[i] < rolled[i - 1] and rolled[i] <= rolled[i + 1] and not within(i - 1) and not within(i + 1)

    starts = [0, *(i for i in range(2, len(rows) - 1) if begins(i))]
    return [(a, rows[a:b]) for a, b in zip(starts, [*starts[1:], len(rows)])]


def brute(rows):
    first = {}
    for i, t, *_ in rows:
        if i is not None and t is not None:
            for a, c in chunks(t):
                first[tuple(c)] = min(first.get(tuple(c), (i, a)), (i, a))
    out = []
    for i, t, *_ in rows:
        if t is None:
            out.append((i, 0, 0, None))
            continue
        kept, gone = [], 0
        for a, c in chunks(t):
            if i is not None and len(c) > 1 and "\n".join(c).strip(" \t\n\x0b\x0c\r") and first[tuple(c)] != (i, a):
                gone += len(c)
            else:
                kept += c
        out.append((i, len(t.split("\n")), gone, "\n".join(kept)))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.n_lines, r.n_removed, r.text) for r in lines.deduplicated(df).collect()), key=str)


def test_documents(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert got(docs) == want
    assert sum(r[2] for r in want) > 50


def test_random_lines(spark):
    rnd = random.Random(6)
    rows = [(i, "\n".join(rnd.choice(["a", "b", "c", "", " ", "long line"]) for _ in range(rnd.randint(1, 14))), 0) for i in range(200)]
    rows += [(i, "\n".join(f"passage {k}" for k in range(12)), 0) for i in range(300, 500)]
    assert got(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_shifted_passages_are_found(spark):
    passage = "\n".join(f"a line of the passage, number {k}" for k in range(30))
    rows = [(1, passage, 0), (2, "something else\nput in front\n" + passage + "\nand behind", 0)]
    r = [x for x in got(spark.createDataFrame(rows, SCHEMA)) if x[0] == 2][0]
    assert r[2] > 15 and r[3].startswith("something else")


def test_edges(spark):
    rows = [(1, None, 0), (2, "", 0), (None, "x\ny\nx\ny", 0), (3, "\n\n\n", 0), (4, "\n\n\n", 0), (5, "one line", 0), (6, "one line", 0), (7, "x\n" * 5000, 0), (8, "word " * 30000, 0), (9, "p\nq\nr\ns\nt\nu", 0), (9, "p\nq\nr\ns\nt\nu", 0), (9, "other\np\nq\nr\ns\nt\nu", 0), (10, "p\nq\nr\ns\nt\nu\n", 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(df) == brute(rows)
    wide = df.selectExpr("*", "1 AS gone", "2 AS lines", "3 AS gone_id", "4 AS h", "5 AS n")
    kept = lines.deduplicated(wide, with_text=True)
    assert kept.columns == wide.columns
    assert sorted((str(r.text) for r in kept.collect())) == sorted(str(x[3]) for x in brute(rows))
    assert lines.deduplicated(df.limit(0)).collect() == []


def test_copies_and_runs_go(spark):
    rnd = random.Random(3)
    rows = [(i, "\n".join(f"line {rnd.randrange(10**6)}" for _ in range(rnd.randint(2, 30))), 0) for i in range(60)]
    rows += [(1000 + i, t, 0) for i, t, _ in rows]
    rows += [(3000, "\n".join(["one", *["menu"] * 41, "two"]), 0), (3001, "\n".join(["three", "four", *["menu"] * 70, "five"]), 0)]
    found = {i: (n, gone) for i, n, gone, _ in got(spark.createDataFrame(rows, SCHEMA))}
    assert all(found[i][0] == found[i][1] for i in range(1000, 1060)) and not any(found[i][1] for i in range(60))
    assert found[3000][1] > 30 and found[3001][1] > 60


def test_oracle(spark):
    import duckdb

    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.01/documents.parquet'")
    want = sorted(con.execute(lines.ORACLE).fetchall(), key=str)
    assert got(table(spark, "/root/testdata/sf0.01", "documents")) == [(a, b, c, d) for a, b, c, d in want]


def test_no_python_in_the_plan(spark):
    plan = lines.deduplicated(table(spark, "/root/testdata/sf0.001", "documents"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
