"""Line deduplication against the SQL form, a plain version, and edge rows."""

import hashlib
import random
import re
from collections import defaultdict

from compare_engines import connect, differences

from lastmile.llm import line_dedup
from lastmile.llm.queries import QUERIES
from lastmile.llm.sql import ORACLES

SMALL = "/root/testdata/sf0.001"
NONE = -1  # stands for a missing id, which comes before all others


def slow(rows, min_chars=40, min_documents=5):
    key = lambda line: re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))
    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(NONE if doc is None else doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        shared = lambda line: len(holders.get(key(line), ())) >= min_documents
        kept = [x for x in lines if not (shared(x) and max(holders[key(x)]) != (NONE if doc is None else doc))]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def found(df):
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in df.collect()), key=repr)


def test_query_against_sql(spark):
    name = "op11_line_dedup"
    assert differences(QUERIES[name](spark, SMALL), connect(SMALL), ORACLES[name]) == []
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    want = {d: hashlib.sha256(t.encode()).hexdigest() for d, _, _, t in slow(texts)}
    assert {r.doc_id: r.kept_sha256 for r in QUERIES[name](spark, SMALL).collect()} == want


def test_edge_rows(spark):
    long = "Ünïcode LINE that is long enough to be counted, été"
    shared = "  \t" + long + "\x0b\r"
    rows = [(i, f"{shared}\nown line {i}\n{long}") for i in range(6)]
    rows += [(5, long), (3, long.replace("LINE", "line")), (None, long), (None, None), (None, ""), (8, "\n\n"), (9, None)]
    rows += [(20, long[:39]), (21, "é" * 39), *[(30 + i, "é" * 40) for i in range(5)], (40, "x\n" * 3000 + long)]
    rows += rows[:2]  # repeated rows
    rows += [(50, "É" * 45)] * 7  # copies of one row are one document
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found(line_dedup.deduplicated(docs)) == slow(rows)
    # Only ASCII letters are put in lower case.
    assert all(r.n_dropped == 0 for r in line_dedup.deduplicated(docs.where("doc_id = 50")).collect())


def test_random_texts(spark):
    rnd = random.Random(5)
    pool = ["".join(rnd.choice("abC ") for _ in range(rnd.choice((3, 39, 40, 41)))) for _ in range(12)]
    rows = [(rnd.randint(0, 20), "\n".join(rnd.choice(pool) for _ in range(rnd.randint(0, 6)))) for _ in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert found(line_dedup.deduplicated(docs, min_documents=4)) == slow(rows, min_documents=4)


def test_columns_and_empty_table(spark):
    docs = spark.range(6).selectExpr(
        "id AS doc_id", "repeat('same long line ', 4) AS text", "1 AS n_lines", "'a' AS _dropped", "2 AS _r1", "3 AS _at", "4 AS key"
    )
    out = line_dedup.deduplicated(docs)
    assert out.columns == ["doc_id", "text", "_dropped", "_r1", "_at", "key", "n_lines", "n_dropped"]
    assert sorted((r.doc_id, r.n_lines, r.n_dropped, r._dropped, r.key) for r in out.collect()) == [
        (i, 1, int(i < 5), "a", 4) for i in range(6)
    ]
    assert line_dedup.deduplicated(docs.limit(0)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = QUERIES["op11_line_dedup"](spark, SMALL)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
