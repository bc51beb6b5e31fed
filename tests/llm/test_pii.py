"""Personal data: base spans against plain matching, added spans, redaction and odd rows."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from lastmile.llm import pii
from lastmile.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"
LARGE = "/root/testdata/sf0.1"  # enough written-around forms to calibrate thresholds on
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def holds(kind, match):
    digits = [int(c) for c in match if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        total = sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits)))
        return 12 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def slow(text):
    spans = []
    for number, (kind, pattern) in enumerate(PLAIN.items()):
        spans += [(m.start(), number, kind, m.end()) for m in re.finditer(pattern, text or "") if holds(kind, m.group())]
    return [(kind, a, b) for a, _, kind, b in sorted(spans)]


def line(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def check(row, text):
    want = slow(text)
    assert [row[f"n_{k}"] for k in PLAIN] == [sum(s[0] == k for s in want) for k in PLAIN]
    assert row.base_sha256 == hashlib.sha256(line(want).encode()).hexdigest()
    every = row.spans.split(",") if row.spans else []
    assert set(line([s]) for s in want) <= set(every)
    order = [(int(s.split(":")[1]), list(PLAIN).index(s.split(":")[0])) for s in every]
    assert order == sorted(order)


@pytest.mark.parametrize("folder", [SMALL, MEDIUM])
def test_query_against_plain_matching(spark, folder):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op10_pii"](spark, folder).collect()
    assert len(rows) == len(texts)
    for row in rows:
        check(row, texts[row.doc_id])


ODD = [
    None, "", "a@b.c", "a@b.c_d@e.f", "x@y", "é😀 a.b+c@d-e.f.g! 😀 1.2.3.4", "1.2.3.4.5.6.7.8 256.1.1.1 001.02.255.0",
    "4111 1111 1111 1111 and 4111-1111-1111-1112", "4111  1111 1111 1111", "+1 (017) 555-7713.", "+12 3", "++49 30 1234567",
    "+1 4111 1111 1111 1111", "1" * 10_000, "a" * 10_000, "1 2 " * 20_000, "a@b.c" * 3, "0000000000000000", "@@@ . + +",
    "1.2.3.4@x.y 12.34.56.78+1 212 555 1234", "9" * 19 + " " + "9.9" * 10,
]


def test_base_spans_of_odd_texts(spark):
    docs = spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string").selectExpr("*", "'x' AS spans", "1 AS base")
    rows = pii.detected(docs.unionAll(docs)).collect()
    assert len(rows) == 2 * len(ODD)
    for row in rows:
        check(row, ODD[row.doc_id])
    assert pii.detected(docs.limit(0)).count() == 0


def test_added_spans_and_redaction(spark):
    docs = spark.read.parquet(f"{LARGE}/documents.parquet")
    more = spark.createDataFrame(
        [
            (-1, "reach me: jane.doe [at] mail7 [dot] com thanks", "en", "s", 1),
            (-2, "the host 161[.]17[.]88[.]162 was seen", "en", "s", 1),
            (-3, "call (017) 555-7713 today", "en", "s", 1),
            (-4, "plain words, version 2.0 of 1999 and 12 more", "en", "s", 1),
            (-5, None, None, None, 0),
        ],
        docs.schema,
    )
    out = pii.redacted(docs.unionAll(more))
    assert out.columns == docs.columns
    got = {r.doc_id: r for r in out.collect()}
    assert got[-1].text == "reach me: [EMAIL] thanks"
    assert got[-2].text == "the host [IP] was seen"
    assert got[-3].text == "call [PHONE] today"
    assert got[-4].text == "plain words, version 2.0 of 1999 and 12 more" and got[-5].text is None
    for r in docs.collect():
        assert not slow(got[r.doc_id].text) and (slow(r.text) or got[r.doc_id].text == r.text or "[" in got[r.doc_id].text)
        assert got[r.doc_id].n_chars == len(got[r.doc_id].text)
    changed = [r for r in docs.collect() if not slow(r.text) and got[r.doc_id].text != r.text]
    assert len(changed) <= 0.01 * len(got)


def test_no_rows_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "mail a@b.cd now")], "doc_id long, text string")
    assert pii.detected(docs).first().spans == "email:5:11"
    assert pii.redacted(docs).first().text == "mail [EMAIL] now"
    assert docs.select(F.lit(1)).count() == 1


def test_candidates_and_base_rules_are_cut_at_base_spans(spark):
    texts = ["x +1 (826) 555-4081 190.137.223.204 y", "+1 212 555 1234 1.2.3.4 5.6.7.8", "a@b.cd", "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in pii.with_spans(docs, pii.NO_MODEL).collect()}
    assert [tuple(s) for s in rows[0].base] == [(20, 35, 1)]
    assert [tuple(s) for s in rows[0].spans] == [(2, 19, 3), (20, 35, 1)]
    out = {r.doc_id: r.text for r in pii.redacted(docs).collect()}
    assert out == {0: "x [PHONE] [IP] y", 1: "[PHONE] [IP] [IP]", 2: "[EMAIL]", 3: "", 4: None}


def test_many_spans_in_one_text(spark):
    """Several blocks of spans; replaced in order, overlapping ones once."""
    text = "".join(f"u{i}@b.cd 1.2.3.{i % 256} é" for i in range(1000))
    (row,) = pii.redacted(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert row.text == "[EMAIL] [IP] é" * 1000
    spans = F.from_json(F.lit('[{"start":1,"end":4,"kind":0},{"start":2,"end":6,"kind":1},{"start":6,"end":7,"kind":2}]'), "array<struct<start:long,end:long,kind:int>>")
    (row,) = spark.range(1).select(
        pii.disjoint(spans).alias("d"), pii.masked(F.lit("0123456789"), spans).alias("m"),
        pii.replaced(F.lit("0123456789"), spans, lambda s: s["kind"].cast("string")).alias("r"),
    ).collect()
    assert [tuple(s) for s in row.d] == [(1, 6, 0), (6, 7, 2)]
    assert row.r == "002789" and row.m.startswith("0" + pii.FILLER) and row.m.endswith("789")


def test_trees_and_thresholds_come_from_all_texts(spark):
    """Addresses in 20 of 30,000 texts, enough to calibrate on only if all their forms are counted."""
    mail = F.concat(F.lit("write to u"), F.col("id"), F.lit("@host"), F.col("id"), F.lit(".org until 12-05-2024"))
    host = F.concat(F.lit("the host 10.2.3."), F.col("id") % 250, F.lit(" was seen in "), F.col("id"))
    docs = spark.range(30_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 1500 == 7, host).otherwise(mail).alias("text"))
    assert pii.fit(docs.unionAll(docs.limit(500))).thresholds[1] <= 1
    counted = pii.training_rows(docs.unionAll(docs.limit(500))).groupBy("generator", "y").agg(F.sum("n").alias("n"))
    assert {(r.generator, r.y): r.n for r in counted.collect()} == {(0, 1): 4 * 29_980, (1, 1): 4 * 20, (3, 0): 5 * 29_980}
