"""The filter audit against the SQL form, plain counting, and edge rows."""

import itertools
import re

import pytest
from compare_engines import connect, differences
from pyspark.sql import functions as F

from lastmile.llm import filter_audit
from lastmile.llm.queries import QUERIES
from lastmile.llm.sql import ORACLES

SMALL = "/root/testdata/sf0.001"
OUT = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]


def slow_masks(docs, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    for doc, text, lang in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        twin = doc is not None and any(o is not None and o < doc and (t or "") == text for o, t, _ in docs)
        fails = {
            f for f, failed in zip("ABCDE", (
                len(words) < 200, 100 * len(set(words)) < 50 * len(words),
                100 * len(re.findall("[A-Z]", text)) > 3 * len(text), bool(re.search("[#$%&*|]", text)), twin,
            )) if failed
        }
        yield lang or "", fails, doc in good, doc in toxic


def slow(masks):
    out = {}
    for part in {m[0] for m in masks}:
        own = [m[1:] for m in masks if m[0] == part]
        removed = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = own
            for i, f in enumerate(order):
                gone = [m for m in left if f in m[0]]
                late = [m for m in own if f in m[0]]
                left = [m for m in left if f not in m[0]]
                out[part, "".join(order), i + 1] = [
                    len(left), len(gone), len(late) - len(gone), sum(m[0] == {f} for m in own),
                    sum(m[1] for m in gone), sum(m[2] for m in gone),
                ]
                removed[f] += len(gone)
        for order in itertools.permutations("ABCDE"):
            for i, f in enumerate(order):
                out[part, "".join(order), i + 1].append(removed[f])
    return out


def found(df):
    rows = df.collect()
    out = {(r.part, r.filter_order, r.step): [*(r[c] for c in OUT), r.shapley] for r in rows}
    assert len(out) == len(rows)
    return out


def test_query_against_sql(spark):
    name = "op12_filter_audit"
    assert differences(QUERIES[name](spark, SMALL), connect(SMALL), ORACLES[name]) == []


@pytest.mark.parametrize("fan_in", [2, 64])
def test_edge_rows(spark, monkeypatch, fan_in):
    monkeypatch.setattr(filter_audit, "FAN_IN", fan_in)
    plain = " ".join(f"w{i}" for i in range(200))
    docs = [
        (1, plain, "en"), (2, plain, "en"), (2, plain, "en"), (None, plain, "en"), (3, None, None), (4, "", ""), (5, "", "de"),
        (6, " \x0b".join(f"w{i % 100}" for i in range(200)), "de"), (7, " ".join(f"w{i % 99}" for i in range(200)), "de"),
        (8, plain + " A" * 30, "fr"), (9, plain.replace("w1", "#"), "fr"), (10, "ÄÖ" * 300 + " x", "fr"), (11, "a|" * 100_000, "xx"),
    ]
    labels = [(1, 1, 0), (2, 0, 0), (2, 1, None), (5, 1, 1), (7, None, 1), (None, 1, 1), (99, 1, 1), (9, 0, 1)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string").withColumns(
        {"quality": F.lit(1), "_f": F.lit(2), "_id": F.lit(3), "mask": F.lit(4)}
    )
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    masks = filter_audit.failed_filters(frame.repartition(7), marks)
    assert found(filter_audit.audited(masks)) == slow(list(slow_masks(docs, labels)))
    assert filter_audit.audited(filter_audit.failed_filters(frame.limit(0), marks)).count() == 0
    assert found(filter_audit.audited(filter_audit.failed_filters(frame, marks.limit(0)))) == slow(
        list(slow_masks(docs, []))
    )


def test_many_parts_and_tasks(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "FAN_IN", 3)
    masks = spark.range(3000).selectExpr("concat('p', id % 40) AS part", "cast(id % 32 AS int) AS mask", "id % 2 = 0 AS good", "id % 3 = 0 AS toxic")
    rows = [(r.part, {f for i, f in enumerate("ABCDE") if r.mask >> i & 1}, r.good, r.toxic) for r in masks.collect()]
    assert found(filter_audit.audited(masks.repartition(30))) == slow(rows)


def test_fields_do_not_overflow():
    one = filter_audit.packed_counter(31, True, True)
    many = 2**40 + 7
    for order, place, counts in filter_audit.unpacked(one * many):
        assert counts == tuple(many * int(x) for x in filter_audit.outcome(order, place, 31, True, True))
