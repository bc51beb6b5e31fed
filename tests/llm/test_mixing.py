"""Mixing: targets against a plain loop, taken words against the slots, and whole texts."""

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from lastmile.llm import mixing
from lastmile.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow_targets(sizes):
    """sizes: source to words; share out, stop at the limit, share the excess again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, left, still = dict.fromkeys(names, 0.0), 1.5 * sum(sizes.values()), set(names)
    while left > 1e-9 and still:
        unit = left / sum(weight[s] for s in still)
        full = {s for s in still if target[s] + unit * weight[s] >= 2 * sizes[s]}
        for s in still:
            target[s] = min(2.0 * sizes[s], target[s] + unit * weight[s])
        left, still = 1.5 * sum(sizes.values()) - sum(target.values()), still - full
    return target


def check(rows, texts):
    sizes, taken, target = Counter(), Counter(), {}
    for r in rows:
        source = texts[r.doc_id][0]
        sizes[source] += r.size
        taken[source] += r.taken
        target[source] = r.target
        assert r.size == len(WORD.findall(texts[r.doc_id][1] or "")) and 0 <= r.taken <= 2 * r.size
    want = slow_targets(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(want[s], rel=1e-9, abs=1e-6)
        assert abs(taken[s] - want[s]) <= 0.02 * want[s] + 3 * mixing.BLOCK_WORDS
    assert all(r.source_size == sizes[texts[r.doc_id][0]] for r in rows)


def test_query(spark):
    docs = {r.doc_id: (r.source, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    first = QUERIES["op6_mixing"](spark, SMALL).collect()
    assert len(first) == len(docs)
    check(first, docs)
    again = QUERIES["op6_mixing"](spark, SMALL).repartition(3).collect()
    assert sorted(first) == sorted(again)


@pytest.mark.parametrize("size", [1, 2, 7, 64, 1000])
def test_permutation(spark, size):
    rows = spark.range(size).withColumn("n", F.lit(size).cast("long"))
    got = [r.id for r in mixing.permuted(rows, "id", "n", F.lit(3)).collect()]
    assert sorted(got) == list(range(size))
    assert size < 64 or got != list(range(size))


def test_one_source_with_most_words_and_odd_rows(spark):
    rows = [(i, "w " * 90, "big") for i in range(300)] + [(1000 + i, "v " * 10, f"s{i}") for i in range(7)]
    rows += [(2000, None, "big"), (2001, "", None), (2002, "one two", None), (2002, "one two", None), (None, "a b c", "s1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("clash"))
    got = mixing.mixed(docs).collect()
    assert len(got) == len(rows)
    texts = defaultdict(tuple, {d: (s, t) for d, t, s in rows})
    check([r for r in got], texts)
    assert mixing.mixed(docs.limit(0)).count() == 0


def test_documents_of_the_mix(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    taken = {r.doc_id: r for r in mixing.mixed(docs).collect()}
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    before = {r.doc_id: r.text for r in docs.collect()}
    words, whole = Counter(), 0
    for r in out.collect():
        words[r.doc_id] += len(WORD.findall(r.text))
        whole += r.text == before[r.doc_id]
        assert r.n_chars == len(r.text) and Counter(WORD.findall(r.text)) <= Counter(WORD.findall(before[r.doc_id]))
    assert {d: n for d, n in words.items() if n} == {d: r.taken for d, r in taken.items() if r.taken}
    assert whole > 0
