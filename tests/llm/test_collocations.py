"""Phrase mining against plain counting, over range borders and buffer borders."""

import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from compare_engines import connect, differences

from lastmile.llm import collocations
from lastmile.llm.queries import QUERIES
from lastmile.llm.sql import ORACLES

SMALL = "/root/testdata/sf0.001"


def slow(rows, least, top=2000, longest=4):
    counts, total = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    counts[lang, *words[i : i + k]] += 1
    chosen = {p: a for p, a in counts.items() if len(p) > 2 and a >= least}
    hidden = set()
    for (lang, *words), f in chosen.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                inner = (lang, *words[i : i + k])
                if 100 * f >= 80 * counts[inner]:
                    hidden.add(inner)
    out = {}
    for (lang, *words), a in chosen.items():
        if (lang, *words) not in hidden:
            cuts = [
                (2_000_000 * a // (counts[lang, *words[:k]] + counts[lang, *words[k:]]), k) for k in range(1, len(words))
            ]
            score, k = min(cuts)
            out.setdefault(lang, []).append(
                (" ".join(words), a, counts[lang, *words[:k]], counts[lang, *words[k:]], total[lang], score)
            )
    for lang in out:
        out[lang] = sorted(out[lang], key=lambda x: (-x[5], -x[1], x[0].encode()))[:top]
    return {(lang, i + 1): row for lang, rows in out.items() for i, row in enumerate(rows)}


def found(df):
    rows = df.collect()
    out = {(r.lang, r.rank): (r.phrase, r.a, r.l, r.r, r.n, r.score) for r in rows}
    assert len(out) == len(rows)
    return out


def test_query_against_plain_counting(spark):
    rows = [(r.text, r.lang) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    want = slow(rows, 30)
    assert len(want) == 50
    assert found(QUERIES["op13_collocations"](spark, SMALL)) == want


def test_query_against_sql(spark):
    name = "op13_collocations"
    assert differences(QUERIES[name](spark, SMALL), connect(SMALL), ORACLES[name]) == []


ODD = [
    ("New York. New York City, new york!", "en"), ("a\x01 b a\x01 b a b a b", "en"), ("x x x x x x x", "en"), ("", "en"),
    (None, "fr"), ("été à la plage\tété à la plage\x0bété à la", None), ("ÉTÉ À", None), ("x\ry z\x0cy z", "und"), (" \t ", "de"),
    ("one", "it"), ("b c a b c d. z b c y", ""), ("a b c d a b c d e\nb c", ""), ("日本 語 日本 語", "ja"), ("the " * 60, "xx"),
]


@pytest.mark.parametrize("least", [1, 2, 3])
def test_odd_rows(spark, least):
    docs = spark.createDataFrame(ODD * 2, "text string, lang string").selectExpr("*", "1 AS phrase", "2 AS n", "'h' AS h", "3 AS path")
    got = collocations.collocations(docs.repartition(4), min_count=least)
    assert found(collocations.ranked(got)) == slow(ODD * 2, least)
    assert found(collocations.ranked(got, top=2, spread=3)) == slow(ODD * 2, least, top=2)
    assert collocations.ranked(collocations.collocations(docs.limit(0))).count() == 0


def test_range_borders_and_small_buffers(spark, monkeypatch):
    """Ranges of a few rows, so that phrases extend over borders, and buffers of a few words."""
    monkeypatch.setattr(collocations, "CHUNK_BYTES", 40)
    rows = [(t, lang) for t, lang in ODD] + [(" ".join("the a b the a c d"[i % 16 :].split() * 9), "en") for i in range(30)]
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    try:
        assert found(collocations.ranked(collocations.collocations(docs, min_count=2))) == slow(rows, 2)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.mark.parametrize("order", [1, 2, 3, 4, 5])
def test_chunks_hold_each_phrase_once(order):
    text = b"aa b ccc\n" + b"d ee f " * 9 + b"\n" + b"w" * 70 + b" x " + b"v" * 90 + b" y z  a b\nq" + b" r" * 30
    def all_of(part, size, skip=0):
        out, at = Counter(), 0
        for piece in part.split(b"\n"):
            words = piece.split()
            out.update(tuple(words[i : i + size]) for i in range(len(words) - size + 1) if at + i + size > skip)
            at += len(words)
        return out

    for most in (8, 20, 64, 10_000):
        for size in (order - 1, order):
            if size:
                got = sum((all_of(part, size, skip) for part, skip in collocations.chunks(text, order, most)), Counter())
                assert got == all_of(text, size), (most, size)


def test_arithmetic_beyond_64_bits(spark):
    big = 2**62
    rows = [("x", [], big, [], 0), ("x", ["a"], big, [big], 0), ("x", ["b"], big, [big], 0), ("x", ["a", "b"], big - 1, [big, big], 0)]
    frame = spark.createDataFrame(rows, "lang string, path array<string>, n long, _ends array<long>, _before long")
    (row,) = collocations.scored(collocations.in_lockstep(frame, "_starts", "_after")).collect()
    assert (row.a, row.l, row.r, row.n, row.score) == (big - 1, big, big, big, 2_000_000 * (big - 1) // (2 * big))


def test_no_call_per_word(monkeypatch):
    """Words are hashed a buffer at a time; only langs one by one."""
    calls = []

    class Counted:
        @staticmethod
        def xxh64_intdigest(value, seed=0):
            calls.append(value)
            return xxhash.xxh64_intdigest(value, seed=seed)

    monkeypatch.setattr(collocations, "xxhash", Counted)
    texts = [b" ".join(b"w%d" % i for i in range(5000)), b"a b"]
    starts = np.array([0, len(texts[0]) + 1])
    (totals, hashes) = collocations.count_buffer(b"\n".join(texts), starts, ["en", "de"], 1, 4, None)
    assert totals.num_rows == 2 and hashes.num_rows == 5002 and len(calls) == 2


def test_word_hashes_do_not_depend_on_the_place():
    words = [b"a", b"\x00", b"\x00\x00", b"a\x00", b"\x00a", b"ab", b"ba", "été".encode(), b"x" * 3000, b"y"]
    for data in (b" ".join(words), b"\n q " + b"  ".join(reversed(words)) + b"\n", b"y"):
        found = collocations.Words(data, np.array([0]))
        seen = dict(zip(data.split(), found.hash.tolist(), strict=True))
        assert len(set(seen.values())) == len(seen)
        assert {w: collocations.Words(w, np.array([0])).hash[0] for w in seen} == seen
    assert len(collocations.Words(b" \n", np.array([0]))) == len(collocations.Words(b"", np.array([0]))) == 0
