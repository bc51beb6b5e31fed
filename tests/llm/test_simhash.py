"""SimHash groups against all pairs of fingerprints."""

import random
import re

import pytest
import xxhash

from lastmile.llm import simhash
from lastmile.llm.graph import components
from lastmile.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def slow_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(rows, distance=4):
    """rows: (doc_id, fingerprint) to the smallest reachable doc_id of each."""
    points = sorted({f for _, f in rows})
    root = {f: f for f in points}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(points):
        for b in points[i + 1 :]:
            if (a ^ b).bit_count() <= distance:
                root[top(a)] = top(b)
    first = {}
    for d, f in rows:
        first[top(f)] = min(first.get(top(f), d), d)
    return sorted((d, first[top(f)]) for d, f in rows)


def unsigned(x):
    return x & (2**64 - 1)


@pytest.mark.parametrize("text", [None, "", " \t\n", "One", "a b c", "A b C d", "x " * 5000, "é ü Z q a b c"])
def test_fingerprint(text):
    assert unsigned(simhash.fingerprint(text)) == slow_fingerprint(text)


def test_query_against_all_pairs(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = [(r.doc_id, slow_fingerprint(r.text)) for r in docs]
    got = QUERIES["op1_simhash"](spark, SMALL).collect()
    assert sorted((r.doc_id, int(r.fingerprint, 16)) for r in got) == sorted(want)
    assert sorted((r.doc_id, r.component_id) for r in got) == slow_components(want)


@pytest.mark.parametrize("block", [4096, 6])
def test_links_of_crowded_keys(spark, block):
    """Many near fingerprints around a few centres, also with keys cut into small blocks."""
    rnd = random.Random(7)
    points = set()
    for centre in (0, 2**64 - 1, 0x0123456789ABCDEF):
        for _ in range(120):
            x = centre
            for _ in range(rnd.randint(0, 7)):
                x ^= 1 << rnd.randrange(64)
            points.add(x)
    signed = [p - 2**64 if p >= 2**63 else p for p in points]
    frame = spark.createDataFrame([(p,) for p in signed], "fp long")
    roots = {r.node: r.root for r in components(simhash.near_links(frame, 4, block)).collect()}
    rows = [(i, p) for i, p in enumerate(sorted(points))]
    want = slow_components(rows)
    got_root = {i: roots.get(p - 2**64 if p >= 2**63 else p, p - 2**64 if p >= 2**63 else p) for i, p in rows}
    first = {}
    for i, r in got_root.items():
        first[r] = min(first.get(r, i), i)
    assert sorted((i, first[r]) for i, r in got_root.items()) == want


def test_edge_rows(spark):
    rows = [
        (1, None, "a", 1), (2, "", "b", 2), (None, "lone words in a row here", None, 3),
        (7, "same text twice in two rows", "s", 4), (7, "same text twice in two rows", "s", 4),
        (9, "same text twice in two rows", "s", 5),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string, _fp long")
    got = simhash.near_groups(docs).collect()
    assert sorted((str(r.doc_id), str(r.component_id)) for r in got) == [
        ("1", "1"), ("2", "1"), ("7", "7"), ("7", "7"), ("9", "7"), ("None", "None"),
    ]
    kept = simhash.keep_one(docs.drop("_fp"))
    assert kept.columns == ["doc_id", "text", "fingerprint"]
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "7", "None"]
    assert simhash.near_groups(docs.limit(0)).count() == 0


def test_one_row_of_each_group_whatever_the_ids(spark):
    """Unlike texts without an id or with a shared one are groups of their own."""
    rows = [
        (None, "lone words in a row here"), (None, "quite another set of terms there"), (None, "third unlike thing altogether, see"),
        (5, "apples and pears ripen in late summer"), (7, "apples and pears ripen in late summer"),
        (5, "engines burn fuel under high pressure"), (9, "engines burn fuel under high pressure"),
        (None, "the null id comes last of all"), (3, "the null id comes last of all"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted((str(r.doc_id), r.text) for r in simhash.keep_one(docs).collect())
    assert kept == sorted((str(d), t) for d, t in [*rows[:3], rows[3], rows[5], rows[8]])
