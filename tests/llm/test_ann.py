"""Nearest neighbours: recall against brute force, exact scores, copies and odd vectors."""

import numpy as np
import pytest

from lastmile.llm import ann
from lastmile.llm.queries import QUERIES

MEDIUM = "/root/testdata/sf0.1"
SCHEMA = "vec_id long, embedding array<float>, id string"


def brute(rows, queries, k=5):
    """rows: (id, vector); per query the k best (score, id), ties to the smaller id."""
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], float)
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for q, v in queries:
        score = np.round(x @ (np.array(v, float) / np.linalg.norm(np.array(v, float))), 12)
        keep = ids != q
        out[q] = sorted(zip(-score[keep], ids[keep]))[:k]
    return out


def test_query_recall_and_scores(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{MEDIUM}/embeddings.parquet").collect()]
    want = brute(rows, [r for r in rows if r[0] % 50 == 0])
    got = {}
    for r in QUERIES["op2_nearest"](spark, MEDIUM).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    assert set(got) == set(want) and all(sorted(v) == [1, 2, 3, 4, 5] for v in got.values())
    by_id = dict(rows)
    hits = 0
    for q, found in got.items():
        hits += len({v for v, _ in found.values()} & {i for _, i in want[q]})
        for v, score in found.values():
            a, b = np.array(by_id[q], float), np.array(by_id[v], float)
            assert score == pytest.approx(a @ b / np.linalg.norm(a) / np.linalg.norm(b), abs=1e-12)
        assert [s for _, s in (found[i] for i in range(1, 6))] == sorted((s for _, s in found.values()), reverse=True)
    assert hits >= 0.98 * 5 * len(want)


def test_shards_and_blocks_are_merged(spark):
    rnd = np.random.default_rng(1)
    rows = [(i, rnd.normal(size=8).astype("f4").tolist(), "x") for i in range(900)]
    frame = spark.createDataFrame(rows, SCHEMA)
    got = ann.nearest(frame, frame.where("vec_id % 9 = 0"), shard_rows=200, query_block=30).collect()
    want = brute([r[:2] for r in rows], [r[:2] for r in rows if r[0] % 9 == 0])
    found = {q: {r.vec_id for r in got if r.query_id == q} for q in want}
    assert np.mean([len(found[q] & {i for _, i in want[q]}) / 5 for q in want]) >= 0.98


def test_copies_and_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 2.0, 3.0], "copy") for i in range(500)]
    rows += [(1000, [3.0, -1.0, 0.5], "a"), (1001, [-1.0, -2.0, -3.1], "b"), (1000, [3.0, -1.0, 0.5], "a")]
    rows += [(2000, None, "n"), (2050, [0.0, 0.0, 0.0], "z"), (2100, [1.0, None, 2.0], "m"), (2150, [nan, 1.0, 1.0], "q"),
             (2200, [inf, 1.0, 1.0], "i"), (2250, [], "e"), (2300, [1e30, 1e30, 1e30], "h"), (None, [1.0, 1.0, 1.0], "n"), (2350, [5.0], "s")]
    frame = spark.createDataFrame(rows, SCHEMA)
    got = {}
    for r in ann.nearest(frame, frame.where("vec_id % 50 = 0")).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    assert [i for _, i in sorted(got[100])] == [0, 1, 2, 3, 4]
    assert [i for _, i in sorted(got[0])] == [1, 2, 3, 4, 5]
    assert len(got[1000]) == 5 and 1000 not in [i for _, i in got[1000]]
    assert not set(got) & {2000, 2050, 2100, 2150, 2200, 2250, 2350}
    few = frame.where("vec_id IN (1000, 1001)")
    assert [(r["rank"], r.vec_id) for r in ann.nearest(few, few.where("vec_id = 1000")).collect()] == [(1, 1001)]
    assert ann.nearest(frame.limit(0), frame.limit(0)).count() == 0
    assert ann.nearest(frame, frame.limit(0)).count() == 0
