"""Boosting by tasks that hold their rows against boosting in one task."""

import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from lastmile.operators import big_trees, ensembles, held_boosting, meeting, trees

KINDS = {
    "levels": {"maxDepth": 3, "maxIter": 6, "stepSize": 0.4},
    "leaves": {"maxLeaves": 6, "minInstancesPerNode": 15, "maxIter": 5, "stepSize": 0.4, "l2": 0.5},
    "huber": {"loss": "huber", "maxDepth": 3, "maxIter": 5, "stepSize": 0.4},
    "share": {"maxDepth": 2, "maxIter": 4, "subsamplingRate": 0.6, "stepSize": 0.4, "featureSubsetStrategy": "0.7"},
}


def settings(options):
    return ensembles.DEFAULTS | {"kind": "boosting"} | options


def side_by_side(count, work):
    """Runs ``work(i, together)`` in threads that exchange arrays; their results."""
    barrier, said, out = threading.Barrier(count, timeout=60), [None] * count, [None] * count

    def run(i):
        def together(mine):
            said[i] = mine.copy()
            barrier.wait()
            got = [s.copy() for s in said]
            barrier.wait()
            return got

        try:
            out[i] = work(i, together)
        except BaseException:
            barrier.abort()
            raise

    threads = [threading.Thread(target=run, args=(i,)) for i in range(count)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    return out


@pytest.mark.parametrize("kind", list(KINDS))
def test_equal_to_boosting_in_one_task(kind):
    rng = np.random.default_rng(3)
    n, levels = 900, [np.arange(300.0)] * 5
    x = np.stack([rng.integers(0, 200, n), rng.integers(0, 90, n), rng.integers(0, 2, n), rng.integers(0, 6, n), np.zeros(n)], 1).astype(np.uint8)
    y = np.round(x[:, 0] * 0.1 + 4 * x[:, 2] * (x[:, 3] > 2) + rng.normal(0, 1, n), 3)
    y[::40] += 50
    ids, s = np.arange(n), settings(KINDS[kind])
    want = list(trees.boost(x, y, ids, ensembles.rule_of(s, 5), ensembles.boost_of(s), s["seed"], levels))
    part = np.minimum(rng.integers(0, 5, n), 3)  # of five tasks the last one has no rows

    def work(i, together):
        mine = part == i
        return list(held_boosting.boost(held_boosting.Held(x[mine], together), y[mine], ids[mine], s, levels))

    for got in side_by_side(5, work):
        assert got[0] == pytest.approx(want[0]) and len(got) == len(want)
        for a, b in zip(got[1:], want[1:]):
            assert (a["slot"] == b["slot"]).all() and (a["cut"] == b["cut"]).all() and (a["rows"] == b["rows"]).all()
            leaf = a["slot"] < 0
            assert a["value"][leaf] == pytest.approx(b["value"][leaf], abs=1e-9)


def test_quantiles_are_exact(monkeypatch):
    monkeypatch.setattr(held_boosting, "FEW", 20)
    monkeypatch.setattr(held_boosting, "RANGES", 8)
    rng = np.random.default_rng(5)
    values = np.concatenate([rng.normal(0, 1e6, 500), np.full(300, 7.0), rng.integers(0, 3, 400), [1e300, -1e300]])
    group, part = np.concatenate([np.zeros(500), np.ones(300), np.full(402, 3)]).astype(int), rng.integers(0, 3, 1202)
    for p in (0.5, 0.9):
        want = [np.quantile(values[group == g], p, method="inverted_cdf") if g != 2 else np.nan for g in range(4)]
        for got in side_by_side(3, lambda i, together: held_boosting.quantile(values[part == i], group[part == i], 4, p, together)):
            assert got == pytest.approx(want, nan_ok=True, rel=0, abs=0)


def test_one_stage_for_all_rounds(spark, monkeypatch):
    rows = spark.range(1200).select(
        F.col("id"), (F.pmod(F.xxhash64("id"), F.lit(50)) * 1.0).alias("label"), F.lit(0).alias("part"), F.lit(False).alias("held"),
    ).selectExpr("id", "label AS y", "unhex(concat(lpad(hex(int(label)), 2, '0'), lpad(hex(int(id % 7)), 2, '0'))) AS x", "part", "held")
    cuts = [[float(i) for i in range(50)], [float(i) for i in range(7)]]
    asked = {k: settings(v) for k, v in KINDS.items()}
    monkeypatch.setattr(big_trees, "find_splits", None)  # no job for a level
    found = big_trees.fit(rows, asked, cuts)
    for name, s in asked.items():
        start, made = found[name]
        assert len(made) == s["maxIter"]
        first = ensembles.unpacked(made[0])
        assert (first["slot"] >= 0).any() and first["rows"][0] == (1200 if s["subsamplingRate"] == 1 else first["rows"][1:3].sum())
        assert start == pytest.approx(rows.select(F.avg("y")).first()[0] if s["loss"] != "huber" else np.quantile([r.y for r in rows.collect()], 0.5, method="inverted_cdf"))


def test_exchange_by_files_gives_all_arrays_and_leaves_few(tmp_path):
    def work(i, _):
        together = meeting.by_files(str(tmp_path), i, 3)
        return [np.concatenate(together(np.array([i + 10.0 * k]))).tolist() for k in range(40)]

    assert side_by_side(3, work) == [[[10.0 * k, 1 + 10.0 * k, 2 + 10.0 * k] for k in range(40)]] * 3
    assert len(list(tmp_path.iterdir())) == 3


def test_no_files_in_a_folder_that_is_not_plain(monkeypatch):
    monkeypatch.setattr(meeting, "shared_folder", lambda spark: "hdfs://there/kept")
    assert meeting.meeting_folder(None) is None


def test_no_barrier_stage_where_executors_come_and_go(spark):
    class Session:
        class sparkContext:  # noqa: N801
            getConf = staticmethod(lambda: {"spark.dynamicAllocation.enabled": "true"})

    assert meeting.tasks_at_once(Session) == 0 and meeting.tasks_at_once(spark) == 8
