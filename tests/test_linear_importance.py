"""Importance and feature subsets of linear models from one encoding of the rows."""

import pytest
from pyspark.sql import functions as F

from lastmile.operators import learners, prep, score, search
from lastmile.plans import flows
from lastmile.schema import TARGET


@pytest.fixture(scope="module")
def split(spark):
    draw = lambda k, m: F.pmod(F.xxhash64("id", F.lit(k)), F.lit(m))
    rows = spark.range(600).select(
        F.when(draw(1, 20) > 0, draw(2, 50).cast("double")).alias("a"), draw(3, 7).cast("double").alias("b"),
        F.lit(None).cast("double").alias("empty"), F.when(draw(4, 9) > 0, F.concat(F.lit("k"), draw(5, 4))).alias("c"),
        F.concat(F.lit("k"), draw(6, 2)).alias("c_k0"), (draw(7, 10) < 2).alias("held"), draw(8, 30).alias("e"),
    )
    y = 2 * F.coalesce("a", F.lit(20.0)) + 30 * F.col("b") + F.when(F.col("c") == "k1", 25).otherwise(0) + F.col("e") * 0.5
    return rows.select("*", F.when(F.col("e") > 0, y).alias(TARGET), F.when(F.col("held"), "test").otherwise("train").alias("split")).drop("e", "held").cache()


NUMBERS, CATEGORIES = ["a", "b", "empty"], ["c", "c_k0"]


def test_linear_importance_equals_stacked_predictions(spark, split, monkeypatch):
    data = flows.prepare(split, NUMBERS, CATEGORIES)
    present = data.train.where(F.col(TARGET).isNotNull())
    model = learners.full_model(data.encoder, learners.linear().fit(present))
    test = split.where("split = 'test'")
    of = lambda: {r.feature: r[1:] for r in search.permutation_importance(model, test, [*NUMBERS, *CATEGORIES], repeats=3).collect()}
    with monkeypatch.context() as m:
        m.setattr(search, "line_slots", lambda *_: None)
        want = of()
    monkeypatch.setattr(search, "stacked_drops", None)  # rows are not stacked
    got = of()
    assert got.keys() == want.keys() and got["empty"] == pytest.approx((0, 0), abs=1e-9)
    for name, values in want.items():
        assert got[name] == pytest.approx(values, abs=1e-8), name


@pytest.mark.parametrize("made", [learners.linear, lambda: learners.tree(depth=3)])
def test_subsets_are_slots_of_one_encoding(spark, split, monkeypatch, made):
    estimator = made()
    split = split.where(F.col(TARGET).isNotNull())
    ranked = spark.createDataFrame([("b", 3.0), ("c", 2.0), ("a", 1.0), ("c_k0", 0.5), ("empty", 0.0)], "feature string, importance_mean double")
    want, prepare = {}, flows.prepare
    for name, names in {"all_features": [*NUMBERS, *CATEGORIES], "top_2": ["b", "c"], "top_3": ["a", "b", "c"]}.items():
        data = prepare(split, [c for c in NUMBERS if c in names], [c for c in CATEGORIES if c in names])
        predicted = learners.predict_long({name: estimator.fit(data.train)}, data.test, TARGET, [])
        want[name] = score.reg_metrics_full(predicted).select("MAE", "RMSE", "R2", "acc_10_min").first()
    calls = []
    monkeypatch.setattr(flows, "prepare", lambda *a: calls.append(a) or prepare(*a))
    found = flows.feature_subsets(split, estimator, ranked, NUMBERS, CATEGORIES, sizes=(2, 3)).collect()
    assert len(calls) == 1 and [(r.feature_set, r.n_features) for r in found] == [("all_features", 5), ("top_2", 2), ("top_3", 3)]
    for r in found:
        assert r[2:] == pytest.approx(tuple(want[r.feature_set]), rel=1e-5)


def test_slots_of_columns(spark, split):
    encoder = prep.fit_encoder(split, NUMBERS, CATEGORIES)
    slots, names = prep.slots_of(encoder, split), prep.slot_names(encoder.transform(split))
    assert list(slots) == ["a", "b", "c", "c_k0"] and [s for own in slots.values() for s in own] == list(range(len(names)))
    assert all(names[s] == c or names[s][len(c) :] in ("_k0", "_k1", "_k2", "_k3", "___unknown") for c, own in slots.items() for s in own)
