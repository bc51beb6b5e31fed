"""Toxicity: accuracy on labels that were held out, features and odd tables."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from lastmile.llm import toxicity
from lastmile.llm.boosting import BoostedTrees, Isotonic
from lastmile.llm.queries import QUERIES

MEDIUM = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{MEDIUM}/labels.parquet").collect()}
    rows = QUERIES["op9_toxicity"](spark, MEDIUM).collect()
    assert len(rows) == spark.read.parquet(f"{MEDIUM}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([p == y for p, y in held]) >= 0.97
    clean = [p for p, y in held if not y]
    assert np.mean(clean) <= 0.01


def test_features():
    x = dict(zip(toxicity.FEATURES, toxicity.features("You are an IDIOT, st*pid m0r0n! i d i o t", frozenset())))
    assert x["listed_count"] == 1 and x["hidden_count"] == 2 and x["near_second_person"] > 0
    assert toxicity.features(None, frozenset()) == [0.0] * len(toxicity.FEATURES)
    assert dict(zip(toxicity.FEATURES, toxicity.features("zork " * 3, frozenset({"zork"}))))["learnt_count"] == 3


def test_odd_rows_and_tables(spark):
    docs = spark.createDataFrame(
        [(i, "plain words here " * 5 if i % 2 else "you stupid idiot " * 5, "s") for i in range(200)]
        + [(None, None, None), (7, "", "s"), (7, "", "s"), (500, "x" * 300_000, "s")],
        "doc_id long, text string, score string",
    )
    labels = spark.createDataFrame(
        [(i, 1 - i % 2) for i in range(200)] + [(None, 1), (3, None), (4, 1)], "doc_id long, toxic int"
    )
    out = toxicity.scored(docs, labels)
    assert out.columns == ["doc_id", "text", "score", "predicted"] and out.count() == 204
    wrong = out.where("doc_id < 200 AND text <> '' AND predicted <> 1 - doc_id % 2").count()
    assert wrong == 0
    kept = toxicity.without_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.where(F.col("text").contains("idiot")).count() == 0
    assert toxicity.scored(docs.limit(0), labels).count() == 0
    assert toxicity.scored(docs, labels.limit(0)).where("predicted = 0").count() == 204


def test_boosting_and_calibration():
    rnd = np.random.default_rng(0)
    x = rnd.normal(size=(2000, 3))
    y = (x[:, 0] * x[:, 1] > 0).astype(float)
    p = BoostedTrees(rounds=40).fit(x[:1500], y[:1500]).probability(x[1500:])
    assert ((p > 0.5) == y[1500:]).mean() > 0.9
    c = Isotonic.fit(p, y[1500:])
    assert (np.diff(c(np.linspace(0, 1, 50))) >= 0).all()
