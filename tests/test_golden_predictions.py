"""Scores of 240 published predictions."""

import os

import pytest
from pyspark.sql import functions as F

from lastmile.operators import score

PATH = os.path.join(os.path.dirname(os.path.abspath(__file__)), "golden", "predictions.csv")


def test_scores_of_published_predictions(spark):
    df = spark.read.schema("real double, predicho double").option("header", True).csv(f"file://{PATH}").withColumn("model", F.lit("m"))
    assert df.count() == 240
    row = score.reg_metrics_full(df).first()
    assert row.MAE == pytest.approx(11.591409, abs=1e-6)
    assert row.RMSE == pytest.approx(14.583611, abs=1e-6)
    assert row.R2 == pytest.approx(0.029033, abs=1e-6)
    hits = [round(row[f"acc_{t}_min"] * 240 / 100) for t in (5, 10, 15, 20)]
    assert hits == [68, 119, 168, 197]
    errors = score.prediction_errors(df).collect()
    assert all(r.error == r.real - r.predicho and r.error_absoluto == abs(r.error) for r in errors)
