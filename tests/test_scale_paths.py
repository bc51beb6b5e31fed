"""The ways taken on large data give the same results as plain ones."""

import os
from urllib.parse import unquote

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from lastmile.operators import clean, knn, prep, profile, quantiles, score, search, sizing
from lastmile.sources import tables


@pytest.fixture()
def skewed(spark):
    """A third of all rows share one key and one value; ties and nulls included."""
    rows = spark.range(3000).withColumn("g", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 7)))
    return rows.withColumn(
        "v", F.when(F.col("id") % 3 == 0, F.lit(5.0)).when(F.col("id") % 50 == 1, None).otherwise(F.sqrt("id"))
    ).withColumn("w", F.col("id") % 11 * 1.0)


@pytest.fixture()
def many_ranges(monkeypatch):
    monkeypatch.setattr(quantiles, "ROWS_PER_RANGE", 100)


def test_ranged_quantiles_equal_builtin(skewed, many_ranges):
    wanted = {"v": [0.1, 1 / 3, 0.5, 0.75, 1.0], "w": [0.0, 0.25, 0.9]}
    small, large = quantiles.quantiles(skewed, wanted), quantiles.quantiles(skewed, wanted, small_rows=0)
    for c in wanted:
        assert large[c] == pytest.approx(small[c], abs=1e-12)


def test_ranged_group_quantiles_equal_builtin(skewed, many_ranges):
    keyed = skewed.withColumn("g", F.when(F.col("g") != "g1", F.col("g")))  # one null group
    small = quantiles.grouped_quantiles(keyed, ["g"], "v", [0.25, 0.5, 0.9])
    large = quantiles.grouped_quantiles(keyed, ["g"], "v", [0.25, 0.5, 0.9], small_rows=0)
    a, b = ({r["g"]: r["q"] for r in d.collect()} for d in (small, large))
    assert a.keys() == b.keys()
    for g in a:
        assert b[g] == pytest.approx(a[g], abs=1e-12)


def test_nan_and_infinities_are_treated_alike_at_every_size(spark, monkeypatch):
    nan, inf = float("nan"), float("inf")
    values = [nan] * 5 + [inf] * 30 + [-inf] * 10 + [float(i % 40) for i in range(300)] + [None] * 3
    df = spark.createDataFrame([(v,) for v in values], "v double")
    probs = [0.0, 0.01, 0.05, 0.3, 0.5, 0.77, 0.93, 0.98, 1.0]
    small = quantiles.quantiles(df, {"v": probs})["v"]
    for per_range in (500_000, 100, 10, 3):
        monkeypatch.setattr(quantiles, "ROWS_PER_RANGE", per_range)
        large = quantiles.quantiles(df, {"v": probs}, small_rows=0)["v"]
        assert np.array_equal(np.array(small), np.array(large), equal_nan=True), per_range


def test_large_ranges_are_cut_again(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "ROWS_PER_RANGE", 20)
    monkeypatch.setattr(quantiles, "MAX_RANGES", 4)
    df = spark.range(2000).select(F.sqrt("id").alias("v"), (F.col("id") % 3).alias("g"))
    probs = [0.1, 0.5, 0.999]
    small = quantiles.grouped_quantiles(df, ["g"], "v", probs).collect()
    large = quantiles.grouped_quantiles(df, ["g"], "v", probs, small_rows=0).collect()
    assert {r.g: r.q for r in large} == {r.g: pytest.approx(r.q, abs=1e-12) for r in small}


def test_all_null_column_has_no_quantiles(spark):
    df = spark.range(5).select(F.lit(None).cast("double").alias("x"))
    assert quantiles.quantiles(df, {"x": [0.5]}) == {"x": [None]}
    assert quantiles.quantiles(df, {"x": [0.5]}, small_rows=0) == {"x": [None]}
    assert clean.fit_iqr_bounds(df, ["x"])["x"] == (float("-inf"), float("inf"))


def test_ranged_ranks_equal_window(skewed, many_ranges):
    ranks = quantiles.value_ranks(skewed, ["v", "w"])
    for c in ("v", "w"):
        got = {r["_value"]: (r["_n"], r["_below"]) for r in ranks.where(F.col("_column") == c).collect()}
        values = sorted(r[c] for r in skewed.select(c).collect() if r[c] is not None)
        assert got == {v: (values.count(v), values.index(v)) for v in set(values)}


def test_copies_are_listed_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(sizing, "COPIES_PER_CHUNK", 7)
    df = spark.range(100).select(F.when(F.col("id") < 40, 0).otherwise(F.col("id")).alias("x"), F.lit(None).cast("int").alias("n"))
    assert clean.list_duplicates(df).collect() == [(0, None)] * 39


@pytest.mark.parametrize("partitions", [1, 8])
def test_stratified_split_is_exact_with_hot_copies(spark, monkeypatch, partitions):
    monkeypatch.setattr(prep, "STRATA_BUCKETS", 4)
    df = spark.range(300).select(
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("c"),
        F.when(F.col("id") < 150, 1).otherwise(F.col("id")).alias("k"),
        F.when(F.col("id") < 100, 9).otherwise(F.col("id")).alias("x"),
    ).repartition(partitions)
    split = prep.split_stratified(df, "c", "k", 0.2)
    assert split.count() == 300
    assert sorted(split.drop("split").collect()) == sorted(df.collect())
    tests = {r["c"]: r["count"] for r in split.where("split = 'test'").groupBy("c").count().collect()}
    assert tests == {"a": 20, "b": 40}


def test_running_before_is_a_global_number(spark):
    df = spark.range(200).select((F.col("id") * 37 % 200).alias("x")).repartition(6)
    assert all(r["x"] == r["_before"] for r in sizing.running_before(df, ["x"]).collect())


@pytest.mark.parametrize("chunk", [16, 4096])
def test_nearest_equals_brute_force_with_a_hot_cell(spark, chunk):
    rng = np.random.default_rng(3)
    points = rng.normal(size=(150, 4))
    points[:50] = 0.25  # a third of all rows in one place
    asked = rng.normal(size=(20, 4))
    train = spark.createDataFrame([(i, p.tolist(), float(i % 5)) for i, p in enumerate(points)], "key long, vector array<double>, value double")
    queries = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(asked)], "key long, vector array<double>")
    found = {r["query"]: [n["key"] for n in r["neighbours"]] for r in knn.nearest(train, queries, 4, pivots=6, chunk_rows=chunk).collect()}
    for i, p in enumerate(asked):
        d = np.sqrt(((points - p) ** 2).sum(axis=1))
        assert found[i] == np.lexsort((np.arange(150), d))[:4].tolist()


def test_box_stats_ways_agree(skewed, many_ranges):
    a, b = (sorted(profile.box_stats(skewed, "v", "g", small_rows=n).collect()) for n in (10**6, 0))
    assert [x[:2] for x in a] == [x[:2] for x in b]
    for x, y in zip(a, b):
        assert list(y[2:]) == pytest.approx(list(x[2:]))


@pytest.mark.parametrize("share", [0.04, 0.15, 0.2, 0.25, 0.5])
def test_split_meets_any_share_for_any_keys(spark, share):
    rows = spark.range(20_000).select((F.col("id") * 10).alias("split_key"))
    got = prep.split_random(rows, test_share=share).where("split = 'test'").count() / 20_000
    assert got == pytest.approx(share, abs=0.012)
    folds = prep.assign_folds(rows, 5).groupBy("fold").count().collect()
    assert len(folds) == 5 and min(r["count"] for r in folds) > 3_700


def test_stratified_total_is_exact(spark):
    rows = spark.range(103).select("id", (F.col("id") % 7).cast("string").alias("c"))
    split = prep.split_stratified(rows, "c", "id", 0.2)
    assert split.where("split = 'test'").count() == 21 and split.count() == 103
    per_class = split.where("split = 'test'").groupBy("c").count().collect()
    assert {r["count"] for r in per_class} == {3}


def test_null_and_odd_keys_are_spread(spark):
    rows = spark.createDataFrame([(None,)] * 3 + [("k%d" % i,) for i in range(200)], "split_key string")
    split = prep.split_random(rows)
    assert split.where("split_key IS NULL").select("split").distinct().count() == 1
    assert 20 <= split.where("split = 'test'").count() <= 60


def test_a_cluster_needs_a_shared_folder():
    assert sizing.runs_in_one_process("local[8]") and sizing.runs_in_one_process("local")
    assert not sizing.runs_in_one_process("local-cluster[3,2,1024]")
    assert not sizing.runs_in_one_process("spark://host:7077")


def test_written_tables_can_be_released(spark):
    df = sizing.written(spark.range(10))
    folder = df.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file:").replace("//", "/")
    assert os.path.isdir(folder)
    sizing.release(df)
    assert not os.path.exists(folder)


def test_tolerance_evaluator_keeps_its_minutes(spark, tmp_path):
    path = str(tmp_path / "evaluator")
    score.ToleranceEvaluator(minutes=5).save(path)
    df = spark.createDataFrame([(10.0, 16.0), (10.0, 14.0)], "label double, prediction double")
    assert score.ToleranceEvaluator.load(path).evaluate(df) == 0.5


@pytest.mark.parametrize("rows", [1, 2, 97, 100])
def test_shuffles_are_permutations_of_all_rows(spark, rows):
    found = [
        [r[0] for r in spark.range(rows).select(search.shuffled(F.col("id"), rows, i)).collect()] for i in range(6)
    ]
    assert all(sorted(f) == list(range(rows)) for f in found)
    assert rows < 3 or len({tuple(f) for f in found}) > 3
    wide = 2**40 + 15  # products beyond 64 bits
    (row,) = spark.range(1).select(search.shuffled(F.lit(2**40), wide, 1)).collect()
    assert 0 <= row[0] < wide


def test_importance_of_shuffled_features(spark):
    df = spark.range(400).select((F.col("id") % 20 * 1.0).alias("x"), (F.col("id") % 7 * 1.0).alias("z"), (F.col("id") % 20 * 3.0).alias("y"))
    vectors = VectorAssembler(inputCols=["x", "z"], outputCol="features")
    model = PipelineModel([vectors, LinearRegression(labelCol="y").fit(vectors.transform(df))])
    found = {r.feature: r.importance_mean for r in search.permutation_importance(model, df, ["x", "z"], "y", repeats=3).collect()}
    assert found["z"] == pytest.approx(0, abs=1e-6)
    # Two independent draws of 3 * x differ by sqrt(2) standard deviations.
    assert found["x"] == pytest.approx(3 * np.std(np.arange(20)) * 2**0.5, rel=0.15)


def test_preferred_csv_is_found_among_many(spark, tmp_path):
    for name in ("a.csv", "b [1].csv", "z.csv"):
        (tmp_path / name).write_text("x\n1\n")
    assert unquote(tables.discover_csv(spark, str(tmp_path), "b [1].csv")).endswith("b [1].csv")
    with pytest.warns(UserWarning):
        assert tables.discover_csv(spark, str(tmp_path), "none.csv").endswith("a.csv")
    with pytest.raises(FileNotFoundError):
        tables.discover_csv(spark, os.path.dirname(__file__), "x.csv")
