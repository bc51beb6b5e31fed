"""Registered queries that fit models. Where a plain SQL form exists it is checked too."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lastmile.operators import cluster, compare, knn, learners, prep, score, search
from lastmile.operators.sizing import written
from lastmile.plans import binding, flows
from lastmile.plans.queries import query, rounded, tidy
from lastmile.schema import CATEGORICAL, LABEL, NUMERIC, TARGET
from lastmile.sources import models as model_store
from lastmile.sources import tables


def _split(spark, sf) -> DataFrame:
    # Written once: fitting the preprocessing alone takes several passes.
    return written(prep.split_random(tidy(spark, sf)))


def _data(spark, sf) -> flows.Data:
    return flows.prepare(_split(spark, sf), NUMERIC, CATEGORICAL)


def _scores(spark, sf, **estimators) -> DataFrame:
    data = _data(spark, sf)
    fitted = {n: (e(data.train) if callable(e) else e.fit(data.train)) for n, e in estimators.items()}
    return score.reg_metrics(learners.predict_long(fitted, data.test, TARGET, []))


def _one_feature(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumn("features", array_to_vector(F.array(*[F.col(n) for n in names])))


@query
def reg_mean_baseline(spark, sf):
    train, test = prep.parts(_split(spark, sf))
    return rounded(score.reg_metrics(learners.mean_baseline(train, test)))


@query
def reg_linear(spark, sf):
    """One-feature least squares, so that the slope has an SQL form."""
    train, test = prep.parts(_one_feature(_split(spark, sf), "distancia_km"))
    fitted = learners.linear().fit(train)
    return rounded(fitted.transform(test).select("split_key", "prediction"), 4)


@query
def reg_linear_full(spark, sf):
    return rounded(_scores(spark, sf, linear_regression=learners.linear()))


@query
def reg_ridge(spark, sf):
    return rounded(_scores(spark, sf, ridge_regression=lambda train: learners.ridge(train).fit(train)))


@query
def reg_tree(spark, sf):
    return rounded(_scores(spark, sf, decision_tree_regressor=learners.tree()))


@query
def reg_forest(spark, sf):
    return rounded(_scores(spark, sf, random_forest_regressor=learners.forest()))


@query
def reg_extra_trees(spark, sf):
    return rounded(_scores(spark, sf, extra_trees_regressor=learners.extra_trees()))


@query
def reg_gbt(spark, sf):
    return rounded(_scores(spark, sf, gradient_boosting_regressor=learners.boosted()))


@query
def reg_gbt_hist(spark, sf):
    return rounded(_scores(spark, sf, hist_gradient_boosting_regressor=learners.boosted_hist()))


@query
def reg_gbt_robust(spark, sf):
    return rounded(_scores(spark, sf, gradient_boosting_huber=learners.huber()))


def _embedded(spark, sf) -> tuple[DataFrame, DataFrame]:
    vectors = binding.table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("key"), F.col("embedding").cast("array<double>").alias("vector"),
        F.col("label").alias("value"),
    )
    return vectors.where("key % 10 >= 2"), vectors.where("key % 10 < 2").select("key", "vector")


@query
def reg_knn(spark, sf):
    return rounded(knn.knn_regress(*_embedded(spark, sf), k=5))


@query
def reg_knn_manhattan(spark, sf):
    return rounded(knn.knn_regress(*_embedded(spark, sf), k=7, p=1))


@query
def cls_knn(spark, sf):
    return knn.knn_classify(*_embedded(spark, sf), k=5)


@query
def reg_log_target(spark, sf):
    train, test = prep.parts(_one_feature(_split(spark, sf), "distancia_km"))
    fitted = learners.fit_log_target(train.where(F.col(TARGET) > 0), learners.linear())
    return rounded(fitted.transform(test).select("split_key", "prediction"), 4)


@query
def reg_residual_correction(spark, sf):
    both = _split(spark, sf)
    for column, name in (("distancia_km", "_first"), ("paradas_previas", "_second")):
        both = _one_feature(both, column).withColumnRenamed("features", name)
    train, test = prep.parts(both)
    base, rest = learners.linear(), learners.linear()
    fitted = learners.fit_residual_correction(
        train, base.copy({base.featuresCol: "_first"}), rest.copy({rest.featuresCol: "_second"})
    )
    return rounded(fitted.transform(test).select("split_key", "prediction"), 4)


@query
def reg_residual_trees(spark, sf):
    return rounded(
        _scores(
            spark, sf,
            residual=lambda train: learners.fit_residual_correction(train, learners.tree(depth=3), learners.tree(depth=3)),
        )
    )


@query
def reg_train_many(spark, sf):
    data = _data(spark, sf)
    fitted = learners.train_many(data.train, learners.base_regressors())
    long = learners.predict_long(fitted, data.test, TARGET, ["split_key"])
    return rounded(learners.predict_wide(long, ["split_key"], list(fitted)), 4)


def _class_fit(spark, sf, names: list[str]) -> tuple[prep.ClassData, dict, DataFrame]:
    ready = prep.prepare_by_time(tidy(spark, sf))
    encoder = ready.encoder()
    vectors = written(encoder.transform(ready.rows))
    train, test = vectors.where("split = 'train'"), vectors.where("split = 'test'")
    known = learners.classifiers(train.count()) | {"gradient_boosting": learners.boosted_classifier()}
    fitted = {n: learners.fit_classifier(train, known[n], LABEL) for n in names}
    return ready, fitted, test


def _class_scores(spark, sf, *names: str) -> DataFrame:
    _, fitted, test = _class_fit(spark, sf, list(names))
    return rounded(score.cls_metrics(learners.predict_classes(fitted, test, LABEL, [])))


@query
def cls_tree(spark, sf):
    return _class_scores(spark, sf, "decision_tree")


@query
def cls_forest(spark, sf):
    return _class_scores(spark, sf, "random_forest")


@query
def cls_logistic(spark, sf):
    return _class_scores(spark, sf, "logistic_regression")


@query
def cls_gbt(spark, sf):
    return _class_scores(spark, sf, "gradient_boosting")


@query
def cls_train_many(spark, sf):
    return _class_scores(spark, sf, "decision_tree", "random_forest", "logistic_regression")


# --- clustering ------------------------------------------------------------------------


def _clustered(spark, sf) -> DataFrame:
    return binding.table(spark, sf, "embeddings").select(
        "vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"),
        F.col("label").alias("cluster"),
    )


@query
def kmeans_fit(spark, sf):
    df = tidy(spark, sf)
    vectors = written(prep.fit_encoder(df, NUMERIC, CATEGORICAL, impute=False).transform(df))
    model = cluster.fit_kmeans(vectors, 3, restarts=10)
    return model.transform(vectors).groupBy("cluster").agg(F.count("*").alias("n"))


@query
def pca_2d(spark, sf):
    df = tidy(spark, sf)
    vectors = written(prep.fit_encoder(df, NUMERIC, CATEGORICAL, impute=False).transform(df))
    return rounded(cluster.pca_2d(vectors).select("split_key", "PC1", "PC2"), 4)


@query
def cluster_indexes(spark, sf):
    """Inertia, Calinski-Harabasz and Davies-Bouldin of the labelled embeddings."""
    found = cluster.cluster_indexes(_clustered(spark, sf))
    return rounded(spark.createDataFrame([tuple(found.values())], ", ".join(f"{k} double" for k in found)), 4)


@query
def cluster_quality(spark, sf):
    df = tidy(spark, sf)
    vectors = written(prep.fit_encoder(df, NUMERIC, CATEGORICAL, impute=False).transform(df))
    return rounded(cluster.cluster_quality(vectors), 4)


@query
def cluster_profile(spark, sf):
    df = tidy(spark, sf).withColumn("cluster", F.col("id_bodega").cast("int") % 3)
    return cluster.cluster_profile(df.drop("split_key"))


# --- search, importance -------------------------------------------------------------------


def _folds(spark, sf, folds: int = 5) -> list[tuple[DataFrame, DataFrame]]:
    train = prep.assign_folds(_split(spark, sf).where("split = 'train'"), folds)
    return search.encoded_folds(train, NUMERIC, CATEGORICAL, folds, [TARGET])


def _shown(results: DataFrame) -> DataFrame:
    return rounded(
        results.select(
            "candidate", F.to_json("params").alias("params"), F.size("split_scores").alias("folds"),
            "mean_score", "std_score", "rank",
        ),
        4,
    )


@query
def grid_search(spark, sf):
    grid = search.grid_for("linear_regression")
    return _shown(search.search(search.grid_points(grid), search.fit_named(learners.linear()), _folds(spark, sf)))


@query
def random_search(spark, sf):
    _, points = search.choose_points(search.grid_for("decision_tree_regressor"), limit=0)
    return _shown(
        search.search(points, search.fit_named(learners.tree()), _folds(spark, sf), search.hit_rate_10)
    )


@query
def auto_search(spark, sf):
    method, points = search.choose_points(search.grid_for("ridge_regression", search.SPACES))
    results = search.search(points, search.fit_named(None), _folds(spark, sf), search.neg_mae)
    return _shown(results).withColumn("method", F.lit(method))


@query
def search_results(spark, sf):
    points = search.grid_points(search.grid_for("decision_tree_regressor"))
    results = search.search(points, search.fit_named(learners.tree()), _folds(spark, sf))
    path = tables.write_search_json(results, binding.scratch(spark))
    return spark.read.json(path).select(
        F.col("best.rank").alias("best_rank"), F.size("models").alias("candidates")
    )


@query
def search_many(spark, sf):
    ready = prep.prepare_by_time(tidy(spark, sf))
    rows = ready.rows.where("split = 'train'")
    count = prep.effective_folds(rows, LABEL, 5)
    folds = search.encoded_folds(prep.assign_folds(rows, count), ready.numbers, ready.categories, count, [LABEL])
    found = {
        name: search.search(search.grid_points(space), search.fit_class_named(name), folds, search.f1)
        for name, space in search.CLASS_SPACES.items()
    }
    return rounded(search.search_many(found).select("model", "best_score", F.to_json("params").alias("params")), 4)


@query
def cross_validate(spark, sf):
    return rounded(search.cross_validate(learners.base_regressors(), _folds(spark, sf)), 4)


@query
def cross_validate_line(spark, sf):
    """Five folds of a line on one feature, which SQL can fit too."""
    train = prep.assign_folds(_split(spark, sf).where("split = 'train'"), 5)
    folds = search.encoded_folds(train, ["distancia_km"], [], 5, [TARGET])
    return rounded(search.cross_validate({"line": learners.linear()}, folds), 4)


@query
def reg_ridge_line(spark, sf):
    train, test = prep.parts(_one_feature(_split(spark, sf), "distancia_km"))
    fitted = learners.ridge(train, alpha=1000.0).fit(train)
    return rounded(fitted.transform(test).select("split_key", "prediction"), 4)


@query
def reg_tree_groups(spark, sf):
    """A tree over a feature of seven values predicts the mean of each."""
    train, test = prep.parts(_one_feature(_split(spark, sf), "paradas_previas"))
    fitted = learners.tree(depth=7).fit(train)
    return rounded(fitted.transform(test).select("split_key", "prediction"), 4)


@query
def permutation_importance(spark, sf):
    split = _split(spark, sf)
    data = flows.prepare(split, NUMERIC, CATEGORICAL)
    whole = learners.full_model(data.encoder, learners.tree().fit(data.train))
    return rounded(
        search.permutation_importance(whole, split.where("split = 'test'"), [*NUMERIC, *CATEGORICAL], repeats=10), 4
    )


@query
def tree_importance(spark, sf):
    data = _data(spark, sf)
    return rounded(search.tree_importance(learners.tree().fit(data.train), data.train), 4)


@query
def feature_subset_eval(spark, sf):
    split = _split(spark, sf)
    data = flows.prepare(split, NUMERIC, CATEGORICAL)
    whole = learners.full_model(data.encoder, learners.linear().fit(data.train))
    ranked = written(search.permutation_importance(whole, split.where("split = 'test'"), [*NUMERIC, *CATEGORICAL], repeats=10))
    return rounded(flows.feature_subsets(split, learners.linear(), ranked, NUMERIC, CATEGORICAL, data=data), 4)


# --- persistence and flows ---------------------------------------------------------------


@query
def assemble_stages(spark, sf):
    """Slots of the assembled vector with their mean over the training rows."""
    data = _data(spark, sf)
    names = prep.slot_names(data.train)
    row = data.train.select(Summarizer.mean(F.col("features"))).first()[0]
    return rounded(
        spark.createDataFrame([(n, float(v)) for n, v in zip(names, row)], "slot string, media double"), 4
    )


@query
def model_save_load(spark, sf):
    """Rows where the reloaded model predicts otherwise than the one that was saved."""
    split = _split(spark, sf)
    data = flows.prepare(split, NUMERIC, CATEGORICAL)
    whole = learners.full_model(data.encoder, learners.tree().fit(data.train))
    path = model_store.save_model(whole, binding.scratch(spark), "arbol")
    back = model_store.load_model(spark, path)
    test = split.where("split = 'test'")
    both = whole.transform(test).withColumnRenamed("prediction", "p1").drop("features")
    return back.transform(both).agg(
        F.count("*").alias("filas"), F.count_if(F.col("p1") != F.col("prediction")).alias("distintas")
    )


@query
def final_artifacts(spark, sf):
    """Save the final model with metrics and summary; read the metrics back."""
    found = flows.evaluate(_split(spark, sf), {"linear_regression": learners.linear(), "decision_tree_regressor": learners.tree()})
    best = found["metrics"].where(F.col("model") == found["best"]).select("model", "MAE", "RMSE", "R2")
    row = best.first().asDict()
    text = flows.final_report({k: row[k] for k in ("MAE", "RMSE", "R2")}, row["model"])
    paths = model_store.save_final_artifacts(spark, found["best_model"], best, text, binding.scratch(spark))
    return rounded(
        spark.read.schema("model string, MAE double, RMSE double, R2 double").option("header", True).csv(paths["metrics"]), 4
    )


@query
def final_report(spark, sf):
    train, test = prep.parts(_split(spark, sf))
    row = score.reg_metrics(learners.mean_baseline(train, test)).first().asDict()
    text = flows.final_report({k: row[k] for k in ("MAE", "RMSE", "R2")}, row["model"])
    return spark.read.text(tables.write_text(spark, text, binding.scratch(spark)))


@query
def flow_eval(spark, sf):
    return rounded(flows.evaluate(_split(spark, sf))["metrics"], 4)


@query
def flow_tune(spark, sf):
    found = flows.tune(_split(spark, sf), "decision_tree_regressor", learners.tree())
    return rounded(found["comparison"], 4)


@query
def flow_improve(spark, sf):
    found = flows.improve(_split(spark, sf).where(F.col(TARGET) > 0))
    return rounded(
        compare.union_tables(found["tuned"]["comparison"], found["mean_baseline"].withColumn("version", F.lit("mean"))), 4
    )


@query
def flow_operational(spark, sf):
    return rounded(flows.operational(_split(spark, sf))["versions"], 4)


@query
def flow_precision(spark, sf):
    return rounded(flows.precision(_split(spark, sf))["metrics"], 4)


@query
def flow_hard_errors(spark, sf):
    return rounded(flows.hard_errors(_split(spark, sf))["segment_comparison"], 4)


@query
def flow_classification(spark, sf):
    return rounded(flows.classification(tidy(spark, sf), binding.scratch(spark))["metrics"], 4)


@query
def flow_classification_stops(spark, sf):
    """The flow with one tree on one feature, which predicts the most frequent class of each value."""
    found = flows.classification(
        tidy(spark, sf), binding.scratch(spark), {"one_tree": {"maxDepth": [0]}}, numbers=["paradas_previas"], categories=[],
    )
    return found["predictions"].select(prep.SPLIT_KEY, "real", "predicho")


@query
def flow_clustering(spark, sf):
    return flows.clustering(tidy(spark, sf))["profile"]
