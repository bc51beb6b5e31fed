"""Regressors and classifiers on encoded vectors, and ways to combine them."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, LogisticRegression, OneVsRest
from pyspark.ml.feature import IndexToString, SQLTransformer, StringIndexer
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lastmile.operators import ensembles
from lastmile.operators.ensembles import Trees
from lastmile.schema import TARGET

SEED = 42
PARALLEL = 4
BINS = 64  # of Spark's own trees


def ridge(train: DataFrame, alpha: float = 1.0, label: str = TARGET, intercept: bool = True) -> LinearRegression:
    """Penalty alpha * |w|^2 on the summed squared error, in terms of Spark's objective."""
    row = train.agg(F.count(label).alias("n"), F.stddev_samp(label).alias("s")).first()
    return LinearRegression(
        labelCol=label, regParam=alpha * (row["s"] or 1.0) / max(row["n"], 1), elasticNetParam=0.0,
        standardization=False, solver="l-bfgs", tol=1e-10, maxIter=500, fitIntercept=intercept,
    )


def linear(label: str = TARGET, intercept: bool = True) -> LinearRegression:
    return LinearRegression(labelCol=label, regParam=0.0, fitIntercept=intercept)


def tree(label: str = TARGET, depth: int = 5, min_leaf: int = 1) -> Trees:
    """One tree on all rows."""
    return Trees(labelCol=label, numTrees=1, bootstrap=False, maxDepth=depth, minInstancesPerNode=min_leaf)


def forest(label: str = TARGET, trees: int = 100, depth: int = 0, min_leaf: int = 1, features: str = "all") -> Trees:
    """Trees of bootstrap samples, without a depth limit at depth 0."""
    return Trees(
        labelCol=label, numTrees=trees, maxDepth=depth, minInstancesPerNode=min_leaf, featureSubsetStrategy=features
    )


def extra_trees(label: str = TARGET, trees: int = 200, depth: int = 0, min_leaf: int = 1) -> Trees:
    """Extremely randomised trees: a random cut for each feature of a node, the best of them is taken."""
    return Trees(
        labelCol=label, numTrees=trees, maxDepth=depth, minInstancesPerNode=min_leaf, bootstrap=False, randomCuts=True
    )


def boosted(
    label: str = TARGET, rounds: int = 100, depth: int = 3, rate: float = 0.1, min_leaf: int = 1, share: float = 1.0,
) -> Trees:
    return Trees(
        labelCol=label, kind="boosting", maxIter=rounds, maxDepth=depth, stepSize=rate, minInstancesPerNode=min_leaf,
        subsamplingRate=share,
    )


def boosted_hist(
    label: str = TARGET, rounds: int = 100, depth: int = 0, rate: float = 0.1, leaves: int = 31, min_leaf: int = 20, l2: float = 0.0,
) -> Trees:
    """Trees grown leaf by leaf, 31 leaves of 20 rows or more."""
    return Trees(
        labelCol=label, kind="boosting", maxIter=rounds, maxDepth=depth, stepSize=rate, maxLeaves=leaves,
        minInstancesPerNode=min_leaf, l2=l2,
    )


def huber(label: str = TARGET, rounds: int = 200, rate: float = 0.05, depth: int = 3) -> Trees:
    """Boosting with the Huber loss: residuals are clipped at their 90 % point, leaves hold moved medians."""
    return Trees(labelCol=label, kind="boosting", loss="huber", maxIter=rounds, stepSize=rate, maxDepth=depth)


# --- combinations ---------------------------------------------------------------------


def on_log_target(estimator):
    """The estimator on the columns that ``fit_log_targets`` makes."""
    return estimator.copy({estimator.labelCol: "_log_label", estimator.predictionCol: "_log_prediction"})


def fit_log_targets(train: DataFrame, estimators: dict, label: str = TARGET) -> dict[str, PipelineModel]:
    """Fit on log(1 + y) and predict back on the original scale; each one is a saveable model."""
    hidden = {name: on_log_target(e) for name, e in estimators.items()}
    back = SQLTransformer(
        statement="SELECT * EXCEPT (`_log_prediction`), expm1(`_log_prediction`) AS prediction FROM __THIS__"
    )
    fitted = train_many(train.withColumn("_log_label", F.log1p(label)), hidden) if hidden else {}
    return {name: PipelineModel([model, back]) for name, model in fitted.items()}


def fit_log_target(train: DataFrame, estimator, label: str = TARGET) -> PipelineModel:
    return fit_log_targets(train, {"": estimator}, label)[""]


def correct_residuals(fitted, train: DataFrame, residual, label: str = TARGET) -> PipelineModel:
    """A fitted model with a second one fitted to its training residuals, as one saveable model."""
    left = fitted.transform(train).withColumn("_residual", F.col(label) - F.col("prediction")).drop("prediction")
    second = residual.copy({residual.labelCol: "_residual"}).fit(left)
    keep = SQLTransformer(statement="SELECT * EXCEPT (prediction), prediction AS `_base` FROM __THIS__")
    add = SQLTransformer(statement="SELECT * EXCEPT (prediction, `_base`), `_base` + prediction AS prediction FROM __THIS__")
    return PipelineModel([fitted, keep, second, add])


def fit_residual_correction(train: DataFrame, base, residual, label: str = TARGET) -> PipelineModel:
    return correct_residuals(base.fit(train), train, residual, label)


def mean_baseline(train: DataFrame, test: DataFrame, label: str = TARGET) -> DataFrame:
    """Long predictions of the training mean."""
    mean = train.agg(F.avg(label)).first()[0]
    return test.select(
        F.lit("mean_baseline").alias("model"), F.col(label).alias("real"),
        F.lit(mean).cast("double").alias("predicho"), *[c for c in test.columns if c != label],
    )


def base_regressors(label: str = TARGET) -> dict:
    """The base set; k nearest neighbours is a join, see ``knn``."""
    return {
        "linear_regression": linear(label),
        "decision_tree_regressor": tree(label),
        "random_forest_regressor": forest(label, 100),
        "gradient_boosting_regressor": boosted(label),
        "extra_trees_regressor": extra_trees(label, 200),
        "hist_gradient_boosting_regressor": boosted_hist(label),
    }


def improved_regressors(train: DataFrame, label: str = TARGET) -> dict:
    return {
        "linear_regression": linear(label),
        "ridge_regression": ridge(train, 1.0, label),
        "random_forest_regressor": forest(label, 250),
        "extra_trees_regressor": extra_trees(label, 300),
        "gradient_boosting_regressor": boosted(label),
        "hist_gradient_boosting_regressor": boosted_hist(label, 250),
    }


def train_many(train: DataFrame, estimators: dict) -> dict:
    """Fit all estimators; trees of the same columns in one job, the others side by side."""
    if not estimators:
        raise ValueError("no estimators given")
    groups: dict[tuple, dict] = {}
    for name, e in estimators.items():
        if isinstance(e, Trees):
            columns = tuple(e.getOrDefault(p) for p in ("featuresCol", "labelCol", "maxBins"))
            groups.setdefault(columns, {})[name] = e
    with ThreadPoolExecutor(PARALLEL) as pool:
        plain = {n: pool.submit(e.fit, train) for n, e in estimators.items() if not isinstance(e, Trees)}
        fitted = {}
        for group in groups.values():
            fitted |= ensembles.fit_many(train, group)
        fitted |= {n: f.result() for n, f in plain.items()}
    return {name: fitted[name] for name in estimators}


def predict_long(models: dict, df: DataFrame, label: str, keep: list[str]) -> DataFrame:
    """(model, real, predicho, kept columns) of all models, stacked."""
    out = None
    for name, model in models.items():
        part = model.transform(df).select(
            F.lit(name).alias("model"), F.col(label).alias("real"),
            F.col("prediction").alias("predicho"), *keep,
        )
        out = part if out is None else out.unionAll(part)
    return out


def predict_wide(long: DataFrame, key: list[str], names: list[str]) -> DataFrame:
    """One row per key with real and pred_<model>."""
    return long.groupBy(*key, "real").agg(
        *[F.max(F.when(F.col("model") == n, F.col("predicho"))).alias(f"pred_{n}") for n in names]
    )


# --- classification ----------------------------------------------------------------------


def classifiers(rows: int, classes: int = 3) -> dict:
    return {
        "decision_tree": DecisionTreeClassifier(maxDepth=5, maxBins=BINS, seed=SEED),
        "one_tree": Trees(numTrees=1, bootstrap=False, impurity="gini", classes=classes),
        "random_forest": Trees(numTrees=100, featureSubsetStrategy="sqrt", impurity="gini", classes=classes),
        "logistic_regression": logistic(rows),
    }


def logistic(rows: int, c: float = 1.0, weight: str | None = None, iterations: int = 1000) -> LogisticRegression:
    model = LogisticRegression(
        family="multinomial", regParam=1.0 / (c * max(rows, 1)), elasticNetParam=0.0,
        standardization=False, maxIter=iterations, tol=1e-8,
    )
    return model.setWeightCol(weight) if weight else model


def boosted_classifier(rounds: int = 100, depth: int = 3) -> OneVsRest:
    return OneVsRest(
        classifier=GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=0.1, maxBins=BINS, seed=SEED)
    )


def balanced_weight(train: DataFrame, label: str) -> Column:
    """n / (classes * class size) as a column."""
    counts = train.groupBy(label).count().collect()  # one row per class
    total = sum(r["count"] for r in counts)
    expression = F.lit(1.0)
    for r in counts:
        expression = F.when(
            F.col(label) == r[label], total / (len(counts) * r["count"])
        ).otherwise(expression)
    return expression


def fit_classifier(train: DataFrame, estimator, label: str) -> PipelineModel:
    """Classifier on a text label; ``predicho`` holds the predicted class."""
    index = class_index(train, label)
    if isinstance(estimator, Trees):
        estimator = estimator.copy({estimator.classes: len(index.labels)})
    fitted = estimator.fit(index.transform(train))
    back = IndexToString(inputCol="prediction", outputCol="predicho", labels=index.labels)
    return PipelineModel([fitted, back])


def class_index(train: DataFrame, label: str):
    return StringIndexer(inputCol=label, outputCol="label", stringOrderType="alphabetAsc").fit(train)


def predict_classes(models: dict, df: DataFrame, label: str, keep: list[str]) -> DataFrame:
    out = None
    for name, model in models.items():
        part = model.transform(df).select(
            F.lit(name).alias("model"), F.col(label).alias("real"), "predicho", *keep
        )
        out = part if out is None else out.unionAll(part)
    return out


def full_model(encoder: PipelineModel, fitted) -> PipelineModel:
    """Preprocessing and learner as one model to save."""
    return PipelineModel([*encoder.stages, fitted])
