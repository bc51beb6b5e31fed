"""Cross validation, grid and random search, feature importance."""

from __future__ import annotations

import itertools
import math
import operator
import random
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import partial, reduce

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lastmile.operators import ensembles, gram, learners
from lastmile.operators.ensembles import Trees
from lastmile.operators.prep import fit_encoder, slot_names, slots_of
from lastmile.operators.score import cls_metrics
from lastmile.operators.sizing import running_before, written
from lastmile.schema import LABEL, TARGET

SEED = 42
PARALLEL = 4
GRID_LIMIT = 120
LONG_ROWS = 2_000_000_000  # whose squares are far below the greatest 64-bit number

# Regression grids (a depth of 0 is no limit).
GRIDS: dict[str, dict[str, list]] = {
    "linear_regression": {"fitIntercept": [True, False]},
    "decision_tree_regressor": {
        "maxDepth": [3, 5, 8, 10, 0], "minInstancesSplit": [2, 5, 10], "minInstancesPerNode": [1, 2, 4],
    },
    "random_forest_regressor": {
        "numTrees": [50, 100, 200], "maxDepth": [3, 5, 8, 0], "minInstancesSplit": [2, 5, 10],
        "minInstancesPerNode": [1, 2, 4],
    },
    "gradient_boosting_regressor": {
        "maxIter": [50, 100, 200], "stepSize": [0.01, 0.05, 0.1], "maxDepth": [2, 3, 5], "minInstancesSplit": [2, 5, 10],
    },
    "extra_trees_regressor": {
        "numTrees": [100, 200, 300], "maxDepth": [5, 8, 0], "minInstancesSplit": [2, 5, 10],
        "minInstancesPerNode": [1, 2, 4],
    },
    "hist_gradient_boosting_regressor": {
        "maxIter": [100, 200], "stepSize": [0.03, 0.05, 0.1], "maxLeaves": [15, 31, 63],
        "minInstancesPerNode": [10, 20, 30],
    },
    "knn_regressor": {"k": [3, 5, 7, 9], "weighted": [False, True], "p": [1, 2]},
}
# The wider spaces.
SPACES: dict[str, dict[str, list]] = {
    "linear_regression": {"fitIntercept": [True, False]},
    "ridge_regression": {"alpha": [0.01, 0.1, 1.0, 5.0, 10.0, 25.0], "fitIntercept": [True, False]},
    "random_forest_regressor": {
        "numTrees": [200, 300, 500, 700], "maxDepth": [0, 8, 12, 16, 24], "minInstancesSplit": [2, 5, 10, 20],
        "minInstancesPerNode": [1, 2, 4, 8], "featureSubsetStrategy": ["sqrt", "log2", "0.6", "0.8"],
    },
    "extra_trees_regressor": {
        "numTrees": [200, 300, 500, 700], "maxDepth": [0, 8, 12, 16, 24], "minInstancesSplit": [2, 5, 10, 20],
        "minInstancesPerNode": [1, 2, 4, 8], "featureSubsetStrategy": ["sqrt", "log2", "0.6", "0.8"],
    },
    "gradient_boosting_regressor": {
        "maxIter": [100, 200, 300, 500], "stepSize": [0.01, 0.03, 0.05, 0.1], "maxDepth": [2, 3, 4, 5],
        "minInstancesSplit": [2, 5, 10], "subsamplingRate": [0.8, 1.0],
    },
    "hist_gradient_boosting_regressor": {
        "stepSize": [0.01, 0.03, 0.05, 0.1], "maxDepth": [0, 4, 6, 8, 10], "maxLeaves": [15, 31, 63, 127],
        "minInstancesPerNode": [10, 20, 30, 50], "l2": [0.0, 0.01, 0.1, 1.0], "maxIter": [200, 300, 500],
    },
}
# Classification spaces.
CLASS_SPACES: dict[str, dict[str, list]] = {
    "random_forest": {
        "numTrees": [100, 200, 300], "maxDepth": [5, 10, 0], "minInstancesSplit": [2, 5, 10],
        "minInstancesPerNode": [1, 2, 4], "impurity": ["gini", "entropy"],
    },
    "logistic_regression": {
        "C": [0.01, 0.1, 1.0, 10.0, 100.0], "balanced": [False, True], "maxIter": [1000, 2000],
    },
}


def grid_for(name: str, spaces: dict = GRIDS) -> dict[str, list]:
    if name not in spaces:
        raise ValueError(f"no parameter grid for {name}; known: {sorted(spaces)}")
    return spaces[name]


def grid_points(grid: dict[str, list]) -> list[dict]:
    return [dict(zip(grid, values)) for values in itertools.product(*grid.values())]


def choose_points(
    grid: dict[str, list], limit: int = GRID_LIMIT, draws: int = 60, seed: int = SEED
) -> tuple[str, list[dict]]:
    """All points of a small grid, a seeded sample of a large one."""
    points = grid_points(grid)
    if len(points) <= limit:
        return "grid", points
    return "randomized", random.Random(seed).sample(points, min(draws, len(points)))


def with_params(estimator, params: dict):
    return estimator.copy({estimator.getParam(k): v for k, v in params.items()})


# --- folds ------------------------------------------------------------------------------


def encoded_fold(
    df: DataFrame, i: int, numbers: list[str], categories: list[str], keep: list[str]
) -> tuple[DataFrame, DataFrame]:
    """(train, validation) vectors of one fold, written once."""
    encoder = fit_encoder(df.where(F.col("fold") != i), numbers, categories)
    vectors = written(encoder.transform(df).select("features", "fold", *keep))
    return vectors.where(F.col("fold") != i), vectors.where(F.col("fold") == i)


def encoded_folds(
    df: DataFrame, numbers: list[str], categories: list[str], folds: int, keep: list[str]
) -> list[tuple[DataFrame, DataFrame]]:
    """(train, validation) vectors per fold; preprocessing is fitted once per fold and the
    vectors are written once, so that every candidate reads the same ones."""
    return [encoded_fold(df, i, numbers, categories, keep) for i in range(folds)]


Moments = dict[tuple[str, int, bool], list[float]]


def fold_moments(models: dict, folds: list[tuple[DataFrame, DataFrame]], label: str = TARGET) -> tuple[Moments, dict[str, str]]:
    """Sums that all scores follow from, by (model, fold, held out), and the error texts of failing models.

    All trees are fitted by one job, least squares by two passes over the folds; others one by one.
    """
    found: Moments = {}
    failed: dict[str, str] = {}

    def collect(names: list[str], rows: DataFrame) -> None:
        for r in rows.collect():
            found[names[r["candidate"]], r["fold"], r["held"]] = list(r["m"])

    def guarded(names: list[str], work: Callable[[], None]) -> None:
        try:
            work()
        except Exception as error:  # a failing candidate must not stop the others
            failed.update({name: f"{type(error).__name__}: {error}" for name in names})

    grouped = [n for n, m in models.items() if isinstance(m, Trees) and m.getOrDefault("labelCol") == label]
    lines = [n for n, m in models.items() if plain_line(m, label) is not None]
    if grouped:
        guarded(grouped, lambda: collect(grouped, ensembles.score_many([models[n] for n in grouped], folds, with_train=True)))
    if lines:
        points = [plain_line(models[n], label) for n in lines]
        guarded(lines, lambda: collect(lines, gram.score_many(points, folds, label, with_train=True)))

    def run(job: tuple[str, int]) -> None:
        name, i = job

        def work() -> None:
            fitted = models[name].copy().fit(folds[i][0])
            for held in (False, True):
                found[name, i, held] = frame_moments(fitted.transform(folds[i][int(held)]), label)

        guarded([name], work)

    with ThreadPoolExecutor(PARALLEL) as pool:
        list(pool.map(run, [(n, i) for n in models if n not in {*grouped, *lines} for i in range(len(folds))]))
    return found, failed


def plain_line(estimator, label: str = TARGET) -> tuple[float, bool] | None:
    """(penalty, intercept) of unpenalised least squares, None for any other estimator."""
    if isinstance(estimator, learners.LinearRegression) and estimator.getLabelCol() == label and not estimator.getRegParam():
        return 0.0, estimator.getFitIntercept()
    return None


def frame_moments(scored: DataFrame, label: str) -> list[float]:
    y, e = F.col(label), F.col(label) - F.col("prediction")
    hit = (F.abs(e) <= 10).cast("double")
    row = scored.agg(F.count(y), F.sum(e), F.sum(F.abs(e)), F.sum(e * e), F.sum(y), F.sum(y * y), F.sum(hit)).first()
    return [float(v or 0.0) for v in row]


def scores_of(m: list[float]) -> dict[str, float | None]:
    """MAE, RMSE and R2 of moments; where the label does not vary R2 is 1 for exact predictions, else 0."""
    n, _, abs_e, e2, y, y2, _ = m
    spread = y2 - y * y / n if n else 0.0
    return {
        "mae": abs_e / n if n else None, "rmse": (e2 / n) ** 0.5 if n else None,
        "r2": None if not n else 1 - e2 / spread if spread > 1e-12 * y2 else float(e2 == 0),
    }


def cross_validate(
    models: dict, folds: list[tuple[DataFrame, DataFrame]], label: str = TARGET
) -> DataFrame:
    """Mean and spread of the scores over the folds; a failing model gives its error text."""
    found, failed = fold_moments(models, folds, label)
    columns = [
        f"cv_{m}_{s}" for m in ("mae", "rmse", "r2") for s in ("mean", "std")
    ] + [f"train_{m}_mean" for m in ("mae", "rmse", "r2")]
    rows = []
    for name in models:
        values: list = [None] * len(columns)
        if name not in failed:
            by = {held: [scores_of(found[name, i, held]) for i in range(len(folds))] for held in (True, False)}
            listed = {(held, m): [s[m] for s in by[held] if s[m] is not None] for held in by for m in ("mae", "rmse", "r2")}
            mean = lambda v: sum(v) / len(v) if v else None
            spread = lambda v: (sum((x - mean(v)) ** 2 for x in v) / len(v)) ** 0.5 if v else None
            values = [f(listed[True, m]) for m in ("mae", "rmse", "r2") for f in (mean, spread)]
            values += [mean(listed[False, m]) for m in ("mae", "rmse", "r2")]
        rows.append((name, *values, failed.get(name, "")))
    spark = folds[0][0].sparkSession
    schema = "model string, " + ", ".join(f"{c} double" for c in columns) + ", cv_error string"
    return spark.createDataFrame(rows, schema).orderBy(F.asc_nulls_last("cv_rmse_mean"), "model")


Score = Callable[[DataFrame], float]


def neg_rmse(scored: DataFrame, label: str = TARGET) -> float:
    error = F.col(label) - F.col("prediction")
    return -scored.agg(F.sqrt(F.avg(error * error))).first()[0]


def neg_mae(scored: DataFrame, label: str = TARGET) -> float:
    return -scored.agg(F.avg(F.abs(F.col(label) - F.col("prediction")))).first()[0]


def hit_rate_10(scored: DataFrame, label: str = TARGET) -> float:
    hit = F.abs(F.col(label) - F.col("prediction")) <= 10
    return scored.agg(F.avg(hit.cast("double"))).first()[0]


def f1(scored: DataFrame, label: str = LABEL, average: str = "macro") -> float:
    long = scored.select(F.lit("m").alias("model"), F.col(label).alias("real"), "predicho")
    return cls_metrics(long).first()[f"f1_{average}"]


def f1_of_confusion(m: list[float], average: str = "macro") -> float:
    """F1 of a confusion matrix by rows (true classes), over the classes that occur or are predicted."""
    size = int(round(len(m) ** 0.5))
    table = [m[i * size : (i + 1) * size] for i in range(size)]
    out = []
    for k in range(size):
        true, predicted = sum(table[k]), sum(row[k] for row in table)
        if true or predicted:
            out.append((2 * table[k][k] / (true + predicted), true))
    total = sum(t for _, t in out)
    return sum(f for f, _ in out) / len(out) if average == "macro" else sum(f * t for f, t in out) / total


# The scores that follow from moments; other scores are taken on the predicted rows.
FROM_MOMENTS: dict[Score, Callable[[list[float]], float]] = {
    neg_rmse: lambda m: -((m[3] / m[0]) ** 0.5), neg_mae: lambda m: -m[2] / m[0], hit_rate_10: lambda m: m[6] / m[0],
    f1: f1_of_confusion,
}


def search(
    points: list[dict],
    fit: Callable[[DataFrame, dict], object],
    folds: list[tuple[DataFrame, DataFrame]],
    score: Score = neg_rmse,
) -> DataFrame:
    """One row per candidate: parameters, score per fold, mean, population std, rank.

    ``fit`` trains one candidate on one fold's rows. Scores are larger-is-better. Candidates
    that are trees, least squares or ridge regressions are fitted and scored on all folds together.
    """
    together = fit.together(points, folds) if hasattr(fit, "together") and score in FROM_MOMENTS else None
    if together is not None:
        found = {(r["candidate"], r["fold"]): FROM_MOMENTS[score](list(r["m"])) for r in together.where("held").collect()}
        flat = [float(found[p, i]) for p in range(len(points)) for i in range(len(folds))]
    else:
        flat = scored_apart(points, fit, folds, score)
    rows = []
    for p, point in enumerate(points):
        scores = flat[p * len(folds) : (p + 1) * len(folds)]
        mean = sum(scores) / len(scores)
        spread = (sum((s - mean) ** 2 for s in scores) / len(scores)) ** 0.5
        rows.append([p, {k: str(v) for k, v in point.items()}, scores, mean, spread])
    means = sorted((r[3] for r in rows), reverse=True)
    return (
        folds[0][0].sparkSession.createDataFrame(
            [(*r, means.index(r[3]) + 1) for r in rows],
            "candidate int, params map<string,string>, split_scores array<double>, "
            "mean_score double, std_score double, rank int",
        )
        .orderBy("rank", "candidate")
    )


def scored_apart(points: list[dict], fit: Callable, folds: list[tuple[DataFrame, DataFrame]], score: Score) -> list[float]:
    """The score of each candidate on each fold, each fitted on its own.

    Candidates that differ in their greatest number of iterations only share a fit, if it
    ended before the smallest of these numbers.
    """
    groups: dict[tuple, list[int]] = {}
    for p, point in enumerate(points):
        groups.setdefault(tuple((k, v) for k, v in point.items() if k != "maxIter"), []).append(p)

    def run(job: tuple[list[int], int]) -> list[tuple[int, int, float]]:
        group, i = job
        train, test = folds[i]
        most = max(group, key=lambda p: points[p].get("maxIter", 0))
        model = fit(train, points[most])
        value, taken = float(score(model.transform(test))), iterations_of(model)
        out = []
        for p in group:
            same = p == most or (taken is not None and taken < points[p].get("maxIter", 0))
            out.append((p, i, value if same else float(score(fit(train, points[p]).transform(test)))))
        return out

    with ThreadPoolExecutor(PARALLEL) as pool:
        done = pool.map(run, [(group, i) for group in groups.values() for i in range(len(folds))])
        found = {(p, i): value for part in done for p, i, value in part}
    return [found[p, i] for p in range(len(points)) for i in range(len(folds))]


def iterations_of(model) -> int | None:
    """How many iterations a fitted classifier took, where it says so."""
    first = getattr(model, "stages", [model])[0]
    return first.summary.totalIterations if getattr(first, "hasSummary", False) else None


class FitNamed:
    """A ``fit`` for ``search``: the estimator with a candidate's parameters set; None stands for ridge."""

    def __init__(self, estimator, label: str = TARGET):
        self.estimator, self.label = estimator, label

    def __call__(self, train: DataFrame, params: dict):
        if "alpha" in params:
            return learners.ridge(train, params["alpha"], self.label, params.get("fitIntercept", True)).fit(train)
        return with_params(self.estimator, params).fit(train)

    def together(self, points: list[dict], folds: list[tuple[DataFrame, DataFrame]]) -> DataFrame | None:
        if isinstance(self.estimator, Trees):
            return ensembles.score_many([with_params(self.estimator, p) for p in points], folds)
        if all(set(p) <= {"alpha", "fitIntercept"} for p in points) and (
            all("alpha" in p for p in points) or plain_line(self.estimator, self.label) is not None
        ):
            lines = [(float(p.get("alpha", 0.0)), p.get("fitIntercept", True)) for p in points]
            return gram.score_many(lines, folds, self.label)
        return None


def fit_named(estimator, label: str = TARGET) -> FitNamed:
    return FitNamed(estimator, label)


class FitClassNamed:
    """A ``fit`` for ``search`` of a named classifier; penalties go by the rows of each fold's training part."""

    def __init__(self, name: str, label: str = LABEL):
        self.name, self.label = name, label

    def __call__(self, train: DataFrame, params: dict):
        rows = train.count()
        if self.name == "logistic_regression":
            weight = "_weight" if params.get("balanced") else None
            ready = train.withColumn("_weight", learners.balanced_weight(train, self.label)) if weight else train
            model = learners.logistic(rows, params["C"], weight, params["maxIter"])
            return learners.fit_classifier(ready, model, self.label)
        return learners.fit_classifier(train, with_params(learners.classifiers(rows)[self.name], params), self.label)

    def together(self, points: list[dict], folds: list[tuple[DataFrame, DataFrame]]) -> DataFrame | None:
        base = learners.classifiers(1)[self.name]
        if not isinstance(base, Trees):
            return None
        # Numbered alike in all folds; every class is in every fold, see effective_folds.
        index = learners.class_index(folds[0][0].select(self.label).unionAll(folds[0][1].select(self.label)), self.label)
        numbered = [(index.transform(a), index.transform(b)) for a, b in folds]
        classes = len(index.labels)
        return ensembles.score_many([with_params(base, {**p, "classes": classes}) for p in points], numbered)


def fit_class_named(name: str, label: str = LABEL) -> FitClassNamed:
    return FitClassNamed(name, label)


def best_row(results: DataFrame) -> dict:
    return results.orderBy("rank", "candidate").first().asDict(recursive=True)


def search_many(searches: dict[str, DataFrame]) -> DataFrame:
    """Best candidate per model, best model first."""
    rows = [
        r.orderBy("rank", "candidate").limit(1).select(
            F.lit(name).alias("model"), F.col("mean_score").alias("best_score"), "params"
        )
        for name, r in searches.items()
    ]
    return reduce(DataFrame.unionAll, rows).orderBy(F.desc("best_score"), "model")


# --- importance ---------------------------------------------------------------------------


def shuffled(number: Column, rows: int, repeat: int, seed: int = SEED) -> Column:
    """A permutation of the numbers 0 to rows - 1: factor * number + shift, with a factor that has no divisor in common."""
    draw = random.Random(f"{seed}-{repeat}")
    factor = draw.randrange(1, max(rows, 2))
    while math.gcd(factor, rows) != 1:
        factor += 1
    if 0 < rows <= LONG_ROWS:
        return (number * F.lit(factor).cast("long") + F.lit(draw.randrange(rows)).cast("long")) % F.lit(rows).cast("long")
    wide = number.cast("decimal(19,0)") * F.lit(factor).cast("decimal(19,0)") + F.lit(draw.randrange(max(rows, 1)))
    return (wide % F.lit(rows).cast("decimal(19,0)")).cast("long")


def permutation_importance(
    model, test: DataFrame, features: list[str], label: str = TARGET, repeats: int = 10, seed: int = SEED
) -> DataFrame:
    """Mean and population std of the RMSE increase when one raw feature is shuffled.

    Rows are numbered once in the order of a hash. Each repeat pairs every row with the one whose
    number a permutation gives, so that the shuffle is one over all rows at every size. A linear
    model is a sum of what the features add, so that rows are encoded once and only these sums are
    paired; for other models all features and repeats are scored in one pass over the stacked frame.
    """
    kept = written(test.select(*features, label).withColumn("_id", F.monotonically_increasing_id()))
    keyed = running_before(kept.withColumn("_h", F.xxhash64("_id", F.lit(seed))), ["_h", "_id"], name="_n").drop("_h")
    slots = line_slots(model, test, features)
    drops = stacked_drops if slots is None else partial(line_drops, slots=slots)
    return (
        drops(model, keyed, features, label, repeats, seed).groupBy("feature")
        .agg(F.avg("drop").alias("importance_mean"), F.stddev_pop("drop").alias("importance_std"))
        .orderBy(F.desc("importance_mean"), "feature")
    )


def stacked_drops(model, keyed: DataFrame, features: list[str], label: str, repeats: int, seed: int) -> DataFrame:
    """(feature, repeat, drop) from predictions for all rows with one feature of another row, for each feature and repeat."""
    keyed = written(keyed)
    rows = keyed.count()
    frames = []
    for i in range(repeats):
        receiver = keyed.withColumn("_from", shuffled(F.col("_n"), rows, i, seed))
        donor = keyed.select(F.col("_n").alias("_from"), F.struct(*features).alias("_donor"))
        paired = receiver.join(donor, "_from")
        swapped = F.array(
            *[
                F.struct(
                    F.lit(f).alias("feature"),
                    *[F.col(f"_donor.{c}" if c == f else c).alias(c) for c in features],
                )
                for f in features
            ]
        )
        frames.append(
            paired.select(F.lit(i).alias("repeat"), label, F.explode(swapped).alias("_x")).select(
                "repeat", label, "_x.*"
            )
        )
    stacked = reduce(DataFrame.unionAll, frames)
    error = F.col(label) - F.col("prediction")
    plain = -neg_rmse(model.transform(keyed), label)
    return (
        model.transform(stacked)
        .groupBy("feature", "repeat")
        .agg((F.sqrt(F.avg(error * error)) - F.lit(plain)).alias("drop"))
    )


def line_slots(model, df: DataFrame, features: list[str]) -> dict[str, list[int]] | None:
    """The slots of each feature, if the model is ``fit_encoder``'s preprocessing and a linear regression on its vectors."""
    stages = getattr(model, "stages", [])
    makers = [s for s in stages if isinstance(s, VectorAssembler)]
    if len(makers) != 1 or not isinstance(stages[-1], LinearRegressionModel):
        return None
    inputs = makers[0].getInputCols()
    own = makers[0].getOutputCol() == stages[-1].getFeaturesCol() and stages[-1].getPredictionCol() == "prediction"
    if not own or not all(c[:5] in ("_num_", "_hot_") and c[5:] in features for c in inputs):
        return None
    return slots_of(PipelineModel(stages[:-1]), df)


def line_drops(
    model, keyed: DataFrame, features: list[str], label: str, repeats: int, seed: int, slots: dict[str, list[int]]
) -> DataFrame:
    """(feature, repeat, drop) of a linear model: what a feature adds for a row is replaced by what it adds for another one."""
    line = model.stages[-1]
    x, weights = F.col("_x"), line.coefficients.toArray()
    added = {f: reduce(operator.add, [F.lit(float(weights[s])) * x[s] for s in slots.get(f, [])], F.lit(0.0)) for f in features}
    encoded = PipelineModel(model.stages[:-1]).transform(keyed).select(
        "_n", F.col(label).alias("_y"), vector_to_array(line.getFeaturesCol()).alias("_x")
    )
    own = [f"_c{k}" for k in range(len(features))]
    error = F.col("_y") - reduce(operator.add, [F.col(c) for c in own], F.lit(float(line.intercept)))
    sums = encoded.select("_n", "_y", *[added[f].alias(c) for f, c in zip(features, own)])
    table = written(sums.select("_n", error.alias("_e"), *own))
    rows, plain = table.agg(F.count("*"), F.sqrt(F.avg(F.col("_e") * F.col("_e")))).first()
    donor = table.select(F.col("_n").alias("_from"), *[F.col(c).alias(f"{c}_other") for c in own])
    found = []
    for i in range(repeats):
        pairs = table.withColumn("_from", shuffled(F.col("_n"), rows, i, seed)).join(donor, "_from")
        swapped = [F.col("_e") + F.col(c) - F.col(f"{c}_other") for c in own]
        one = pairs.agg(*[F.sqrt(F.avg(e * e)).alias(c) for e, c in zip(swapped, own)])
        each = F.array(*[F.struct(F.lit(f).alias("feature"), (F.col(c) - F.lit(plain)).alias("drop")) for f, c in zip(features, own)])
        found.append(one.select(F.lit(i).alias("repeat"), F.explode(each).alias("_r")).select("_r.feature", "repeat", "_r.drop"))
    return reduce(DataFrame.unionAll, found)


def tree_importance(fitted, encoded: DataFrame, top: int = 15) -> DataFrame:
    """Impurity importance per vector slot with its feature name."""
    names = slot_names(encoded)
    values = [float(v) for v in fitted.featureImportances]
    return (
        encoded.sparkSession.createDataFrame(list(zip(names, values)), "feature string, importance double")
        .orderBy(F.desc("importance"), "feature")
        .limit(top)
    )
