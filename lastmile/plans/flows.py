"""Whole analyses: cleaned deliveries to compared, chosen and reported models.

Every flow takes the estimators it should try, so that small runs stay small; the
defaults are the full sets. Vectors are written once per flow and shared by all fits.
"""

from __future__ import annotations

import operator
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lastmile.operators import cluster, compare, features, gram, learners, prep, score, search
from lastmile.operators.sizing import written
from lastmile.schema import CATEGORICAL, FEATURES, LABEL, NUMERIC, TARGET
from lastmile.sources import models as model_store


@dataclass
class Data:
    """Split rows and their vectors."""

    train: DataFrame
    test: DataFrame
    encoder: PipelineModel
    numbers: list[str]
    categories: list[str]
    key: str


def prepare(
    split: DataFrame, numbers: list[str], categories: list[str], key: str = prep.SPLIT_KEY
) -> Data:
    encoder = prep.fit_encoder(split.where("split = 'train'"), numbers, categories)
    vectors = written(encoder.transform(split))
    return Data(
        vectors.where("split = 'train'"), vectors.where("split = 'test'"), encoder, numbers, categories, key
    )


def _score(data: Data, models: dict) -> tuple[DataFrame, DataFrame]:
    keep = list(dict.fromkeys([data.key, *[c for c in FEATURES if c in data.test.columns]]))
    predicted = written(learners.predict_long(models, data.test, TARGET, keep))
    return predicted, written(score.reg_metrics_full(predicted))


def evaluate(split: DataFrame, estimators: dict | None = None, numbers=NUMERIC, categories=CATEGORICAL) -> dict:
    """Fit all, score, choose, and list the chosen model's errors."""
    data = prepare(split, list(numbers), list(categories))
    models = learners.train_many(data.train, estimators or learners.base_regressors())
    predicted, metrics = _score(data, models)
    best = compare.rank_models(metrics).first()["model"]
    return {
        "data": data, "models": models, "predictions": predicted, "metrics": metrics, "best": best,
        "best_model": learners.full_model(data.encoder, models[best]),
        "best_predictions": score.prediction_errors(predicted.where(F.col("model") == best)),
    }


def tune(
    split: DataFrame, name: str, estimator, grid: dict[str, list] | None = None, folds: int = 5,
    limit: int = search.GRID_LIMIT, draws: int = 60, objective: search.Score = search.neg_rmse,
    numbers=NUMERIC, categories=CATEGORICAL,
) -> dict:
    """Search one model's parameters, refit the best, and compare it with its base form."""
    numbers, categories = list(numbers), list(categories)
    train = prep.assign_folds(split.where("split = 'train'"), folds)
    made = search.encoded_folds(train, numbers, categories, folds, [TARGET])
    method, points = search.choose_points(grid or search.grid_for(name), limit, draws)
    fit = search.fit_named(estimator)
    results = written(search.search(points, fit, made, objective))
    best = points[search.best_row(results)["candidate"]]
    data = prepare(split, numbers, categories)
    models = {name: estimator.fit(data.train), f"{name}_tuned": fit(data.train, best)}
    predicted, metrics = _score(data, models)
    base = metrics.where(F.col("model") == name)
    tuned = metrics.where(F.col("model") == f"{name}_tuned")
    return {
        "method": method, "results": results, "best_params": best, "metrics": metrics,
        "predictions": predicted, "models": models, "data": data,
        "comparison": compare.compare_versions(base, tuned, name),
        "chosen": compare.choose_final(base, tuned),
    }


def improve(split: DataFrame, estimators: dict | None = None, grid: dict | None = None, **options) -> dict:
    """Engineered features, a wider model set, automatic search of the best, mean baseline."""
    numbers = [*NUMERIC, *features.IMPROVED_NUMERIC]
    categories = [*CATEGORICAL, *features.IMPROVED_CATEGORICAL]
    ready = written(features.add_improved_features(split))
    tried = estimators or learners.improved_regressors(ready.where("split = 'train'"))
    base = evaluate(ready, tried, numbers, categories)
    space = grid or search.grid_for(base["best"], search.SPACES)
    tuned = tune(
        ready, base["best"], tried[base["best"]], space, numbers=numbers, categories=categories, **options
    )
    name = tuned["chosen"].first()["model"]
    chosen = tuned["predictions"].where(F.col("model") == name)
    mean = learners.mean_baseline(base["data"].train, base["data"].test.select(base["data"].key, TARGET))
    return {
        **base, "tuned": tuned, "recommended": name,
        "tolerance": score.tolerance_hits(chosen),
        "mean_baseline": score.reg_metrics(mean),
        "final_predictions": score.prediction_errors(chosen),
    }


def operational(split: DataFrame, estimators: dict | None = None, grid: dict | None = None, **options) -> dict:
    """Logistics features; selection and search by the 10 minute hit rate."""
    cuts = features.fit_cuts(split.where("split = 'train'"), features.LOGISTICS_CUTS)
    numbers = features.feature_union(NUMERIC, features.LOGISTICS_NUMERIC)
    categories = [*CATEGORICAL, *features.LOGISTICS_CATEGORICAL]
    ready = written(features.add_logistics_features(split, cuts))
    tried = estimators or learners.base_regressors()
    base = evaluate(ready, tried, numbers, categories)
    accuracy = score.tolerance_accuracy(base["predictions"])
    best = compare.rank_operational(base["metrics"].select("model", "MAE", "RMSE", "R2"), accuracy).first()["model"]
    tuned = tune(
        ready, best, tried[best], grid, objective=search.hit_rate_10,
        numbers=numbers, categories=categories, **options,
    )
    rows = {n: tuned["metrics"].where(F.col("model") == m) for n, m in (("base", best), ("tuned", f"{best}_tuned"))}
    chosen = compare.choose_final(rows["base"], rows["tuned"], operational_first=True)
    versions = compare.current_vs_improved(
        chosen.select("model", "MAE", "RMSE", "R2"), score.tolerance_accuracy(tuned["predictions"])
    )
    return {
        **base, "tuned": tuned, "accuracy": accuracy, "chosen": chosen, "versions": versions,
        "tolerance_comparison": compare.tolerance_comparison(accuracy.where(F.col("model") == best)),
        "conclusion": chosen.select("model", compare.operational_conclusion().alias("conclusion")),
    }


def precision(
    split: DataFrame, estimators: dict | None = None, folds: int = 5, repeats: int = 10, draws: int = 30,
    technical: dict = compare.OPTIMIZED_VERSION, stored: dict = compare.OPTIMIZED_VERSION,
    operational: dict = compare.OPERATIONAL_VERSION,
) -> dict:
    """Adds precision features, group means and log targets; search of the best plain model's
    parameters by RMSE, cross validation, importance, segments and feature subsets of the
    chosen model. In the search the group means are learnt on each fold's training rows.
    """
    train = split.where("split = 'train'")
    cuts = features.fit_cuts(train, [*features.LOGISTICS_CUTS, *features.PRECISION_CUTS])
    ready = features.add_precision_features(features.add_logistics_features(split, cuts), cuts)
    ready = written(prep.GroupMeans().fit(train).transform(ready))
    numbers = features.feature_union(
        NUMERIC, features.LOGISTICS_NUMERIC, features.PRECISION_NUMERIC, features.HISTORY_NUMERIC
    )
    categories = features.feature_union(
        CATEGORICAL, features.LOGISTICS_CATEGORICAL, features.PRECISION_CATEGORICAL
    )
    tried = estimators or {
        "random_forest_regressor": learners.forest(trees=250),
        "extra_trees_regressor": learners.extra_trees(trees=300),
        "gradient_boosting_regressor": learners.boosted(),
        "hist_gradient_boosting_regressor": learners.boosted_hist(rounds=250),
    }
    data = prepare(ready, numbers, categories)
    positive = data.train.where(F.col(TARGET) > 0)
    models = learners.train_many(data.train, tried)
    logs = learners.fit_log_targets(positive, tried)
    models |= {f"{n}_log_target": model for n, model in logs.items()}
    predicted, metrics = _score(data, models)
    folded = prep.assign_folds(ready.where("split = 'train'"), folds)
    first = compare.rank_precision(metrics.where(F.col("model").isin(*tried))).first()["model"]
    tuned, results, plain = f"{first}_rmse_tuned", None, dict(tried)
    if first in search.GRIDS:
        _, points = search.choose_points(search.grid_for(first), draws=draws)
        made = [
            search.encoded_fold(
                prep.GroupMeans().fit(folded.where(F.col("fold") != i)).transform(folded.drop(*features.HISTORY_NUMERIC)),
                i, numbers, categories, [TARGET],
            )
            for i in range(folds)
        ]
        results = written(search.search(points, search.fit_named(tried[first]), made, search.neg_rmse))
        plain[tuned] = search.with_params(tried[first], points[search.best_row(results)["candidate"]])
        models[tuned] = plain[tuned].fit(data.train)
        more, more_metrics = _score(data, {tuned: models[tuned]})
        predicted, metrics = predicted.unionByName(more), metrics.unionByName(more_metrics)
    best = compare.rank_precision(metrics).first()["model"]
    # Means of the target over all training rows would leak into the folds.
    leak_free = [c for c in numbers if c not in features.HISTORY_NUMERIC]
    validated = search.cross_validate(
        plain, search.encoded_folds(folded, leak_free, categories, folds, [TARGET])
    )
    whole = learners.full_model(data.encoder, models[best])
    importance = written(
        search.permutation_importance(whole, ready.where("split = 'test'"), [*numbers, *categories], repeats=repeats)
    )
    errors = score.error_segments(score.error_direction(predicted.where(F.col("model") == best)))
    versions = compare.version_row(split, stored).select(
        "version", "MAE", "RMSE", "R2", "acc_5_min", "acc_10_min", "acc_15_min"
    )
    row = metrics.where(F.col("model") == best)
    versions = versions.unionByName(
        row.select(F.lit("precision_experiment").alias("version"), *versions.columns[1:])
    )
    return {
        "data": data, "models": models, "metrics": metrics, "best": best, "best_model": whole,
        "search": results, "predictions": predicted, "cross_validation": validated, "importance": importance,
        "segments": score.segment_metrics(errors),
        "subsets": feature_subsets(ready, plain[best.removesuffix("_log_target")], importance, numbers, categories, data=data),
        "versions": compare.decision_notes(versions, technical, operational),
        "conclusion": row.select("model", compare.precision_conclusion(technical, operational).alias("conclusion")),
    }


def feature_subsets(
    ready: DataFrame, estimator, importance: DataFrame, numbers: list[str], categories: list[str],
    sizes: tuple[int, ...] = (5, 8, 10), data: Data | None = None,
) -> DataFrame:
    """Scores of the model refitted on all features and on the most important ones.

    Preprocessing is each column's own, so that all subsets are slots of the same vectors; ``data``
    has them if they were made before.
    """
    ranked = [r["feature"] for r in importance.orderBy(F.desc("importance_mean"), "feature").collect()]
    chosen = {"all_features": [*numbers, *categories], **{f"top_{n}": ranked[:n] for n in sizes}}
    data = data or prepare(ready, numbers, categories)
    slots = prep.slots_of(data.encoder, ready)
    own = {name: [s for c in [*numbers, *categories] if c in names for s in slots.get(c, [])] for name, names in chosen.items()}
    line = search.plain_line(estimator)
    if line is not None:
        predicted = _line_predictions(gram.fit_slots(data.train, TARGET, own, line[1]), own, data.test)
    else:
        parts = []
        for name, places in own.items():
            cut = VectorSlicer(inputCol=prep.FEATURES_COLUMN, outputCol="_cut", indices=places)
            train, test = (
                cut.transform(df.select(prep.FEATURES_COLUMN, TARGET)).select(F.col("_cut").alias(prep.FEATURES_COLUMN), TARGET)
                for df in (data.train, data.test)
            )
            parts.append(learners.predict_long({name: estimator.fit(train)}, test, TARGET, []))
        predicted = reduce(DataFrame.unionAll, parts)
    places = ready.sparkSession.createDataFrame([(n, i, len(c)) for i, (n, c) in enumerate(chosen.items())], "model string, _i int, n_features int")
    return score.reg_metrics_hits(predicted).join(F.broadcast(places), "model").orderBy("_i").select(
        F.col("model").alias("feature_set"), "n_features", "MAE", "RMSE", "R2", "acc_10_min"
    )


def _line_predictions(lines: dict, slots: dict[str, list[int]], test: DataFrame) -> DataFrame:
    """Long predictions of linear functions of some slots, from one scan."""
    x = F.col("_x")
    each = [
        F.struct(
            F.lit(name).alias("model"),
            reduce(operator.add, [F.lit(float(w)) * x[s] for w, s in zip(line[1:], slots[name])], F.lit(float(line[0]))).alias("predicho"),
        )
        for name, line in lines.items()
    ]
    rows = test.select(F.col(TARGET).alias("real"), vector_to_array(prep.FEATURES_COLUMN).alias("_x"))
    return rows.select("real", F.explode(F.array(*each)).alias("_p")).select("_p.model", "real", "_p.predicho")


def hard_errors(
    split: DataFrame, estimators: dict | None = None, huber: dict[str, dict] | None = None,
    baseline: dict = compare.BALANCED_VERSION, residual=None, repeats: int = 10,
) -> dict:
    """Marks of hard segments, robust models, residual correction, segment comparison, importance,
    decision and summary.

    The residuals of the model with the least MAE are corrected by ``residual``, 200 extra
    trees of depth 8 unless another estimator is given.
    """
    train = split.where("split = 'train'")
    cuts = features.fit_cuts(
        train, [*features.LOGISTICS_CUTS, *features.PRECISION_CUTS, *features.ERROR_FOCUSED_CUTS]
    )
    ready = features.add_error_focused_features(
        features.add_precision_features(features.add_logistics_features(split, cuts), cuts), cuts
    )
    ready = written(ready)
    numbers = features.feature_union(
        NUMERIC, features.LOGISTICS_NUMERIC, features.PRECISION_NUMERIC, features.ERROR_FOCUSED
    )
    categories = features.feature_union(
        CATEGORICAL, features.LOGISTICS_CATEGORICAL, features.PRECISION_CATEGORICAL
    )
    tried = estimators or {
        "gradient_boosting_baseline_like": learners.boosted(),
        "extra_trees_error_focused": learners.extra_trees(trees=300, min_leaf=2),
        "random_forest_error_focused": learners.forest(trees=300, min_leaf=2),
        "hist_gradient_boosting_error_focused": learners.boosted_hist(rounds=200, rate=0.05),
    }
    robust = huber if huber is not None else {
        "gradient_boosting_huber": {"rounds": 200, "rate": 0.05, "depth": 3},
        "gradient_boosting_low_lr": {"rounds": 400, "rate": 0.03, "depth": 2},
    }
    data = prepare(ready, numbers, categories)
    models = learners.train_many(data.train, tried | {n: learners.huber(**o) for n, o in robust.items()})
    predicted, metrics = _score(data, models)
    first = metrics.orderBy(
        "MAE", "RMSE", F.desc("R2"), F.desc("acc_10_min"), "p90_absolute_error", "model"
    ).first()["model"]
    corrected = f"{first}_residual_correction"
    residual = residual or learners.extra_trees(trees=200, depth=8, min_leaf=3)
    models[corrected] = learners.correct_residuals(models[first], data.train, residual)
    more, more_metrics = _score(data, {corrected: models[corrected]})
    predicted, metrics = predicted.unionByName(more), metrics.unionByName(more_metrics)
    best_row = compare.rank_balanced(metrics, baseline)
    best = best_row.first()["model"]

    def segments(model: str) -> DataFrame:
        errors = score.error_direction(predicted.where(F.col("model") == model))
        return written(score.segment_metrics(score.error_segments(errors)))

    base_segments, new_segments = segments(next(iter(tried))), segments(best)
    deltas = written(compare.version_deltas(best_row, baseline))
    decision = deltas.where(F.col("version") == "best_error_focused_model").first()["decision"]
    comparison = written(compare.segment_comparison(base_segments, new_segments))
    # Of a corrected model the base is looked at.
    looked_at = learners.full_model(data.encoder, models[first if best == corrected else best])
    importance = search.permutation_importance(
        looked_at, ready.where("split = 'test'"), [*numbers, *categories], repeats=repeats
    )
    return {
        "data": data, "models": models, "metrics": metrics, "best": best, "predictions": predicted,
        "accuracy": score.tolerance_accuracy(predicted), "versions": deltas,
        "segments": new_segments, "segment_comparison": comparison, "importance": written(importance),
        "residual_model": corrected, "best_model": learners.full_model(data.encoder, models[best]), "decision": decision,
        "summary": hard_errors_summary(baseline, metrics.where(F.col("model") == best).first().asDict(), first, corrected, decision, comparison),
    }


def hard_errors_summary(
    baseline: dict, best: dict, base: str, corrected: str, decision: str, segments: DataFrame,
) -> str:
    """A Markdown summary: stored and new model, the corrected one, the decision and the segments."""
    shown = ("MAE", "RMSE", "R2", "acc_10_min", "acc_15_min", "p90_absolute_error")
    lines = ["# Resumen de errores dificiles", "", "| version | modelo | " + " | ".join(shown) + " |", "|---" * (len(shown) + 2) + "|"]
    for version, row in (("actual", baseline), ("nuevo", best)):
        cells = [f"{row[c]:.4f}" if row.get(c) is not None else "" for c in shown]
        lines.append(f"| {version} | {row['model']} | " + " | ".join(cells) + " |")
    lines += ["", f"Correccion de residuos: {corrected}, sobre {base}", "", f"Decision: {decision}", "", "Segmentos comparados:", ""]
    lines.append("| " + " | ".join(segments.columns) + " |")
    lines.append("|---" * len(segments.columns) + "|")
    lines += ["| " + " | ".join(str(v) for v in r) + " |" for r in segments.collect()]  # one row per segment
    return "\n".join(lines)


def classification(
    df: DataFrame, folder: str, spaces: dict[str, dict[str, list]] | None = None, folds: int = 5,
    numbers: list[str] | None = None, categories: list[str] | None = None,
) -> dict:
    """Classes by time, a search per classifier, the best by macro F1 over the folds refitted on all
    training rows, saved, loaded again and scored on the test rows.

    ``numbers`` and ``categories`` restrict the features to some of those that may be used.
    """
    ready = prep.prepare_by_time(df)
    numbers = [c for c in ready.numbers if numbers is None or c in numbers]
    categories = [c for c in ready.categories if categories is None or c in categories]
    train = written(ready.rows.where("split = 'train'"))
    count = prep.effective_folds(train, LABEL, folds)
    made = search.encoded_folds(prep.assign_folds(train, count), numbers, categories, count, [LABEL])
    searches, spaces = {}, spaces or search.CLASS_SPACES
    for name, space in spaces.items():
        points = search.grid_points(space)
        searches[name] = written(search.search(points, search.fit_class_named(name), made, search.f1))
    ranked = written(search.search_many(searches))
    name = ranked.first()["model"]
    best = search.grid_points(spaces[name])[search.best_row(searches[name])["candidate"]]
    encoder = prep.fit_encoder(train, numbers, categories)
    fitted = search.fit_class_named(name)(written(encoder.transform(train).select("features", LABEL)), best)
    path = model_store.save_model(learners.full_model(encoder, fitted), folder, name)
    model = model_store.load_model(df.sparkSession, path)
    predicted = written(
        learners.predict_classes({name: model}, ready.rows.where("split = 'test'"), LABEL, [prep.SPLIT_KEY])
    )
    return {
        "searches": searches, "ranked": ranked, "best": name, "best_params": best, "path": path, "model": model,
        "predictions": predicted, "metrics": score.cls_metrics(predicted), "confusion": score.confusion_matrix(predicted),
        "report": score.cls_report(predicted), "thresholds": ready.thresholds,
    }


def clustering(
    df: DataFrame, k: int = 3, k_min: int = 2, k_max: int = 8, restarts: int = 10, key: str = prep.SPLIT_KEY
) -> dict:
    """Encode, compare numbers of clusters, fit, profile and project."""
    encoder = prep.fit_encoder(df, NUMERIC, CATEGORICAL, impute=False)
    vectors = written(encoder.transform(df.dropna(subset=NUMERIC)))
    model = cluster.fit_kmeans(vectors, k, restarts)
    found = written(model.transform(vectors))
    return {
        "quality": cluster.cluster_quality(vectors, k_min, k_max, restarts),
        "clusters": found,
        "profile": cluster.cluster_profile(found.drop("features", key)),
        "projection": cluster.pca_2d(found).select(key, "cluster", "PC1", "PC2"),
    }


def final_report(metrics: dict[str, float], model: str, compared: bool = False) -> str:
    """A Markdown summary of the final model."""
    lines = [
        "# Resumen final del modelo de regresion",
        "",
        "Objetivo: predecir el tiempo de entrega en minutos.",
        "",
        f"Modelo final: {model}",
        "",
        "| metrica | valor |",
        "|---|---|",
        *[f"| {name} | {value:.6f} |" for name, value in metrics.items()],
        "",
        "MAE es el error absoluto medio en minutos, RMSE pesa mas los errores grandes y",
        "R2 es la parte de la variabilidad explicada.",
    ]
    if compared:
        lines += ["", "El modelo base se comparo con su version optimizada."]
    return "\n".join(lines)
