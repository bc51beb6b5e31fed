"""Registered queries over the star-schema tables: cleaning, profiling, features, labels."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lastmile.functions import text_key
from lastmile.operators import clean, compare, features, labels, prep, profile, score
from lastmile.operators.sizing import written
from lastmile.plans import binding
from lastmile.schema import CATEGORICAL, FEATURES, LABEL, NUMERIC, NUMERIC_AND_TARGET, TARGET, TEXT
from lastmile.sources import tables

DELIVERIES_PER_FILE = 1_000_000

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, as sums differ in the last bits between engines and runs."""
    return df.select(
        *[
            F.round(f.name, digits).alias(f.name)
            if isinstance(f.dataType, T.DoubleType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def raw(spark: SparkSession, sf: str) -> DataFrame:
    return binding.deliveries(spark, sf)


def tidy(spark: SparkSession, sf: str) -> DataFrame:
    """Deliveries with cleaned text and id."""
    return clean.clean_id(clean.clean_text(raw(spark, sf), TEXT))


def patchy(spark: SparkSession, sf: str) -> DataFrame:
    """Cleaned deliveries with missing numbers and targets."""
    return binding.with_nulls(tidy(spark, sf))


# --- flagship -------------------------------------------------------------------


@query
def traffic_profile(spark, sf):
    """Cleaned deliveries by traffic level: size, share, mean time and mean cost per km."""
    ready = features.add_ratios(tidy(spark, sf))
    return rounded(
        ready.groupBy("trafico_nivel").agg(
            F.count("*").alias("n"),
            F.avg(TARGET).alias("tiempo_medio"),
            F.avg("costo_por_km").alias("costo_por_km_medio"),
        )
    )


# --- sources and sinks -----------------------------------------------------------


@query
def scan_csv(spark, sf):
    path = tables.write_table(raw(spark, sf).drop("split_key"), binding.scratch(spark), "csv")
    return clean.parse_numeric(tables.scan_csv(spark, path), NUMERIC_AND_TARGET)


@query
def scan_discover(spark, sf):
    """All delivery rows in files of their own folders, each discovered and read."""
    folder = binding.scratch(spark)
    rows = written(raw(spark, sf))
    files = max(2, -(-rows.count() // DELIVERIES_PER_FILE))
    dealt = rows.withColumn("_file", F.pmod(F.xxhash64("split_key"), F.lit(files))).drop("split_key")
    tables.write_table(dealt.repartition(files, "_file"), folder, "csv", ["_file"])
    if not rows.take(1):  # no deliveries, no files
        return dealt.groupBy("clima").agg(F.count("*").alias("n"))
    found = tables.scan_csv(spark, tables.discover_in_folders(spark, folder, "part-preferred.csv"))
    return found.groupBy("clima").agg(F.count("*").alias("n"))


@query
def sink_csv(spark, sf):
    written = tables.write_table(tidy(spark, sf), binding.scratch(spark), "csv", ["tipo_vehiculo"])
    back = spark.read.option("header", True).csv(written)
    return back.groupBy("tipo_vehiculo", "trafico_nivel").agg(F.count("*").alias("n"))


@query
def sink_json_metrics(spark, sf):
    row = score.reg_metrics(binding.predictions(tidy(spark, sf))).where("model = 'stops'").first()
    path = tables.write_metrics_json(
        spark, {k: row[k] for k in ("MAE", "RMSE", "R2")}, binding.scratch(spark)
    )
    return rounded(spark.read.schema("MAE double, RMSE double, R2 double").json(path))


@query
def sink_best_row(spark, sf):
    best = compare.rank_models(score.reg_metrics(binding.predictions(tidy(spark, sf))))
    return rounded(spark.read.parquet(tables.write_table(best, binding.scratch(spark))))


# --- cleaning --------------------------------------------------------------------


@query
def normalize_columns(spark, sf):
    df = raw(spark, sf)
    odd = [f" {c.replace('_', ' ').title() if i % 2 else c.upper()} " for i, c in enumerate(df.columns)]
    return clean.normalize_columns(df.toDF(*odd))


@query
def require_columns(spark, sf):
    df = raw(spark, sf)
    clean.require_columns(df, FEATURES)
    return df.select(*FEATURES).agg(F.count("*").alias("n"))


@query
def clean_text(spark, sf):
    return clean.clean_text(raw(spark, sf), TEXT).select("split_key", *TEXT)


@query
def clean_id_category(spark, sf):
    return clean.clean_id(raw(spark, sf)).select("split_key", "id_bodega")


@query
def parse_numeric(spark, sf):
    return clean.parse_numeric(binding.as_text(raw(spark, sf)), NUMERIC_AND_TARGET).select(
        "split_key", *NUMERIC_AND_TARGET
    )


@query
def drop_exact_duplicates(spark, sf):
    return clean.drop_exact_duplicates(binding.with_copies(raw(spark, sf)))


@query
def list_duplicates(spark, sf):
    return clean.list_duplicates(binding.with_copies(raw(spark, sf)))


@query
def duplicate_report(spark, sf):
    df = binding.with_copies(raw(spark, sf))
    return clean.duplicate_report(df, clean.drop_exact_duplicates(df))


@query
def duplicate_summary(spark, sf):
    return clean.duplicate_counts(binding.with_copies(raw(spark, sf)))


@query
def drop_null_target(spark, sf):
    return clean.drop_null_target(patchy(spark, sf)).select("split_key", TARGET)


@query
def split_invalid_target(spark, sf):
    kept, removed = clean.split_invalid_target(patchy(spark, sf))
    return kept.select("split_key", TARGET, F.lit("kept").alias("side")).unionAll(
        removed.select("split_key", TARGET, F.lit("removed").alias("side"))
    )


@query
def positive_target_only(spark, sf):
    return clean.positive_target_only(patchy(spark, sf)).select("split_key", TARGET)


@query
def flag_suspicious(spark, sf):
    return clean.flag_suspicious(patchy(spark, sf)).select("split_key", TARGET, "tiempo_sospechoso")


@query
def suspicious_rows(spark, sf):
    return clean.suspicious_rows(patchy(spark, sf)).select(
        "split_key", TARGET, "tiempo_sospechoso", "target_invalido"
    )


@query
def iqr_bounds(spark, sf):
    bounds = clean.fit_iqr_bounds(patchy(spark, sf), NUMERIC_AND_TARGET)
    rows = [(c, low, high) for c, (low, high) in bounds.items()]
    return rounded(
        spark.createDataFrame(rows, "columna string, limite_inferior double, limite_superior double")
    )


@query
def cap_outliers(spark, sf):
    columns = ["costo_por_km", TARGET]
    df = features.add_ratios(patchy(spark, sf))
    return rounded(clean.cap_outliers(df, columns).select("split_key", *columns), 11)


@query
def outlier_rows(spark, sf):
    return clean.outlier_rows(features.add_ratios(patchy(spark, sf)), "costo_por_km").select(
        "split_key", "costo_envio", "distancia_km", "costo_por_km"
    )


@query
def inf_to_null(spark, sf):
    share = F.when(F.col("consumo_nafta") == 0, float("inf")).otherwise(
        F.try_divide("costo_envio", "consumo_nafta")
    )
    return clean.inf_to_null(raw(spark, sf).select("split_key", share.alias("costo_por_consumo")))


@query
def select_xy(spark, sf):
    return clean.select_xy(raw(spark, sf))


def _with_present(listed: DataFrame, df: DataFrame, key: str) -> DataFrame:
    """Add the number of present values of each listed column."""
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns]).unpivot([], df.columns, key, "presentes")
    return listed.join(F.broadcast(counts), key)  # one row per column


@query
def infer_roles(spark, sf):
    df = clean.flag_suspicious(patchy(spark, sf))
    rows = [(role, c) for role, names in clean.infer_roles(df).items() for c in names]
    return _with_present(spark.createDataFrame(rows, "role string, columna string"), df, "columna")


@query
def exclude_columns(spark, sf):
    events = binding.table(spark, sf, "events")
    wide = events.withColumns(
        {"constante": F.lit(1), "duracion": F.col("value"), "clase": F.col("event_type")}
    )
    return spark.createDataFrame(
        clean.exclude_columns(wide, "clase"), "columna string, motivo string"
    )


@query
def clean_regression(spark, sf):
    df = binding.with_copies(binding.as_text(binding.with_nulls(raw(spark, sf))))
    return rounded(clean.clean_regression(df), 11)


@query
def clean_improved(spark, sf):
    df = binding.with_copies(binding.as_text(binding.with_nulls(raw(spark, sf))))
    return rounded(clean.clean_improved(df), 11)


@query
def clean_prepared(spark, sf):
    return rounded(clean.clean_prepared(patchy(spark, sf)), 11)


@query
def clean_eda(spark, sf):
    return clean.clean_eda(binding.with_copies(patchy(spark, sf)))


@query
def clean_eda_counts(spark, sf):
    return clean.clean_eda_counts(binding.with_copies(patchy(spark, sf)))


# --- profiling -------------------------------------------------------------------


@query
def profile_overview(spark, sf):
    return profile.overview(raw(spark, sf).drop("split_key"))


@query
def profile_types(spark, sf):
    df = patchy(spark, sf)
    return _with_present(profile.column_types(df), df, "columna")


@query
def missing_report(spark, sf):
    return profile.missing_report(patchy(spark, sf))


@query
def value_counts(spark, sf):
    return profile.value_counts(tidy(spark, sf), CATEGORICAL)


@query
def numeric_summary(spark, sf):
    return rounded(profile.numeric_summary(patchy(spark, sf), NUMERIC_AND_TARGET))


@query
def target_summary(spark, sf):
    return rounded(profile.target_summary(patchy(spark, sf)))


@query
def outliers_iqr(spark, sf):
    return rounded(profile.outliers_iqr(patchy(spark, sf), NUMERIC_AND_TARGET))


@query
def corr_with_target(spark, sf):
    df = patchy(spark, sf).drop("split_key").withColumn("constante", F.lit(1.0))
    return rounded(profile.corr_with_target(df))


@query
def corr_matrix(spark, sf):
    return rounded(profile.corr_matrix(patchy(spark, sf), NUMERIC_AND_TARGET))


@query
def business_rules(spark, sf):
    return profile.business_rules(patchy(spark, sf))


@query
def scaling_report(spark, sf):
    return rounded(profile.scaling_report(raw(spark, sf), NUMERIC))


@query
def class_distribution(spark, sf):
    return profile.class_distribution(tidy(spark, sf), "tipo_vehiculo")


@query
def histogram_bins(spark, sf):
    return profile.histogram_bins(patchy(spark, sf), ["distancia_km", "costo_envio", TARGET])


@query
def box_stats(spark, sf):
    return rounded(profile.box_stats(patchy(spark, sf), TARGET, "trafico_nivel"))


@query
def box_stats_column(spark, sf):
    return rounded(profile.box_stats(features.add_ratios(patchy(spark, sf)), "costo_por_km"))


@query
def scatter_points(spark, sf):
    return profile.scatter_points(patchy(spark, sf), "distancia_km")


@query
def eda_bundle(spark, sf):
    """Row counts of the ten exploratory tables."""
    reports = profile.eda_reports(patchy(spark, sf).drop("split_key"))
    counted = [
        df.agg(F.lit(name).alias("tabla"), F.count("*").alias("filas")) for name, df in reports.items()
    ]
    return compare.union_tables(*counted)


@query
def eda_bundle_cells(spark, sf):
    """All cells of the ten exploratory tables in long form, by each row's first column."""
    reports = profile.eda_reports(patchy(spark, sf).drop("split_key"))
    cells = []
    for name, df in reports.items():
        each = F.array(*[F.struct(F.lit(c).alias("columna"), F.col(c).cast("string").alias("valor")) for c in df.columns])
        cells.append(
            df.select(F.lit(name).alias("tabla"), F.col(df.columns[0]).cast("string").alias("fila"), F.explode(each).alias("_c"))
            .select("tabla", "fila", "_c.*")
        )
    return compare.union_tables(*cells)


# --- features --------------------------------------------------------------------


@query
def feat_cyclic_hour(spark, sf):
    return rounded(
        features.add_cyclic_hour(patchy(spark, sf)).select("split_key", "hora_sin", "hora_cos")
    )


@query
def feat_ratios_km(spark, sf):
    return features.add_ratios(patchy(spark, sf)).select("split_key", *features.RATIOS)


@query
def feat_logistics(spark, sf):
    return features.add_logistics_features(patchy(spark, sf)).select(
        "split_key", *features.LOGISTICS_NUMERIC, *features.LOGISTICS_CATEGORICAL
    )


@query
def feat_precision(spark, sf):
    return rounded(
        features.add_precision_features(patchy(spark, sf)).select(
            "split_key", *features.PRECISION_NUMERIC, *features.PRECISION_CATEGORICAL
        ),
        11,
    )


@query
def feat_error_focused(spark, sf):
    return features.add_error_focused_features(patchy(spark, sf)).select(
        "split_key", *features.ERROR_FOCUSED
    )


@query
def feat_improved(spark, sf):
    return rounded(
        features.add_improved_features(patchy(spark, sf)).select(
            "split_key", *features.IMPROVED_NUMERIC, *features.IMPROVED_CATEGORICAL
        ),
        11,
    )


@query
def feat_exploratory(spark, sf):
    return rounded(features.add_exploratory_features(raw(spark, sf)), 11)


@query
def feature_lists(spark, sf):
    """Which of the known features the table has once all feature sets are added."""
    df = features.add_error_focused_features(
        features.add_precision_features(features.add_logistics_features(tidy(spark, sf)))
    )
    wanted = features.feature_union(
        NUMERIC, features.LOGISTICS_NUMERIC, features.PRECISION_NUMERIC, features.ERROR_FOCUSED,
        CATEGORICAL, features.LOGISTICS_CATEGORICAL, features.PRECISION_CATEGORICAL,
    )
    rows = [(i, c, dict(df.dtypes)[c]) for i, c in enumerate(features.present(df, wanted))]
    return _with_present(
        spark.createDataFrame(rows, "posicion int, feature string, tipo string"),
        df.select(*[c for _, c, _ in rows]),
        "feature",
    )


@query
def feature_catalog(spark, sf):
    """The recommendations with the number of present values of each feature."""
    df = features.add_exploratory_features(tidy(spark, sf))
    names = [name for name, _, _ in features.CATALOG]
    counts = df.select(*names).agg(*[F.count(c).alias(c) for c in names]).unpivot(
        [], names, "feature", "presentes"
    )
    return features.feature_catalog(spark).join(F.broadcast(counts), "feature")


@query
def text_normalize(spark, sf):
    docs = binding.table(spark, sf, "documents")
    return docs.select("doc_id", text_key(F.concat("text", F.lit(" Crítico Ñandú\t"), "source")).alias("clave"))


# --- labels, ranks, groups, joins ---------------------------------------------------


@query
def tercile_thresholds(spark, sf):
    train = patchy(spark, sf).where("split_key % 10 >= 2")
    found = labels.fit_terciles(train)
    return rounded(spark.createDataFrame([(found["q33"], found["q66"])], "q33 double, q66 double"))


@query
def tercile_label(spark, sf):
    df = patchy(spark, sf)
    found = labels.fit_terciles(df.where("split_key % 10 >= 2"))
    return labels.apply_terciles(df, found).select("split_key", TARGET, LABEL)


@query
def tercile_global(spark, sf):
    labelled, _ = labels.label_by_time(patchy(spark, sf))
    return profile.class_distribution(labelled, LABEL)


@query
def rank_percent(spark, sf):
    ranked = labels.rank_percent(
        patchy(spark, sf),
        {"costo_envio": "costo_rank", "experiencia_chofer_anios": "experiencia_rank"},
        frozenset({"experiencia_chofer_anios"}),
    )
    return rounded(ranked.select("split_key", "costo_rank", "experiencia_rank"), 9)


@query
def risk_score(spark, sf):
    scored, _ = labels.label_by_risk(binding.with_null_features(raw(spark, sf)).drop(TARGET))
    return scored.select("split_key", "riesgo_logistico", LABEL)


@query
def alias_resolve(spark, sf):
    df = raw(spark, sf).withColumnRenamed(TARGET, "delivery_time")
    found = labels.resolve(df, clean.TIME_NAMES)
    return rounded(df.agg(F.lit(found).alias("columna"), F.avg(found).alias("media")))


@query
def group_mean_encode(spark, sf):
    df = patchy(spark, sf)
    encoder = prep.GroupMeans().fit(df.where("split_key % 10 >= 2"))
    return rounded(encoder.transform(df).select("split_key", *features.HISTORY_NUMERIC))


@query
def group_mean_out_of_fold(spark, sf):
    df = prep.assign_folds(patchy(spark, sf))
    return rounded(
        prep.out_of_fold_means(df, "trafico_nivel").select(
            "split_key", "fold", "hist_mean_target_by_trafico_nivel"
        )
    )


@query
def join_metrics(spark, sf):
    predicted = binding.predictions(tidy(spark, sf))
    known = predicted.where("model <> 'constant'")
    return rounded(
        compare.join_metrics(score.reg_metrics(predicted), score.tolerance_accuracy(known))
    )


@query
def pivot_tolerance(spark, sf):
    return rounded(
        score.pivot_tolerance(score.tolerance_accuracy(binding.predictions(tidy(spark, sf))))
    )


@query
def union_tables(spark, sf):
    predicted = binding.predictions(tidy(spark, sf))
    hits = score.tolerance_accuracy(predicted, [10]).select("model", "accuracy_percent")
    return rounded(compare.union_tables(score.reg_metrics(predicted), hits))


@query
def dedupe_by_key(spark, sf):
    predicted = binding.predictions(tidy(spark, sf))
    metrics = score.reg_metrics(predicted)
    twice = compare.union_tables(metrics, metrics.withColumn("MAE", F.col("MAE") + 1))
    return rounded(compare.dedupe_by_key(twice, "model", [F.asc("MAE")]))


def _segments(spark, sf, model="stops"):
    predicted = binding.predictions(tidy(spark, sf)).where(F.col("model") == model)
    marked = score.error_segments(score.error_direction(predicted))
    return score.segment_metrics(marked)


@query
def top_n(spark, sf):
    return rounded(compare.top_n(_segments(spark, sf), 5, "MAE", ["segment_column", "segment_value"]))


@query
def problem_segments(spark, sf):
    return rounded(score.problem_segments(_segments(spark, sf), 300, 8))


@query
def rank_models(spark, sf):
    return rounded(compare.rank_models(score.reg_metrics(binding.predictions(tidy(spark, sf)))))


@query
def rank_models_operational(spark, sf):
    predicted = binding.predictions(tidy(spark, sf))
    return rounded(
        compare.rank_operational(score.reg_metrics(predicted), score.tolerance_accuracy(predicted))
    )


@query
def rank_models_precision(spark, sf):
    predicted = binding.predictions(tidy(spark, sf))
    return rounded(
        compare.rank_precision(
            compare.join_metrics(score.reg_metrics(predicted), score.tolerance_accuracy(predicted))
        )
    )


@query
def rank_models_balanced(spark, sf):
    predicted = binding.predictions(tidy(spark, sf))
    return rounded(compare.rank_balanced(score.reg_metrics_full(predicted)))


# --- splitting and preprocessing -----------------------------------------------------


@query
def split_random(spark, sf):
    return prep.split_random(raw(spark, sf)).groupBy("split", "clima").agg(F.count("*").alias("n"))


@query
def split_stratified(spark, sf):
    events = binding.table(spark, sf, "events").select("event_id", "event_type", "value")
    return prep.split_stratified(events, "event_type", "event_id").select("event_id", "event_type", "split")


@query
def split_then_label(spark, sf):
    split = prep.prepare_by_time(patchy(spark, sf))
    return split.rows.groupBy("split", LABEL).agg(F.count("*").alias("n"))


@query
def prepare_classification(spark, sf):
    labelled, _ = labels.label_by_time(tidy(spark, sf))
    ready = prep.prepare_by_label(labelled)
    return ready.rows.groupBy("split", LABEL).agg(F.count("*").alias("n"))


@query
def kfold_assign(spark, sf):
    labelled, _ = labels.label_by_time(tidy(spark, sf))
    folds = prep.effective_folds(labelled, LABEL, 5)
    return prep.assign_folds(labelled, folds).groupBy("fold", LABEL).agg(F.count("*").alias("n"))


@query
def impute(spark, sf):
    df = patchy(spark, sf)
    fitted = prep.fit_impute(df.where("split_key % 10 >= 2"), NUMERIC, CATEGORICAL)
    return prep.apply_impute(df, fitted).select("split_key", *NUMERIC, *CATEGORICAL)


@query
def scale_standard(spark, sf):
    df = tidy(spark, sf).withColumn("constante", F.lit(3.0))
    columns = [*NUMERIC, "constante"]
    fitted = prep.fit_scale(df.where("split_key % 10 >= 2"), columns)
    return rounded(prep.apply_scale(df, fitted).select("split_key", *columns))


@query
def one_hot(spark, sf):
    df = tidy(spark, sf)
    fitted = prep.fit_one_hot(df.where("trafico_nivel <> 'critico'"), ["trafico_nivel", "clima"])
    hot = prep.apply_one_hot(df, fitted)
    return hot.select("split_key", *[c for c in hot.columns if c not in df.columns])


# --- scoring -----------------------------------------------------------------------


@query
def reg_metrics(spark, sf):
    return rounded(score.reg_metrics(binding.predictions(tidy(spark, sf))))


@query
def reg_metrics_full(spark, sf):
    return rounded(score.reg_metrics_full(binding.predictions(tidy(spark, sf))))


@query
def tolerance_accuracy(spark, sf):
    return rounded(score.tolerance_accuracy(binding.predictions(tidy(spark, sf))))


@query
def tolerance_hits(spark, sf):
    predicted = binding.predictions(tidy(spark, sf)).where("model = 'distance'")
    return score.tolerance_hits(predicted)


@query
def tolerance_scorer(spark, sf):
    predicted = binding.predictions(tidy(spark, sf)).where("model = 'distance'")
    value = score.ToleranceEvaluator("real", "predicho").evaluate(predicted)
    return rounded(spark.createDataFrame([(value,)], "acierto double"))


@query
def prediction_errors(spark, sf):
    return score.prediction_errors(binding.predictions(tidy(spark, sf))).select(
        "split_key", "model", "real", "predicho", "error", "error_absoluto"
    )


@query
def error_direction(spark, sf):
    return score.error_direction(binding.predictions(tidy(spark, sf))).select(
        "split_key", "model", "es_sobreestimacion", "es_subestimacion", "direccion_error"
    )


@query
def error_segments(spark, sf):
    predicted = binding.predictions(tidy(spark, sf)).where("model = 'stops'")
    return score.error_segments(predicted).select(
        "split_key", "hora_punta", "distancia_larga", "carga_pesada", "muchas_paradas"
    )


@query
def segment_metrics(spark, sf):
    return rounded(_segments(spark, sf))


@query
def segment_comparison(spark, sf):
    return rounded(
        compare.segment_comparison(_segments(spark, sf, "distance"), _segments(spark, sf, "stops"))
    )


@query
def segment_labels(spark, sf):
    return rounded(
        score.segment_labels(_segments(spark, sf), 10).select("segment_label", "n", "MAE")
    )


@query
def compare_versions(spark, sf):
    metrics = score.reg_metrics(binding.predictions(tidy(spark, sf)))
    return rounded(
        compare.compare_versions(metrics, metrics.where("model = 'stops'"), "distance")
    )


@query
def current_vs_improved(spark, sf):
    predicted = binding.predictions(tidy(spark, sf)).where("model = 'stops'")
    return rounded(
        compare.current_vs_improved(score.reg_metrics(predicted), score.tolerance_accuracy(predicted))
    )


@query
def version_deltas(spark, sf):
    predicted = binding.predictions(tidy(spark, sf)).where("model = 'stops'")
    return rounded(compare.version_deltas(score.reg_metrics_full(predicted)))


@query
def tolerance_versions(spark, sf):
    predicted = binding.predictions(tidy(spark, sf)).where("model = 'stops'")
    return rounded(compare.tolerance_comparison(score.tolerance_accuracy(predicted)))


@query
def decision_notes(spark, sf):
    """Notes and conclusion for every model against the stored versions."""
    versions = score.reg_metrics_full(binding.predictions(tidy(spark, sf))).withColumn(
        "version", F.when(F.col("model") == "constant", "baseline").otherwise("precision_experiment")
    )
    stored, operational = compare.OPTIMIZED_VERSION, compare.OPERATIONAL_VERSION
    return compare.decision_notes(versions, stored, operational).select(
        "model", "decision_notes",
        compare.precision_conclusion(stored, operational).alias("conclusion"),
        compare.operational_conclusion(stored).alias("conclusion_operacional"),
    )


@query
def choose_final(spark, sf):
    metrics = score.reg_metrics_full(binding.predictions(tidy(spark, sf)))
    base, tuned = metrics.where("model = 'distance'"), metrics.where("model = 'stops'")
    return rounded(
        compare.choose_final(base, tuned).select("version", "model", "RMSE").unionByName(
            compare.choose_final(tuned, base, operational_first=True).select("version", "model", "RMSE")
        )
    )


def _classified(spark, sf):
    return binding.class_predictions(labels.label_by_time(tidy(spark, sf))[0])


@query
def cls_metrics(spark, sf):
    return rounded(score.cls_metrics(_classified(spark, sf)))


@query
def confusion_matrix(spark, sf):
    return score.confusion_matrix(_classified(spark, sf).where("model = 'by_distance'"))


@query
def cls_report(spark, sf):
    return rounded(score.cls_report(_classified(spark, sf).where("model = 'by_distance'")))


@query
def rank_classifiers(spark, sf):
    return rounded(compare.rank_by(score.cls_metrics(_classified(spark, sf)), "f1_macro"))
