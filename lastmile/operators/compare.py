"""Tables of models: joining scores, ranking, choosing, version deltas and notes.

The inputs hold one row per model or version. Rankings use sort + limit or
aggregates, never an unpartitioned window.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lastmile.operators.score import pivot_tolerance

# Published scores of earlier model versions.
OPTIMIZED_VERSION = {
    "version": "current_optimized", "MAE": 11.59, "RMSE": 14.58, "R2": 0.0290,
    "acc_5_min": 28.33, "acc_10_min": 49.58, "acc_15_min": 70.00,
}
OPERATIONAL_VERSION = {
    "version": "current_operational", "MAE": 11.5062, "RMSE": 14.7391, "R2": 0.0082,
    "acc_5_min": 29.17, "acc_10_min": 55.00, "acc_15_min": 70.42,
}
BALANCED_VERSION = {
    "version": "current_balanced_model", "model": "GradientBoostingRegressor",
    "MAE": 11.4711, "RMSE": 14.5709, "R2": 0.0307,
    "acc_5_min": 29.17, "acc_10_min": 52.50, "acc_15_min": 70.42,
}


def join_metrics(technical: DataFrame, operational: DataFrame) -> DataFrame:
    """Technical scores with the hit rates of the same model, null where there are none."""
    return technical.join(pivot_tolerance(operational), "model", "left")


def union_tables(*tables: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def dedupe_by_key(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """The first row per key in an explicit order."""
    fields = F.struct(*df.columns)
    one = Window.partitionBy(key).orderBy(*order)
    return (
        df.select(fields.alias("_row"), *df.columns)
        .withColumn("_n", F.row_number().over(one))
        .where("_n = 1")
        .select("_row.*")
    )


def top_n(df: DataFrame, n: int, by: str, tie: list[str]) -> DataFrame:
    return df.orderBy(F.desc(by), *tie).limit(n)


def _best(df: DataFrame, *order: Column) -> DataFrame:
    return df.orderBy(*order).limit(1)


def rank_models(metrics: DataFrame) -> DataFrame:
    """Best row by RMSE, then MAE, then R2."""
    return _best(metrics, F.asc("RMSE"), F.asc("MAE"), F.desc("R2"), F.asc("model"))


def rank_by(metrics: DataFrame, metric: str = "f1_macro") -> DataFrame:
    """Best row by one score, larger is better."""
    return _best(metrics, F.desc_nulls_last(metric), F.asc("model"))


def rank_operational(technical: DataFrame, operational: DataFrame) -> DataFrame:
    """Best row by the 10 minute hit rate, then RMSE, MAE, R2."""
    ten = operational.where("tolerance_minutes = 10").select(
        "model", F.col("accuracy_percent").alias("acc_10_min")
    )
    return _best(
        technical.join(ten, "model", "left"),
        F.desc_nulls_last("acc_10_min"), F.asc("RMSE"), F.asc("MAE"), F.desc("R2"), F.asc("model"),
    )


def rank_precision(combined: DataFrame) -> DataFrame:
    return _best(
        combined,
        F.asc("MAE"), F.asc("RMSE"), F.desc("R2"),
        F.desc_nulls_last("acc_10_min"), F.desc_nulls_last("acc_15_min"), F.asc("model"),
    )


def rank_balanced(metrics: DataFrame, baseline: dict = BALANCED_VERSION) -> DataFrame:
    """Best row among models near the baseline's hit rate or clearly more exact; else among all."""
    near = F.col("acc_10_min") >= baseline["acc_10_min"] - 2.0
    exact = (F.col("MAE") <= baseline["MAE"] - 0.2) & (F.col("RMSE") <= baseline["RMSE"] - 0.2)
    return _best(
        # An eligible row sorts before every other row, which also gives the fallback.
        metrics.withColumn("_eligible", F.coalesce(near | exact, F.lit(False))),
        F.desc("_eligible"), F.asc("MAE"), F.asc("RMSE"), F.desc("R2"),
        F.desc("acc_10_min"), F.asc("p90_absolute_error"), F.asc("model"),
    ).drop("_eligible")


def compare_versions(
    base: DataFrame, tuned: DataFrame, model: str, names: tuple[str, str] = ("base", "tuned")
) -> DataFrame:
    """The base model's row and the tuned rows, marked by version."""
    row = base.where(F.col("model") == model)
    if not row.take(1):
        raise ValueError(f"base model not found: {model}")
    columns = ["model", "MAE", "RMSE", "R2"]
    return (
        row.select(F.lit(names[0]).alias("version"), *columns)
        .unionByName(tuned.select(F.lit(names[1]).alias("version"), *columns))
    )


def version_row(df: DataFrame, values: dict) -> DataFrame:
    """One literal row of version scores."""
    return df.sparkSession.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])


def current_vs_improved(
    metrics: DataFrame, operational: DataFrame, baseline: dict = OPTIMIZED_VERSION
) -> DataFrame:
    """The stored version and the improved model side by side."""
    scores = ["MAE", "RMSE", "R2", "acc_5_min", "acc_10_min", "acc_15_min"]
    new = join_metrics(metrics, operational).select(
        F.lit("improved_experiment").alias("version"), *scores
    )
    return version_row(metrics, baseline).select("version", *scores).unionByName(new)


def version_deltas(new: DataFrame, baseline: dict = BALANCED_VERSION) -> DataFrame:
    """Baseline and new row with deltas and a three-way decision."""
    scores = ["MAE", "RMSE", "R2", "acc_5_min", "acc_10_min", "acc_15_min", "p90_absolute_error"]
    base = version_row(new, baseline).withColumn("p90_absolute_error", F.lit(None).cast("double"))
    both = base.select("version", "model", *scores).unionByName(
        new.select(F.lit("best_error_focused_model").alias("version"), "model", *scores)
    )
    mae, rmse, r2, hits = (F.col(c) for c in ("MAE", "RMSE", "R2", "acc_10_min"))
    b = baseline
    better = (mae < b["MAE"]) & (rmse < b["RMSE"]) & (r2 >= b["R2"]) & (hits >= b["acc_10_min"] - 1)
    useful = (mae <= b["MAE"]) & (rmse <= b["RMSE"]) & (hits >= b["acc_10_min"] - 2)
    return both.withColumns(
        {
            **{f"delta_{c}": F.col(c) - b[c] for c in ("MAE", "RMSE", "R2", "acc_10_min")},
            "decision": F.when(F.col("version") == b["version"], "baseline")
            .when(better, "usar modelo nuevo")
            .when(useful, "modelo nuevo util para analisis, evaluar antes de reemplazar")
            .otherwise("mantener modelo actual"),
        }
    )


def tolerance_versions(comparison: DataFrame) -> DataFrame:
    """Wide hit rates of versions to (version, tolerance_minutes, accuracy_percent)."""
    columns = ["acc_5_min", "acc_10_min", "acc_15_min"]
    return comparison.select("version", *columns).unpivot(
        ["version"], columns, "_name", "accuracy_percent"
    ).select(
        "version",
        F.regexp_extract("_name", r"([0-9]+)", 1).cast("int").alias("tolerance_minutes"),
        "accuracy_percent",
    )


def tolerance_comparison(accuracy: DataFrame, baseline: dict = OPTIMIZED_VERSION) -> DataFrame:
    """Hit rates of the stored version stacked on those of a new model."""
    stored = tolerance_versions(
        version_row(accuracy, baseline)
    ).withColumnRenamed("version", "model")
    return stored.unionByName(accuracy.select("model", "tolerance_minutes", "accuracy_percent"))


# Segments compared between model versions.
TARGET_SEGMENTS = [
    ("tipo_vehiculo", "camion"),
    ("trafico_nivel", "alto"),
    ("trafico_nivel", "bajo"),
    ("id_bodega", "1"),
    ("id_bodega", "4"),
    ("distancia_larga", "1"),
    ("carga_pesada", "1"),
    ("muchas_paradas", "1"),
]


def segment_comparison(
    base: DataFrame, new: DataFrame, segments: list[tuple[str, str]] | None = None
) -> DataFrame:
    """MAE of the listed segments before and after; whole numbers match whatever their text."""
    keys = ["segment_column", "segment_value"]
    wanted = F.broadcast(  # the listed segments
        base.sparkSession.createDataFrame(
            [(c, str(v)) for c, v in (segments or TARGET_SEGMENTS)],
            "segment_column string, segment_value string",
        )
    )

    def side(df: DataFrame, suffix: str) -> DataFrame:
        return df.select(
            "segment_column", F.regexp_replace("segment_value", r"\.0+$", "").alias("segment_value"),
            F.col("n").alias(f"n_{suffix}"), F.col("MAE").alias(f"{suffix}_MAE"),
        )

    delta = F.col("new_MAE") - F.col("baseline_MAE")
    return (
        wanted.join(side(base, "baseline"), keys, "left")
        .join(side(new, "new"), keys, "left")
        .select(
            *keys, F.coalesce("n_new", "n_baseline").alias("n"), "baseline_MAE", "new_MAE",
            delta.alias("delta_MAE"), F.coalesce(delta < 0, F.lit(False)).alias("improved"),
        )
    )


# --- decisions in words ----------------------------------------------------------


def decision_notes(
    versions: DataFrame, technical: dict, operational: dict, judged: str = "precision_experiment"
) -> DataFrame:
    """Notes for the judged version, 'baseline' for the others."""
    def note(ok: Column, yes: str, no: str) -> Column:
        return F.when(ok, yes).otherwise(no)

    notes = F.concat_ws(
        " | ",
        note(F.col("MAE") < technical["MAE"], "MAE mejor que tecnico", "MAE no mejora tecnico"),
        note(F.col("RMSE") < technical["RMSE"], "RMSE mejor que tecnico", "RMSE no mejora tecnico"),
        note(F.col("R2") > technical["R2"], "R2 mejor que tecnico", "R2 no mejora tecnico"),
        note(
            F.col("acc_10_min") >= operational["acc_10_min"],
            "mantiene/mejora acc_10 operacional", "pierde acc_10 operacional",
        ),
    )
    return versions.withColumn(
        "decision_notes", F.when(F.col("version") == judged, notes).otherwise("baseline")
    )


def precision_conclusion(technical: dict, operational: dict) -> Column:
    mae, rmse = F.col("MAE") < technical["MAE"], F.col("RMSE") < technical["RMSE"]
    hits = F.col("acc_10_min") >= operational["acc_10_min"]
    return (
        F.when(
            mae & rmse & (F.col("R2") > technical["R2"]),
            "Mejoro la estimacion exacta del tiempo de entrega.",
        )
        .when((mae | rmse) & ~hits, "Mejoro tecnicamente pero perdio acierto operacional.")
        .when(
            mae | rmse, "Mejoro tecnicamente y mantuvo/mejoro acierto operacional relevante."
        )
        .when(hits, "Mejoro operacionalmente pero no tecnicamente.")
        .otherwise("Empeoro respecto a modelos anteriores para precision y operacion.")
    )


def operational_conclusion(baseline: dict = OPTIMIZED_VERSION) -> Column:
    return (
        F.when(
            F.col("acc_10_min") > baseline["acc_10_min"],
            "El modelo mejoro operacionalmente porque aumento el acierto dentro de +/-10 minutos.",
        )
        .when(
            F.col("RMSE") < baseline["RMSE"],
            "El modelo mejoro tecnicamente, pero no mejoro el criterio operacional principal.",
        )
        .otherwise(
            "Las mejoras probadas no superaron el modelo actual. Se recomienda mantener el modelo anterior."
        )
    )


def choose_final(
    base: DataFrame, tuned: DataFrame, operational_first: bool = False, names: tuple[str, str] = ("base", "tuned")
) -> DataFrame:
    """The better of two rows in lexicographic order; the base row wins a full tie."""
    columns = [c for c in base.columns if c in tuned.columns]
    both = base.select(*columns, F.lit(0).alias("_side")).unionByName(
        tuned.select(*columns, F.lit(1).alias("_side"))
    )
    order = [F.asc("RMSE"), F.asc("MAE"), F.desc("R2"), F.asc("_side")]
    if operational_first:
        order.insert(0, F.desc_nulls_last("acc_10_min"))
    return _best(both, *order).select(
        *columns, F.when(F.col("_side") == 0, names[0]).otherwise(names[1]).alias("version")
    )
