"""Scores of predictions. Predictions are kept long: model, real, predicho, row columns."""

from __future__ import annotations

from pyspark.ml.evaluation import Evaluator
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasLabelCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lastmile.functions import flag, numeric, peak_hour
from lastmile.operators.features import Cuts, fit_cuts
from lastmile.operators.quantiles import grouped_quantiles
from lastmile.operators.sizing import small_side

TOLERANCES = [5, 10, 15, 20]


def prediction_errors(df: DataFrame) -> DataFrame:
    error = F.col("real") - F.col("predicho")
    return df.withColumns({"error": error, "error_absoluto": F.abs(error)})


def error_direction(df: DataFrame) -> DataFrame:
    out = df if "error" in df.columns else prediction_errors(df)
    return out.withColumns(
        {
            "es_sobreestimacion": flag(F.col("predicho") > F.col("real")),
            "es_subestimacion": flag(F.col("predicho") < F.col("real")),
            "direccion_error": F.when(F.col("error") > 0, "subestimacion")
            .when(F.col("error") < 0, "sobreestimacion")
            .otherwise("sin_error"),
        }
    )


def _error() -> Column:
    return F.col("real") - F.col("predicho")


def _r2() -> Column:
    """1 - SSE/SST; a constant target gives 1 for perfect and 0 for other predictions."""
    sse = F.sum(_error() * _error())
    sst = F.var_pop("real") * F.count("real")
    flat = F.when(sse == 0, F.lit(1.0)).otherwise(F.lit(0.0))
    return F.when(sst == 0, flat).otherwise(1 - F.try_divide(sse, sst))


def _basic() -> list[Column]:
    return [
        F.avg(F.abs(_error())).alias("MAE"),
        F.sqrt(F.avg(_error() * _error())).alias("RMSE"),
        _r2().alias("R2"),
    ]


def _hit_share(tolerance: int) -> Column:
    return F.avg((F.abs(_error()) <= tolerance).cast("double"))


def reg_metrics(predictions: DataFrame, by: list[str] | None = None) -> DataFrame:
    """MAE, RMSE and R2 per model."""
    return predictions.groupBy(*(by or ["model"])).agg(*_basic())


def reg_metrics_hits(predictions: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Basic scores, mean error and hit rates in percent, from one aggregation."""
    return predictions.groupBy(*(by or ["model"])).agg(
        *_basic(),
        F.avg(_error()).alias("mean_error"),
        *[(_hit_share(t) * 100).alias(f"acc_{t}_min") for t in TOLERANCES],
    )


def reg_metrics_full(
    predictions: DataFrame, by: list[str] | None = None, rows: int | None = None
) -> DataFrame:
    """Basic scores, mean error, median and p90 of the absolute error, hit rates in percent."""
    keys = by or ["model"]
    base = reg_metrics_hits(predictions, keys)
    sized = predictions.select(*keys, F.abs(_error()).alias("_abs"))
    q = grouped_quantiles(sized, keys, "_abs", [0.5, 0.9], rows).select(
        *keys,
        F.col("q")[0].alias("median_absolute_error"), F.col("q")[1].alias("p90_absolute_error"),
    )
    return base.join(q, keys)


def tolerance_accuracy(
    predictions: DataFrame, tolerances: list[int] | None = None, by: list[str] | None = None
) -> DataFrame:
    """Long table (model, tolerance) from one aggregation; rows are not multiplied."""
    tolerances = tolerances or TOLERANCES
    keys = by or ["model"]
    wide = predictions.groupBy(*keys).agg(
        F.count("*").alias("total_count"),
        *[F.count_if(F.abs(_error()) <= t).alias(f"h{t}") for t in tolerances],
    )
    hits = F.array(
        *[F.struct(F.lit(t).alias("t"), F.col(f"h{t}").alias("h")) for t in tolerances]
    )
    share = F.try_divide(F.col("hit_count").cast("double"), F.col("total_count"))
    return (
        wide.select(*keys, "total_count", F.explode(hits).alias("x"))
        .select(
            *keys, F.col("x.t").alias("tolerance_minutes"), F.col("x.h").alias("hit_count"),
            "total_count",
        )
        .withColumns({"accuracy": share, "accuracy_percent": share * 100})
    )


def tolerance_hits(predictions: DataFrame, tolerances: list[int] | None = None) -> DataFrame:
    """Hits, total and rounded percent over all rows; an empty table gives zeros."""
    tolerances = tolerances or [5, 10, 15]
    wide = predictions.agg(
        F.count("*").alias("total_count"),
        *[F.count_if(F.abs(_error()) <= t).alias(f"h{t}") for t in tolerances],
    )
    hits = F.array(
        *[F.struct(F.lit(t).alias("t"), F.col(f"h{t}").alias("h")) for t in tolerances]
    )
    percent = F.round(
        F.coalesce(F.try_divide(F.col("x.h").cast("double"), F.col("total_count")), F.lit(0.0)) * 100, 4
    )
    return wide.select("total_count", F.explode(hits).alias("x")).select(
        F.col("x.t").alias("tolerance_minutes"), F.col("x.h").alias("hit_count"), "total_count",
        percent.alias("accuracy_percent"),
    )


def pivot_tolerance(accuracy: DataFrame) -> DataFrame:
    """Long hit rates to one row per model with acc_5_min ... acc_20_min."""
    wide = accuracy.groupBy("model").pivot("tolerance_minutes", TOLERANCES).agg(
        F.avg("accuracy_percent")
    )
    return wide.select("model", *[F.col(str(t)).alias(f"acc_{t}_min") for t in TOLERANCES])


class ToleranceEvaluator(
    Evaluator, HasLabelCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable
):
    """Share of predictions within the tolerance, as a search objective."""

    minutes = Param(Params._dummy(), "minutes", "tolerated absolute error", TypeConverters.toFloat)

    def __init__(self, labelCol: str = "label", predictionCol: str = "prediction", minutes: float = 10):
        super().__init__()
        self._set(labelCol=labelCol, predictionCol=predictionCol, minutes=minutes)

    def _evaluate(self, dataset: DataFrame) -> float:
        error = F.abs(F.col(self.getLabelCol()) - F.col(self.getPredictionCol()))
        return dataset.agg(F.avg((error <= self.getOrDefault(self.minutes)).cast("double"))).first()[0] or 0.0

    def isLargerBetter(self) -> bool:
        return True


# --- segments ------------------------------------------------------------------

SEGMENT_CUTS = [("distancia_km", 0.75), ("peso_carga_kg", 0.75), ("paradas_previas", 0.75)]
SEGMENT_COLUMNS = [
    "trafico_nivel", "clima", "tipo_vehiculo", "id_bodega",
    "hora_punta", "distancia_larga", "carga_pesada", "muchas_paradas",
]
SEGMENT_MARKS = {
    "distancia_larga": "distancia_km", "carga_pesada": "peso_carga_kg", "muchas_paradas": "paradas_previas",
}


def error_segments(df: DataFrame, cuts: Cuts | None = None) -> DataFrame:
    """Segment marks; cut-offs are the 75 % points of the scored rows unless given."""
    cuts = fit_cuts(df, SEGMENT_CUTS) if cuts is None else cuts
    new: dict[str, Column] = {}
    if "hora_despacho" in df.columns:
        new["hora_punta"] = flag(peak_hour(numeric(df, "hora_despacho")))
    for name, source in SEGMENT_MARKS.items():
        if source in df.columns:
            cut = cuts.get((source, 0.75))
            new[name] = flag(numeric(df, source) >= cut) if cut is not None else F.lit(0)
    return df.withColumns(new) if new else df


SEGMENT_SCHEMA = (
    "segment_column string, segment_value string, n bigint, MAE double, RMSE double, "
    "mean_error double, median_error double, median_absolute_error double, max_error double, "
    "overestimation_rate double, underestimation_rate double"
)


def segment_metrics(
    errors: DataFrame, columns: list[str] | None = None, rows: int | None = None
) -> DataFrame:
    """Error scores per segment column and value; all columns in one unpivot and shuffle.

    The input comes from ``error_direction``; a null segment value is its own segment.
    """
    present = [c for c in (columns or SEGMENT_COLUMNS) if c in errors.columns]
    if not present:
        return errors.sparkSession.createDataFrame([], SEGMENT_SCHEMA)
    keys = ["segment_column", "segment_value"]
    long = errors.select(
        "error", "error_absoluto", "es_sobreestimacion", "es_subestimacion",
        *[F.col(c).cast("string").alias(c) for c in present],
    ).unpivot(
        ["error", "error_absoluto", "es_sobreestimacion", "es_subestimacion"], present, *keys
    )
    base = long.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.avg("error_absoluto").alias("MAE"),
        F.sqrt(F.avg(F.col("error") * F.col("error"))).alias("RMSE"),
        F.avg("error").alias("mean_error"),
        F.max("error_absoluto").alias("max_error"),
        (F.avg("es_sobreestimacion") * 100).alias("overestimation_rate"),
        (F.avg("es_subestimacion") * 100).alias("underestimation_rate"),
    )
    measures = {"median_error": "error", "median_absolute_error": "error_absoluto"}
    rows = errors.count() if rows is None else rows
    for name, source in measures.items():
        base = _with_median(base, long, keys, source, name, rows)
    return base.select(*[c.split()[0] for c in SEGMENT_SCHEMA.split(", ")]).orderBy(
        F.desc("MAE"), F.desc("RMSE"), "segment_column", "segment_value"
    )


def _with_median(
    base: DataFrame, long: DataFrame, keys: list[str], source: str, name: str, rows: int
) -> DataFrame:
    found = grouped_quantiles(long, keys, source, [0.5], rows).select(
        F.struct(*keys).alias("_keys"), F.col("q")[0].alias(name)
    )
    side = small_side(found)
    return base.join(side, F.struct(*keys) == F.col("_keys"), "left").drop("_keys")


def problem_segments(segments: DataFrame, min_rows: int = 5, top: int = 10) -> DataFrame:
    return (
        segments.where(F.col("n") >= min_rows)
        .orderBy(F.desc("MAE"), "segment_column", "segment_value")
        .limit(top)
    )


def segment_labels(segments: DataFrame, min_rows: int = 5, top: int = 15) -> DataFrame:
    """Worst segments with a printable label; all segments count when none is large enough."""
    large = segments.where(F.col("n") >= min_rows)
    chosen = large if large.take(1) else segments
    return (
        chosen.orderBy(F.desc("MAE"), F.desc("RMSE"), "segment_column", "segment_value")
        .limit(top)
        .withColumn(
            "segment_label",
            F.concat_ws("=", "segment_column", F.coalesce("segment_value", F.lit("nan"))),
        )
    )


# --- classification ------------------------------------------------------------


def confusion_counts(predictions: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(keys, real, predicho, n): everything below derives from this small table."""
    return predictions.groupBy(*(by or ["model"]), "real", "predicho").agg(F.count("*").alias("n"))


def class_scores(predictions: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Precision, recall, F1 and support per class that occurs as real or predicted."""
    keys = by or ["model"]
    counts = confusion_counts(predictions, keys)
    hit = F.when(F.col("real") == F.col("predicho"), F.col("n")).otherwise(0)
    zero = F.lit(0).cast("long")
    as_real = counts.select(
        *keys, F.col("real").alias("clase"), hit.alias("hits"),
        F.col("n").alias("support"), zero.alias("predicted"),
    )
    as_predicted = counts.select(
        *keys, F.col("predicho").alias("clase"), zero.alias("hits"),
        zero.alias("support"), F.col("n").alias("predicted"),
    )
    sums = as_real.unionAll(as_predicted).groupBy(*keys, "clase").agg(
        F.sum("hits").alias("hits"), F.sum("support").alias("support"),
        F.sum("predicted").alias("predicted"),
    )

    def ratio(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))

    return sums.withColumns(
        {
            "precision": ratio(F.col("hits"), F.col("predicted")),
            "recall": ratio(F.col("hits"), F.col("support")),
            "f1": ratio(2 * F.col("hits"), F.col("predicted") + F.col("support")),
        }
    )


def cls_metrics(predictions: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Accuracy and macro / weighted precision, recall and F1 per model."""
    keys = by or ["model"]
    scores = class_scores(predictions, keys)
    weighted = {
        f"{m}_weighted": F.try_divide(
            F.sum(F.col(m) * F.col("support")), F.sum("support").cast("double")
        )
        for m in ("precision", "recall", "f1")
    }
    return (
        scores.groupBy(*keys)
        .agg(
            F.try_divide(F.sum("hits").cast("double"), F.sum("support")).alias("accuracy"),
            *[F.avg(m).alias(f"{m}_macro") for m in ("precision", "recall", "f1")],
            *[c.alias(n) for n, c in weighted.items()],
        )
        .orderBy(F.desc("f1_macro"), *keys)
    )


def confusion_matrix(predictions: DataFrame, labels: list[str] | None = None) -> DataFrame:
    """Counts as actual_<label> rows and pred_<label> columns over the union of labels."""
    counts = predictions.groupBy("real", "predicho").agg(F.count("*").alias("n"))
    if labels is None:
        both = counts.select(F.explode(F.array("real", "predicho")).alias("l"))
        labels = sorted(r["l"] for r in both.distinct().collect())  # classes
    grid = predictions.sparkSession.createDataFrame([(x,) for x in labels], "real string")
    wide = counts.groupBy("real").agg(
        *[
            F.sum(F.when(F.col("predicho") == x, F.col("n")).otherwise(0)).alias(f"pred_{x}")
            for x in labels
        ]
    )
    return grid.join(wide, "real", "left").select(
        F.concat(F.lit("actual_"), "real").alias("actual"),
        *[F.coalesce(f"pred_{x}", F.lit(0).cast("long")).alias(f"pred_{x}") for x in labels],
    )


def cls_report(predictions: DataFrame) -> DataFrame:
    """Per class rows followed by accuracy, macro avg and weighted avg rows."""
    scores = class_scores(predictions.withColumn("_all", F.lit(0)), ["_all"])
    per_class = scores.select(
        F.col("clase").alias("fila"), "precision", "recall", "f1", F.col("support").cast("double").alias("support")
    )
    hits = F.try_divide(F.sum("hits").cast("double"), F.sum("support"))
    total = F.sum("support").cast("double")

    def row(name: str, *cells: Column) -> DataFrame:
        names = ["precision", "recall", "f1", "support"]
        return scores.agg(*[c.alias(n) for c, n in zip(cells, names)]).select(
            F.lit(name).alias("fila"), *names
        )

    def mean(m: str) -> Column:
        return F.avg(m)

    def weighted(m: str) -> Column:
        return F.try_divide(F.sum(F.col(m) * F.col("support")), total)

    return (
        per_class.unionByName(row("accuracy", hits, hits, hits, hits))
        .unionByName(row("macro avg", mean("precision"), mean("recall"), mean("f1"), total))
        .unionByName(row("weighted avg", weighted("precision"), weighted("recall"), weighted("f1"), total))
    )
