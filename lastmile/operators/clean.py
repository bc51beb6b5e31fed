"""Cleaning: names, text, numbers, duplicates, invalid targets, outlier capping."""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lastmile.functions import decimal_point, known_text, numeric, parsed, text_form
from lastmile.functions.columns import NULL_ID_TEXTS, NULL_TEXTS
from lastmile.operators.features import add_improved_features
from lastmile.operators.quantiles import quantiles
from lastmile.operators.sizing import repeat_rows, written
from lastmile.schema import (
    CATEGORICAL,
    FEATURES,
    ID_COLUMN,
    LABEL,
    NUMERIC,
    NUMERIC_AND_TARGET,
    REQUIRED,
    TARGET,
    TEXT,
)

# --- names and presence ------------------------------------------------------


def normalize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip().lower().replace(" ", "_") for c in df.columns])


def require_columns(df: DataFrame, names: Iterable[str]) -> None:
    missing = [c for c in names if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")


def _replace(df: DataFrame, changed: dict[str, Column]) -> DataFrame:
    """One projection that swaps the given columns and keeps the order."""
    return df.select(*[changed[c].alias(c) if c in changed else F.col(c) for c in df.columns])


# --- text and numbers --------------------------------------------------------


def _clean_texts(df: DataFrame, columns: list[str], null_texts: list[str]) -> DataFrame:
    # Two projections, so that the text is formed once per row and then tested.
    formed = _replace(df, {c: text_form(F.col(c)) for c in columns})
    return _replace(formed, {c: known_text(F.col(c), null_texts) for c in columns})


def clean_text(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return _clean_texts(df, [c for c in columns if c in df.columns], NULL_TEXTS)


def clean_id(df: DataFrame, column: str = ID_COLUMN) -> DataFrame:
    return _clean_texts(df, [column] if column in df.columns else [], NULL_ID_TEXTS)


def parse_numeric(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    present = [c for c in columns if c in df.columns]
    texts = [c for c in present if isinstance(df.schema[c].dataType, T.StringType)]
    pointed = _replace(df, {c: decimal_point(F.col(c)) for c in texts})
    return _replace(
        pointed, {c: parsed(F.col(c)) if c in texts else numeric(df, c) for c in present}
    )


def parse_target(df: DataFrame, target: str = TARGET) -> DataFrame:
    require_columns(df, [target])
    return parse_numeric(df, [target])


def inf_to_null(df: DataFrame) -> DataFrame:
    floats = [
        f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    ]
    return _replace(df, {c: F.when(F.abs(c) != math.inf, F.col(c)) for c in floats})


# --- duplicates --------------------------------------------------------------


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def list_duplicates(df: DataFrame) -> DataFrame:
    """The second and later copies of every row.

    Copies are counted before the shuffle and written out again by several tasks.
    """
    extra = df.groupBy(*df.columns).agg((F.count("*") - 1).alias("_extra"))
    return repeat_rows(extra, "_extra")


def duplicate_counts(df: DataFrame) -> DataFrame:
    """One row: all rows, extra copies, and their share in percent."""
    per_row = df.groupBy(*df.columns).agg(F.count("*").alias("n"))
    return per_row.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("filas_totales"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicados_exactos"),
    ).withColumn(
        "porcentaje_duplicados",
        F.bround(
            F.col("duplicados_exactos")
            / F.greatest(F.col("filas_totales"), F.lit(1)).cast("double") * 100,
            2,
        ),
    )


def duplicate_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: rows before, after and removed."""
    counts = before.agg(F.count("*").alias("b"), F.lit(0).cast("long").alias("a")).unionByName(
        after.agg(F.lit(0).cast("long").alias("b"), F.count("*").alias("a"))
    )
    return counts.agg(F.sum("b").alias("rows_before"), F.sum("a").alias("rows_after")).withColumn(
        "rows_removed", F.col("rows_before") - F.col("rows_after")
    )


# --- target validity ---------------------------------------------------------


def drop_null_target(df: DataFrame, target: str = TARGET) -> DataFrame:
    require_columns(df, [target])
    return df.dropna(subset=[target])


def split_invalid_target(df: DataFrame, target: str = TARGET) -> tuple[DataFrame, DataFrame]:
    """(kept, removed): removed rows have a target <= 0; a null target is kept."""
    require_columns(df, [target])
    invalid = F.coalesce(numeric(df, target) <= 0, F.lit(False))
    return df.where(~invalid), df.where(invalid)


def positive_target_only(df: DataFrame, target: str = TARGET) -> DataFrame:
    return df.where(numeric(df, target) > 0)


def flag_suspicious(df: DataFrame, threshold: float = 10, target: str = TARGET) -> DataFrame:
    require_columns(df, [target])
    return df.withColumn(
        "tiempo_sospechoso", F.coalesce(numeric(df, target) < threshold, F.lit(False))
    )


def suspicious_rows(df: DataFrame, threshold: float = 10, target: str = TARGET) -> DataFrame:
    require_columns(df, [target])
    value = numeric(df, target)
    return df.where(value < threshold).withColumns(
        {"tiempo_sospechoso": F.lit(True), "target_invalido": value <= 0}
    )


# --- outliers ----------------------------------------------------------------


def fit_iqr_bounds(
    df: DataFrame, columns: list[str], rows: int | None = None
) -> dict[str, tuple[float, float]]:
    """Tukey fences per column; a column without values is unbounded."""
    require_columns(df, columns)
    parsed = df.select(*[numeric(df, c).alias(c) for c in columns])
    bounds = {}
    for c, (q1, q3) in quantiles(parsed, {c: [0.25, 0.75] for c in columns}, rows).items():
        if q1 is None:
            bounds[c] = (-math.inf, math.inf)
        else:
            iqr = q3 - q1
            bounds[c] = (q1 - 1.5 * iqr, q3 + 1.5 * iqr)
    return bounds


def apply_caps(df: DataFrame, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    """Clip to the bounds; nulls stay null."""
    clipped = {}
    for c, (low, high) in bounds.items():
        v = numeric(df, c)
        clipped[c] = F.when(v < low, F.lit(low)).when(v > high, F.lit(high)).otherwise(v)
    return _replace(df, clipped)


def cap_outliers(df: DataFrame, columns: list[str], rows: int | None = None) -> DataFrame:
    present = [c for c in columns if c in df.columns]
    return apply_caps(df, fit_iqr_bounds(df, present, rows))


def outlier_rows(df: DataFrame, column: str) -> DataFrame:
    low, high = fit_iqr_bounds(df, [column])[column]
    v = numeric(df, column)
    return df.where((v < low) | (v > high))


# --- column roles ------------------------------------------------------------


def select_xy(df: DataFrame, features: list[str] = FEATURES, target: str = TARGET) -> DataFrame:
    require_columns(df, [*features, target])
    return df.select(*features, target)


def drop_target(df: DataFrame, target: str = TARGET) -> DataFrame:
    return df.drop(target)


def infer_roles(df: DataFrame, exclude: Iterable[str] = ()) -> dict[str, list[str]]:
    """Column names by role from the schema; booleans count as categorical."""
    left_out = set(exclude)
    fields = [f for f in df.schema.fields if f.name not in left_out]
    numbers = [f.name for f in fields if isinstance(f.dataType, T.NumericType)]
    return {
        "numeric": numbers,
        "boolean": [f.name for f in fields if isinstance(f.dataType, T.BooleanType)],
        "categorical": [f.name for f in fields if f.name not in set(numbers)],
    }


# Names of a delivery time, in order of preference.
TIME_NAMES = [
    "target_tiempo_entrega",
    "tiempo_entrega",
    "tiempo_entrega_min",
    "tiempo_entrega_minutos",
    "delivery_time",
    "delivery_time_minutes",
    "duracion_entrega",
    "duracion",
    "duration",
    "duration_minutes",
]
# Other names that give the target away.
LEAK_NAMES = [
    "riesgo_logistico",
    "entrega_tardia",
    "alta_demora_estimada",
    "categoria_riesgo_entrega",
    "riesgo_entrega",
]
# Parts of a name that hint at an identifier.
ID_HINTS = ["id", "uuid", "guid"]


def exclude_columns(df: DataFrame, target: str = LABEL) -> list[tuple[str, str]]:
    """(column, reason) for columns that must not be used as features, in column order.

    One scan finds constants, row counts and text lengths; distinct values are only
    counted for the few columns where the count decides.
    """
    banned = set(TIME_NAMES) | set(LEAK_NAMES)

    def plain(name: str) -> str:
        return name.strip().lower().translate(str.maketrans("áéíóúüñ", "aeiouun")).replace(" ", "_")

    reasons: dict[str, str] = {}
    open_columns = []
    for c in df.columns:
        if c == target:
            reasons[c] = "columna_target"
        elif c in banned or plain(c) in banned:
            reasons[c] = "posible_fuga_de_datos"
        else:
            open_columns.append(c)

    texts = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    stats = []
    for c in open_columns:
        stats += [F.count(c).alias(f"{c}|n"), (F.min(c) == F.max(c)).alias(f"{c}|same")]
        if c in texts:
            stats.append(F.avg(F.length(c)).alias(f"{c}|len"))
    row = df.agg(*stats).first() if stats else None

    id_like = [c for c in open_columns if any(h in plain(c) for h in ID_HINTS)]
    long_text = [c for c in open_columns if c in texts and (row[f"{c}|len"] or 0) >= 20]
    to_count = list(dict.fromkeys(id_like + long_text))
    distinct = (
        df.agg(*[F.count_distinct(c).alias(c) for c in to_count]).first() if to_count else {}
    )
    for c in open_columns:
        share = distinct[c] / max(row[f"{c}|n"], 1) if c in to_count else 0.0
        if c in id_like and share >= 0.9:
            reasons[c] = "identificador_alta_unicidad"
        elif c in long_text and share >= 0.8:
            reasons[c] = "texto_libre_irrelevante"
        elif row[f"{c}|n"] == 0 or row[f"{c}|same"]:
            reasons[c] = "columna_constante"
    return [(c, reasons[c]) for c in df.columns if c in reasons]


# --- whole flows -------------------------------------------------------------


def _standardised(df: DataFrame, text: list[str]) -> DataFrame:
    named = normalize_columns(df)
    require_columns(named, REQUIRED)
    return parse_numeric(clean_text(named, text), NUMERIC_AND_TARGET)


def clean_regression(df: DataFrame) -> DataFrame:
    """Standardised, without copies or null targets, features and target capped."""
    ready = written(drop_null_target(drop_exact_duplicates(_standardised(df, CATEGORICAL))))
    return cap_outliers(ready, NUMERIC_AND_TARGET)


def clean_improved(df: DataFrame, cap: bool = True) -> DataFrame:
    """As above with positive targets only, the target left uncapped, and features added."""
    ready = positive_target_only(drop_exact_duplicates(_standardised(df, CATEGORICAL)))
    return add_improved_features(cap_outliers(written(ready), NUMERIC) if cap else ready)


def clean_prepared(df: DataFrame) -> DataFrame:
    """For tables cleaned before: numbers and target only, then features."""
    named = normalize_columns(df)
    require_columns(named, REQUIRED)
    return add_improved_features(positive_target_only(parse_numeric(named, NUMERIC_AND_TARGET)))


def clean_eda(df: DataFrame, drop_invalid: bool = True) -> DataFrame:
    named = clean_id(_standardised(df, TEXT))
    unique = drop_exact_duplicates(named)
    kept = split_invalid_target(unique)[0] if drop_invalid else unique
    return flag_suspicious(kept)


def clean_eda_counts(df: DataFrame, drop_invalid: bool = True) -> DataFrame:
    """The counts of the exploratory cleaning, from one pass over the distinct rows."""
    named = clean_id(_standardised(df, TEXT))
    unique = named.groupBy(*named.columns).agg(F.count("*").alias("_n"))
    t = F.col(TARGET)
    gone = F.coalesce(t <= 0, F.lit(False)) if drop_invalid else F.lit(False)
    return unique.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows_original"),
        F.count("*").alias("rows_after_duplicates"),
        F.count_if(~gone).alias("rows_final"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates_removed"),
        F.count_if(gone).alias("invalid_target_removed"),
        F.count_if(~gone & F.coalesce(t < 10, F.lit(False))).alias("suspicious_time_count"),
    )
