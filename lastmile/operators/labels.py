"""Delivery classes from time or risk: tercile cut-offs, percent ranks, risk score."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lastmile.functions import numeric, text_key
from lastmile.operators.clean import TIME_NAMES, require_columns
from lastmile.operators.quantiles import quantiles, value_ranks
from lastmile.operators.sizing import BROADCAST_ROWS, written
from lastmile.schema import CLASSES, LABEL, RISK, TARGET

# Accepted column names per risk component.
RANKED_HIGH = [
    ["distancia_km", "distance_km", "distance"],
    ["paradas_previas", "stops", "prior_stops", "num_stops"],
    ["peso_carga_kg", "peso_carga", "cargo_weight_kg", "load_weight_kg"],
    ["costo_envio", "shipping_cost", "delivery_cost"],
    ["consumo_nafta", "fuel_consumption", "consumo_combustible"],
]
RANKED_LOW = [["experiencia_chofer_anios", "driver_experience_years", "experiencia_conductor"]]
HOUR_NAMES = ["hora_despacho", "hora_pedido", "order_hour", "delivery_hour"]
TRAFFIC_NAMES = ["trafico_nivel", "traffic_level", "traffic"]
WEATHER_NAMES = ["clima", "weather", "weather_condition"]
VEHICLE_NAMES = ["tipo_vehiculo", "vehicle_type", "vehicle"]

# Risk by traffic, weather and vehicle.
TRAFFIC_RISK = {
    "bajo": 0.1, "low": 0.1, "medio": 0.5, "medium": 0.5,
    "alto": 0.8, "high": 0.8, "critico": 1.0, "critical": 1.0,
}
WEATHER_RISK = {
    "despejado": 0.1, "soleado": 0.1, "sunny": 0.1, "nublado": 0.4, "cloudy": 0.4,
    "parcialmente nublado": 0.35, "lluvia": 0.8, "lluvioso": 0.8, "rainy": 0.8,
    "tormenta": 1.0, "storm": 1.0, "niebla": 0.7, "fog": 0.7,
}
VEHICLE_RISK = {
    "moto": 0.2, "motocicleta": 0.2, "bike": 0.2, "van": 0.5, "furgon": 0.5,
    "camioneta": 0.55, "auto": 0.35, "car": 0.35, "camion": 0.8, "truck": 0.8,
}


def resolve(df: DataFrame, candidates: list[str]) -> str | None:
    """The first of the candidate names that the frame has."""
    return next((c for c in candidates if c in df.columns), None)


def _positive(df: DataFrame, target: str) -> Column:
    value = numeric(df, target)
    return F.when(value > 0, value)


def _check_thresholds(q33: float, q66: float) -> None:
    if not (math.isfinite(q33) and math.isfinite(q66)):
        raise ValueError("class thresholds must be finite")
    if q33 >= q66:
        raise ValueError(f"class thresholds must ascend: {q33} is not below {q66}")


def fit_terciles(train: DataFrame, target: str = TARGET) -> dict[str, float]:
    """q33 and q66 of the positive target values, with checks that three classes exist."""
    require_columns(train, [target])
    values = train.select(_positive(train, target).alias("t"))
    q33, q66 = quantiles(values, {"t": [1 / 3, 2 / 3]})["t"]
    if q33 is None:
        raise ValueError("no valid target values to derive class thresholds from")
    # Three distinct values exist when one lies strictly between the ends.
    ends = values.agg(F.min("t").alias("lo"), F.max("t").alias("hi")).first()
    between = values.where((F.col("t") > ends["lo"]) & (F.col("t") < ends["hi"]))
    if not between.take(1):
        raise ValueError("at least 3 distinct target values are needed for three classes")
    _check_thresholds(q33, q66)
    return {"q33": q33, "q66": q66}


def tercile_of(value: Column, thresholds: dict[str, float]) -> Column:
    """Class of a value; a missing value is 'normal'."""
    if not {"q33", "q66"} <= set(thresholds):
        raise ValueError("thresholds need the entries 'q33' and 'q66'")
    low, high = float(thresholds["q33"]), float(thresholds["q66"])
    _check_thresholds(low, high)
    fast, normal, late = CLASSES
    return (
        F.when(value.isNull(), normal).when(value <= low, fast).when(value <= high, normal).otherwise(late)
    )


def apply_terciles(
    df: DataFrame, thresholds: dict[str, float], target: str = TARGET, label: str = LABEL
) -> DataFrame:
    return df.withColumn(label, tercile_of(numeric(df, target), thresholds))


def label_by_time(df: DataFrame, target: str | None = None) -> tuple[DataFrame, dict[str, float]]:
    """Terciles over the whole table; times <= 0 count as missing."""
    target = target or resolve(df, TIME_NAMES)
    if target is None:
        raise ValueError("no delivery time column found")
    value = _positive(df, target)
    q33, q66 = quantiles(df.select(value.alias("t")), {"t": [1 / 3, 2 / 3]})["t"]
    if q33 is None:
        raise ValueError("no valid target values to derive classes from")
    thresholds = {"q33": q33, "q66": q66}
    return df.withColumn(LABEL, tercile_of(value, thresholds)), thresholds


def rank_percent(
    df: DataFrame, columns: dict[str, str], low_is_risky: frozenset[str] = frozenset()
) -> DataFrame:
    """Add average-rank percentiles: ``columns`` maps source to output name.

    Ranks belong to distinct values; they are joined back by value, broadcast where
    the distinct values are counted to be few.
    """
    # Written once: the count, the sketches and every column's count read it.
    keyed = written(df.select(*[numeric(df, c).alias(c) for c in columns]))
    ranks = written(value_ranks(keyed, list(columns)))
    distinct = {r["_column"]: r["count"] for r in ranks.groupBy("_column").count().collect()}
    share = (F.col("_below") + (F.col("_n") + 1) / 2.0) / F.col("_total")
    hashable = [c for c, t in df.dtypes if "map<" not in t and "vector" not in t]
    out = df
    for source, name in columns.items():
        scored = ranks.where(F.col("_column") == source).select(
            "_value", (1 - share if source in low_is_risky else share).alias(name)
        )
        side = F.broadcast(scored) if distinct.get(source, 0) <= BROADCAST_ROWS else scored
        # Null keys match nothing; a negative mark by the row's hash instead of the one null spreads
        # them, alike when a task runs again.
        out = out.withColumn("_key", numeric(df, source)).withColumn(
            "_mark", F.when(F.col("_key").isNull(), -1 - F.pmod(F.xxhash64(*hashable), F.lit(4096))).otherwise(0)
        )
        side = side.withColumn("_zero", F.lit(0).cast("long"))
        out = out.join(side, (F.col("_key").eqNullSafe(F.col("_value"))) & (F.col("_mark") == F.col("_zero")), "left").drop(
            "_key", "_value", "_mark", "_zero"
        )
    return out


def lookup(c: Column, table: dict[str, float]) -> Column:
    key = text_key(c)
    mapped = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.try_element_at(mapped, key)


def hour_risk(hour: Column) -> Column:
    busy = hour.between(7, 10) | hour.between(17, 20)
    return (
        F.when(hour.isNull(), None).when(hour.between(0, 5), 0.6).when(busy, 1.0).otherwise(0.4)
    )


def risk_components(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """Add one column per available risk component and return their names."""
    high = [c for c in (resolve(df, names) for names in RANKED_HIGH) if c]
    low = [c for c in (resolve(df, names) for names in RANKED_LOW) if c]
    ranked = {c: f"_risk_{c}" for c in [*high, *low]}
    out = rank_percent(df, ranked, frozenset(low)) if ranked else df
    mapped: dict[str, Column] = {}
    hour = resolve(df, HOUR_NAMES)
    if hour:
        mapped[f"_risk_{hour}"] = hour_risk(numeric(df, hour))
    for names, table in (
        (TRAFFIC_NAMES, TRAFFIC_RISK), (WEATHER_NAMES, WEATHER_RISK), (VEHICLE_NAMES, VEHICLE_RISK),
    ):
        found = resolve(df, names)
        if found:
            mapped[f"_risk_{found}"] = lookup(F.col(found), table)
    names = [*ranked.values(), *mapped]
    if not names:
        raise ValueError("no delivery time and no column to derive a risk score from")
    return out.withColumns(mapped) if mapped else out, names


def row_mean(columns: list[Column]) -> Column:
    """Mean over the present values of a row, null when there are none."""
    total = reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0.0)) for c in columns])
    filled = reduce(lambda a, b: a + b, [c.isNotNull().cast("int") for c in columns])
    return F.try_divide(total, filled)


def label_by_risk(df: DataFrame) -> tuple[DataFrame, dict[str, float]]:
    """Risk score from the operational columns, and its terciles as classes."""
    scored, names = risk_components(df)
    # Written once: three passes follow, and the ranks cost one join per component.
    raw = written(scored.withColumn("_score", row_mean([F.col(c) for c in names])).drop(*names))
    middle = quantiles(raw, {"_score": [0.5]})["_score"][0]
    filled = raw.withColumn("_score", F.coalesce("_score", F.lit(0.5 if middle is None else middle)))
    q33, q66 = quantiles(filled, {"_score": [1 / 3, 2 / 3]})["_score"]
    thresholds = {"q33": q33, "q66": q66}
    labelled = filled.withColumns(
        {RISK: F.bround("_score", 4), LABEL: tercile_of(F.col("_score"), thresholds)}
    ).drop("_score")
    return labelled, thresholds


def add_delivery_class(df: DataFrame) -> tuple[DataFrame, dict[str, float]]:
    """Classes by time where a time column exists, by risk otherwise."""
    if not df.take(1):
        raise ValueError("the table is empty")
    return label_by_time(df) if resolve(df, TIME_NAMES) else label_by_risk(df)
