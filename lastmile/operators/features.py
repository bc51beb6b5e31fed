"""Row-local feature columns. Cut-offs are a separate fit result, so that they can
come from the training rows only; without one they are fitted on the given frame."""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lastmile.functions import flag, numeric, peak_hour, safe_ratio
from lastmile.operators.quantiles import quantiles
from lastmile.schema import ID_COLUMN

RATIOS = {
    "costo_por_km": "costo_envio",
    "consumo_por_km": "consumo_nafta",
    "carga_por_km": "peso_carga_kg",
    "paradas_por_km": "paradas_previas",
}

CYCLIC_FEATURES = ["hora_sin", "hora_cos"]
IMPROVED_NUMERIC = [*CYCLIC_FEATURES, *RATIOS]
IMPROVED_CATEGORICAL = ["trafico_clima", "trafico_vehiculo"]
LOGISTICS_NUMERIC = [
    "distancia_por_parada",
    "costo_por_km",
    "consumo_por_km",
    "hora_punta",
    "muchas_paradas",
    "carga_pesada",
]
LOGISTICS_CATEGORICAL = ["trafico_clima"]
PRECISION_NUMERIC = [
    "hora_punta_manana",
    "hora_punta_tarde",
    "hora_nocturna",
    "distancia_total_ajustada",
    "paradas_por_km",
    "peso_por_km",
    "carga_x_distancia",
    "chofer_experto",
    "costo_por_kg",
    "consumo_por_kg",
]
PRECISION_CATEGORICAL = ["trafico_vehiculo", "clima_vehiculo"]
HISTORY_NUMERIC = [
    "hist_mean_target_by_id_bodega",
    "hist_mean_target_by_tipo_vehiculo",
    "hist_mean_target_by_trafico_nivel",
]
ERROR_FOCUSED = [
    "es_camion",
    "es_moto",
    "trafico_alto",
    "trafico_bajo",
    "hora_punta",
    "distancia_larga",
    "distancia_corta",
    "carga_pesada",
    "muchas_paradas",
    "camion_trafico_alto",
    "camion_carga_pesada",
    "trafico_alto_hora_punta",
    "distancia_larga_muchas_paradas",
    "bodega_1",
    "bodega_4",
    "bodega_problematico",
    "bodega_problematico_trafico_alto",
]

Cuts = dict[tuple[str, float], float | None]


def fit_cuts(df: DataFrame, wanted: Iterable[tuple[str, float]], rows: int | None = None) -> Cuts:
    """Quantile cut-offs {(column, prob): value} of the columns that exist."""
    by_column: dict[str, list[float]] = {}
    for c, p in wanted:
        if c in df.columns:
            by_column.setdefault(c, []).append(p)
    parsed = df.select(*[numeric(df, c).alias(c) for c in by_column])
    found = quantiles(parsed, by_column, rows)
    return {(c, p): v for c, ps in by_column.items() for p, v in zip(ps, found[c])}


def _reaches(value: Column, cut: float | None) -> Column:
    return flag(value >= cut) if cut is not None else F.lit(0)


def _joined_text(separator: str, missing: str, *names: str) -> Column:
    return F.concat_ws(
        separator, *[F.coalesce(F.col(n).cast("string"), F.lit(missing)) for n in names]
    )


def _need(df: DataFrame, names: Iterable[str]) -> None:
    missing = [c for c in names if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns for these features: {missing}")


def _finite(c: Column) -> Column:
    return F.when(F.abs(c) != math.inf, c)


def add_cyclic_hour(df: DataFrame, hour: str = "hora_despacho", wrap: bool = False) -> DataFrame:
    """Hour on the unit circle; ``wrap`` takes the hour modulo 24 first."""
    _need(df, [hour])
    value = numeric(df, hour)
    angle = (F.pmod(value, F.lit(24.0)) if wrap else value) * (2 * math.pi) / 24.0
    return df.withColumns({"hora_sin": F.sin(angle), "hora_cos": F.cos(angle)})


def add_ratios(df: DataFrame, divisor: str = "distancia_km") -> DataFrame:
    _need(df, [divisor, *RATIOS.values()])
    return df.withColumns(
        {name: safe_ratio(numeric(df, c), numeric(df, divisor)) for name, c in RATIOS.items()}
    )


def add_exploratory_features(df: DataFrame) -> DataFrame:
    if ID_COLUMN in df.columns:
        df = df.withColumn(ID_COLUMN, F.col(ID_COLUMN).cast("string"))
    return add_ratios(add_cyclic_hour(df))


def add_improved_features(df: DataFrame) -> DataFrame:
    _need(df, ["hora_despacho", "distancia_km", *RATIOS.values(), "trafico_nivel", "clima", "tipo_vehiculo"])
    return add_ratios(add_cyclic_hour(df, wrap=True)).withColumns(
        {
            "trafico_clima": _joined_text("__", "desconocido", "trafico_nivel", "clima"),
            "trafico_vehiculo": _joined_text("__", "desconocido", "trafico_nivel", "tipo_vehiculo"),
        }
    )


LOGISTICS_CUTS = [("paradas_previas", 0.5), ("peso_carga_kg", 0.5)]


def add_logistics_features(df: DataFrame, cuts: Cuts | None = None) -> DataFrame:
    cuts = fit_cuts(df, LOGISTICS_CUTS) if cuts is None else cuts
    has = set(df.columns).issuperset
    new: dict[str, Column] = {}
    if has({"distancia_km", "paradas_previas"}):
        new["distancia_por_parada"] = _finite(
            safe_ratio(numeric(df, "distancia_km"), numeric(df, "paradas_previas") + 1)
        )
    for name in ("costo_por_km", "consumo_por_km"):
        if has({RATIOS[name], "distancia_km"}):
            new[name] = safe_ratio(numeric(df, RATIOS[name]), numeric(df, "distancia_km"))
    if has({"hora_despacho"}):
        new["hora_punta"] = flag(peak_hour(numeric(df, "hora_despacho")))
    if has({"paradas_previas"}):
        new["muchas_paradas"] = _reaches(
            numeric(df, "paradas_previas"), cuts.get(("paradas_previas", 0.5))
        )
    if has({"peso_carga_kg"}):
        new["carga_pesada"] = _reaches(
            numeric(df, "peso_carga_kg"), cuts.get(("peso_carga_kg", 0.5))
        )
    if has({"trafico_nivel", "clima"}):
        new["trafico_clima"] = _joined_text("_", "nan", "trafico_nivel", "clima")
    return df.withColumns(new) if new else df


PRECISION_CUTS = [("experiencia_chofer_anios", 0.5)]


def add_precision_features(df: DataFrame, cuts: Cuts | None = None) -> DataFrame:
    cuts = fit_cuts(df, PRECISION_CUTS) if cuts is None else cuts
    has = set(df.columns).issuperset
    new: dict[str, Column] = {}
    if has({"hora_despacho"}):
        hour = numeric(df, "hora_despacho")
        new["hora_punta_manana"] = flag(hour.between(7, 9))
        new["hora_punta_tarde"] = flag(hour.between(18, 21))
        new["hora_nocturna"] = flag((hour >= 22) | (hour <= 6))
    if has({"distancia_km", "paradas_previas"}):
        distance, stops = numeric(df, "distancia_km"), numeric(df, "paradas_previas")
        new["distancia_total_ajustada"] = distance * (1 + 0.08 * stops)
        new["paradas_por_km"] = safe_ratio(stops, distance)
    if has({"peso_carga_kg", "distancia_km"}):
        load, distance = numeric(df, "peso_carga_kg"), numeric(df, "distancia_km")
        new["peso_por_km"] = safe_ratio(load, distance)
        new["carga_x_distancia"] = load * distance
    if has({"experiencia_chofer_anios"}):
        new["chofer_experto"] = _reaches(
            numeric(df, "experiencia_chofer_anios"), cuts.get(("experiencia_chofer_anios", 0.5))
        )
    for name, top in (("costo_por_kg", "costo_envio"), ("consumo_por_kg", "consumo_nafta")):
        if has({top, "peso_carga_kg"}):
            new[name] = safe_ratio(numeric(df, top), numeric(df, "peso_carga_kg"))
    if has({"trafico_nivel", "tipo_vehiculo"}):
        new["trafico_vehiculo"] = _joined_text("_", "nan", "trafico_nivel", "tipo_vehiculo")
    if has({"clima", "tipo_vehiculo"}):
        new["clima_vehiculo"] = _joined_text("_", "nan", "clima", "tipo_vehiculo")
    out = df.withColumns(new) if new else df
    return out.select(
        *[
            _finite(F.col(f.name)).alias(f.name) if f.dataType.typeName() in ("double", "float") else f.name
            for f in out.schema.fields
        ]
    )


ERROR_FOCUSED_CUTS = [
    ("distancia_km", 0.75),
    ("distancia_km", 0.25),
    ("peso_carga_kg", 0.75),
    ("paradas_previas", 0.75),
]


def add_error_focused_features(df: DataFrame, cuts: Cuts | None = None) -> DataFrame:
    """0/1 marks of hard segments and their products; an absent input gives 0."""
    cuts = fit_cuts(df, ERROR_FOCUSED_CUTS) if cuts is None else cuts

    def text_is(name: str, value: str) -> Column:
        if name not in df.columns:
            return F.lit(0)
        return flag(F.lower(F.trim(F.col(name).cast("string"))) == value)

    def upper(name: str) -> Column:
        if name not in df.columns:
            return F.lit(0)
        return _reaches(numeric(df, name), cuts.get((name, 0.75)))

    low = cuts.get(("distancia_km", 0.25))
    house = numeric(df, ID_COLUMN) if ID_COLUMN in df.columns else F.lit(None).cast("double")
    base = {
        "es_camion": text_is("tipo_vehiculo", "camion"),
        "es_moto": text_is("tipo_vehiculo", "moto"),
        "trafico_alto": text_is("trafico_nivel", "alto"),
        "trafico_bajo": text_is("trafico_nivel", "bajo"),
        "hora_punta": flag(peak_hour(numeric(df, "hora_despacho")))
        if "hora_despacho" in df.columns
        else F.lit(0),
        "distancia_larga": upper("distancia_km"),
        "distancia_corta": flag(numeric(df, "distancia_km") <= low) if low is not None else F.lit(0),
        "carga_pesada": upper("peso_carga_kg"),
        "muchas_paradas": upper("paradas_previas"),
        "bodega_1": flag(house == 1),
        "bodega_4": flag(house == 4),
        "bodega_problematico": flag(house.isin(1.0, 4.0)),
    }
    marked = df.withColumns(base)

    def both(a: str, b: str) -> Column:
        return F.col(a) * F.col(b)

    return marked.withColumns(
        {
            "camion_trafico_alto": both("es_camion", "trafico_alto"),
            "camion_carga_pesada": both("es_camion", "carga_pesada"),
            "trafico_alto_hora_punta": both("trafico_alto", "hora_punta"),
            "distancia_larga_muchas_paradas": both("distancia_larga", "muchas_paradas"),
            "bodega_problematico_trafico_alto": both("bodega_problematico", "trafico_alto"),
        }
    )


def feature_union(*lists: Iterable[str]) -> list[str]:
    """Ordered union without repeats."""
    return list(dict.fromkeys(name for names in lists for name in names))


def present(df: DataFrame, names: Iterable[str]) -> list[str]:
    return [n for n in names if n in df.columns]


# Fixed values: (feature, kind of transformation, recommendation).
CATALOG = [
    ("hora_sin", "Ciclica", "Usar junto a hora_cos para respetar periodicidad diaria."),
    ("hora_cos", "Ciclica", "Complementa hora_sin para capturar comportamiento horario."),
    ("costo_por_km", "Ratio", "Aproxima intensidad de costo por unidad de distancia."),
    ("consumo_por_km", "Ratio", "Puede capturar eficiencia de ruta y vehiculo."),
    ("carga_por_km", "Ratio", "Relaciona exigencia de carga con distancia recorrida."),
    ("paradas_por_km", "Ratio", "Representa densidad de paradas por trayecto."),
    ("consumo_nafta", "Riesgo de leakage", "Comparar modelos con y sin esta variable por posible fuga."),
]


def feature_catalog(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        CATALOG, "feature string, tipo_transformacion string, recomendacion string"
    )
