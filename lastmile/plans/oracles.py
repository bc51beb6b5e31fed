"""The registered queries in ANSI SQL for DuckDB, written independently of the Spark code."""

from __future__ import annotations

from lastmile.plans.binding import CLASSIFIERS, DELIVERIES, PREDICTORS

NUMERIC = [
    "distancia_km", "peso_carga_kg", "paradas_previas", "experiencia_chofer_anios",
    "hora_despacho", "costo_envio", "consumo_nafta",
]
TARGET = "target_tiempo_entrega"
NUMBERS = [*NUMERIC, TARGET]
TEXTS = ["trafico_nivel", "clima", "tipo_vehiculo"]
CATEGORIES = [*TEXTS, "id_bodega"]
ORACLES: dict[str, str] = {}


def r(expression: str, digits: int = 6) -> str:
    """Rounded as on the Spark side; adding zero turns -0.0 into 0.0."""
    return f"(round({expression}, {digits}) + 0.0::DOUBLE)"


def listed(names: list[str], pattern: str = "{}") -> str:
    return ", ".join(pattern.format(*[n] * pattern.count("{}")) for n in names)


def cleaned(c: str, ids: bool = False) -> str:
    nulls = ["", "nan", "none", "null", "na", "n/a"]
    if not ids:
        nulls += ["sin dato", "sin_dato", "desconocido"]
    texts = ", ".join(f"'{n}'" for n in nulls)
    t = f"lower(regexp_replace(CAST({c} AS VARCHAR), '^\\s+|\\s+$', '', 'g'))"
    return f"CASE WHEN {t} IN ({texts}) THEN NULL ELSE {t} END AS {c}"


RAW = f"raw AS ({DELIVERIES})"
TIDY = (
    f"{RAW}, tidy AS (SELECT split_key, {listed(NUMBERS)}, "
    + ", ".join(cleaned(c) for c in TEXTS) + ", " + cleaned("id_bodega", True) + " FROM raw)"
)
PATCHY = (
    f"{TIDY}, patchy AS (SELECT split_key, "
    + listed(NUMBERS, "CASE WHEN split_key % 13 = 0 THEN NULL ELSE {} END AS {}")
    + f", {listed(CATEGORIES)} FROM tidy)"
)
PREDS = f"{TIDY}, preds AS (" + " UNION ALL ".join(
    f"SELECT '{m}' AS model, {TARGET} AS real, {e.replace('D ', ' ').rstrip('D')}::DOUBLE AS predicho, "
    f"split_key, {listed(NUMERIC)}, {listed(CATEGORIES)} FROM tidy WHERE split_key % 10 < 2"
    for m, e in PREDICTORS.items()
) + "), errs AS (SELECT *, real - predicho AS error, abs(real - predicho) AS error_absoluto FROM preds)"


def q(c: str, p: float | str) -> str:
    return f"quantile_cont({c}, {p})"


def fences(c: str) -> tuple[str, str]:
    iqr = f"({q(c, 0.75)} - {q(c, 0.25)})"
    return f"{q(c, 0.25)} - 1.5 * {iqr}", f"{q(c, 0.75)} + 1.5 * {iqr}"


def union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


def percent(part: str, whole: str, digits: int = 2) -> str:
    return f"round_even(({part})::DOUBLE / greatest({whole}, 1)::DOUBLE * 100, {digits})"


O = ORACLES

# --- flagship, sources and sinks ---------------------------------------------------

O["traffic_profile"] = f"""WITH {TIDY} SELECT trafico_nivel, count(*) AS n, {r(f"avg({TARGET})")} AS tiempo_medio,
{r("avg(costo_envio / nullif(distancia_km, 0))")} AS costo_por_km_medio FROM tidy GROUP BY trafico_nivel"""
O["scan_csv"] = f"""WITH {RAW} SELECT {listed(NUMBERS)}, {listed(TEXTS)},
CAST(id_bodega AS VARCHAR) AS id_bodega FROM raw"""
O["scan_discover"] = f"WITH {RAW} SELECT clima, count(*) AS n FROM raw GROUP BY clima"
O["sink_csv"] = f"WITH {TIDY} SELECT tipo_vehiculo, trafico_nivel, count(*) AS n FROM tidy GROUP BY ALL"
METRICS = f"""metrics AS (SELECT model, avg(abs(real - predicho)) AS MAE,
sqrt(avg((real - predicho) * (real - predicho))) AS RMSE,
1 - sum((real - predicho) * (real - predicho)) / (var_pop(real) * count(real)) AS R2 FROM preds GROUP BY model)"""
SHOW_METRICS = f"{r('MAE')} AS MAE, {r('RMSE')} AS RMSE, {r('R2')} AS R2"
O["sink_json_metrics"] = f"WITH {PREDS}, {METRICS} SELECT {SHOW_METRICS} FROM metrics WHERE model = 'stops'"
O["sink_best_row"] = f"WITH {PREDS}, {METRICS} SELECT model, {SHOW_METRICS} FROM metrics ORDER BY RMSE LIMIT 1"

# --- cleaning ---------------------------------------------------------------------

O["normalize_columns"] = f"WITH {RAW} SELECT * FROM raw"
O["require_columns"] = f"WITH {RAW} SELECT count(*) AS n FROM raw"
O["clean_text"] = f"WITH {TIDY} SELECT split_key, {listed(TEXTS)} FROM tidy"
O["clean_id_category"] = f"WITH {TIDY} SELECT split_key, id_bodega FROM tidy"
O["parse_numeric"] = f"WITH {RAW} SELECT split_key, {listed(NUMBERS)} FROM raw"
COPIES = "copies AS (SELECT * FROM {0} UNION ALL SELECT * FROM {0} WHERE split_key % 100 = 7)"
O["drop_exact_duplicates"] = f"WITH {RAW}, {COPIES.format('raw')} SELECT DISTINCT * FROM copies"
O["list_duplicates"] = f"WITH {RAW} SELECT * FROM raw WHERE split_key % 100 = 7"
O["duplicate_report"] = f"""WITH {RAW}, {COPIES.format('raw')}, d AS (SELECT DISTINCT * FROM copies)
SELECT (SELECT count(*) FROM copies) AS rows_before, (SELECT count(*) FROM d) AS rows_after,
(SELECT count(*) FROM copies) - (SELECT count(*) FROM d) AS rows_removed"""
O["duplicate_summary"] = f"""WITH {RAW}, {COPIES.format('raw')}, d AS (SELECT DISTINCT * FROM copies),
n AS (SELECT (SELECT count(*) FROM copies) AS a, (SELECT count(*) FROM d) AS b)
SELECT a AS filas_totales, a - b AS duplicados_exactos, {percent("a - b", "a")} AS porcentaje_duplicados FROM n"""
O["drop_null_target"] = f"WITH {PATCHY} SELECT split_key, {TARGET} FROM patchy WHERE {TARGET} IS NOT NULL"
O["split_invalid_target"] = f"""WITH {PATCHY} SELECT split_key, {TARGET},
CASE WHEN {TARGET} <= 0 THEN 'removed' ELSE 'kept' END AS side FROM patchy"""
O["positive_target_only"] = f"WITH {PATCHY} SELECT split_key, {TARGET} FROM patchy WHERE {TARGET} > 0"
O["flag_suspicious"] = f"""WITH {PATCHY} SELECT split_key, {TARGET},
coalesce({TARGET} < 10, false) AS tiempo_sospechoso FROM patchy"""
O["suspicious_rows"] = f"""WITH {PATCHY} SELECT split_key, {TARGET}, true AS tiempo_sospechoso,
{TARGET} <= 0 AS target_invalido FROM patchy WHERE {TARGET} < 10"""
O["iqr_bounds"] = f"WITH {PATCHY} " + union(
    [
        f"SELECT '{c}' AS columna, {r(fences(c)[0])} AS limite_inferior, {r(fences(c)[1])} AS limite_superior FROM patchy"
        for c in NUMBERS
    ]
)


def clip(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN NULL ELSE least(greatest({c}, {c}_lo), {c}_hi) END"


def bounds_of(table: str, names: list[str]) -> str:
    cells = ", ".join(f"{fences(c)[0]} AS {c}_lo, {fences(c)[1]} AS {c}_hi" for c in names)
    return f"bounds AS (SELECT {cells} FROM {table})"


PER_KM = f"{PATCHY}, km AS (SELECT *, costo_envio / nullif(distancia_km, 0) AS costo_por_km FROM patchy)"
O["cap_outliers"] = f"""WITH {PER_KM}, {bounds_of("km", ["costo_por_km", TARGET])}
SELECT split_key, {r(clip("costo_por_km"), 11)} AS costo_por_km, {r(clip(TARGET), 11)} AS {TARGET} FROM km, bounds"""
O["outlier_rows"] = f"""WITH {PER_KM}, {bounds_of("km", ["costo_por_km"])}
SELECT split_key, costo_envio, distancia_km, costo_por_km FROM km, bounds
WHERE costo_por_km < costo_por_km_lo OR costo_por_km > costo_por_km_hi"""
O["inf_to_null"] = f"""WITH {RAW} SELECT split_key,
costo_envio / nullif(consumo_nafta, 0) AS costo_por_consumo FROM raw"""
O["select_xy"] = f"WITH {RAW} SELECT {listed(NUMERIC)}, {listed(CATEGORIES)}, {TARGET} FROM raw"
COLUMN_ROLES = {
    **dict.fromkeys(["split_key", *NUMBERS], ["numeric"]), **dict.fromkeys(CATEGORIES, ["categorical"]),
    "tiempo_sospechoso": ["boolean", "categorical"],
}
O["infer_roles"] = f"WITH {PATCHY}, f AS (SELECT *, coalesce({TARGET} < 10, false) AS tiempo_sospechoso FROM patchy) " + union(
    [f"SELECT '{role}' AS role, '{c}' AS columna, count({c}) AS presentes FROM f" for c, roles in COLUMN_ROLES.items() for role in roles]
)
O["profile_types"] = f"WITH {PATCHY} " + union(
    [
        f"SELECT '{c}' AS columna, '{'bigint' if c == 'split_key' else 'string' if c in CATEGORIES else 'double'}' AS dtype, "
        f"'{'categorica' if c in CATEGORIES else 'numerica'}' AS tipo_semantico, count({c}) AS presentes FROM patchy"
        for c in ["split_key", *NUMBERS, *CATEGORIES]
    ]
)
O["exclude_columns"] = """WITH e AS (SELECT *, 1 AS constante, value AS duracion, event_type AS clase FROM events),
s AS (SELECT 'event_id' AS columna, 'identificador_alta_unicidad' AS motivo,
  count(DISTINCT event_id) / greatest(count(event_id), 1) >= 0.9 AS hit FROM e
UNION ALL SELECT 'user_id', 'identificador_alta_unicidad', count(DISTINCT user_id) / greatest(count(user_id), 1) >= 0.9 FROM e
UNION ALL SELECT 'props', 'texto_libre_irrelevante',
  count(DISTINCT props) / greatest(count(props), 1) >= 0.8 AND avg(length(props)) >= 20 FROM e
UNION ALL SELECT 'event_type', 'texto_libre_irrelevante',
  count(DISTINCT event_type) / greatest(count(event_type), 1) >= 0.8 AND avg(length(event_type)) >= 20 FROM e
UNION ALL SELECT 'constante', 'columna_constante', count(DISTINCT constante) <= 1 FROM e
UNION ALL SELECT 'duracion', 'posible_fuga_de_datos', true
UNION ALL SELECT 'clase', 'columna_target', true)
SELECT columna, motivo FROM s WHERE hit"""
U = f"{PATCHY}, u AS (SELECT DISTINCT * FROM patchy), known AS (SELECT * FROM u WHERE {TARGET} IS NOT NULL)"
O["clean_regression"] = f"""WITH {U.replace(cleaned("id_bodega", True), cleaned("id_bodega"))}, {bounds_of("known", NUMBERS)}
SELECT split_key, {", ".join(f"{r(clip(c), 11)} AS {c}" for c in NUMBERS)}, {listed(CATEGORIES)} FROM known, bounds"""


def improved(source: dict[str, str]) -> str:
    hour = f"2 * pi() * ((({source['hora_despacho']} % 24) + 24) % 24) / 24.0"
    ratio = {n: f"{source[c]} / nullif({source['distancia_km']}, 0)" for n, c in {
        "costo_por_km": "costo_envio", "consumo_por_km": "consumo_nafta",
        "carga_por_km": "peso_carga_kg", "paradas_por_km": "paradas_previas"}.items()}
    texts = {n: f"coalesce({a}, 'desconocido') || '__' || coalesce({b}, 'desconocido')" for n, a, b in (
        ("trafico_clima", "trafico_nivel", "clima"), ("trafico_vehiculo", "trafico_nivel", "tipo_vehiculo"))}
    return ", ".join(
        [f"{r(f'sin({hour})', 11)} AS hora_sin", f"{r(f'cos({hour})', 11)} AS hora_cos"]
        + [f"{r(e, 11)} AS {n}" for n, e in ratio.items()] + [f"{e} AS {n}" for n, e in texts.items()]
    )


O["clean_improved"] = f"""WITH {PATCHY}, u AS (SELECT DISTINCT * FROM patchy), known AS (SELECT * FROM u WHERE {TARGET} > 0),
{bounds_of("known", NUMERIC)}, capped AS (SELECT split_key, {TARGET}, {", ".join(f"{clip(c)} AS {c}" for c in NUMERIC)},
{listed(CATEGORIES)} FROM known, bounds)
SELECT split_key, {r(TARGET, 11)} AS {TARGET}, {", ".join(f"{r(c, 11)} AS {c}" for c in NUMERIC)}, {listed(CATEGORIES)},
{improved({c: c for c in NUMERIC})} FROM capped"""
O["clean_prepared"] = f"""WITH {PATCHY} SELECT split_key, {", ".join(f"{r(c, 11)} AS {c}" for c in NUMBERS)},
{listed(CATEGORIES)}, {improved({c: c for c in NUMERIC})} FROM patchy WHERE {TARGET} > 0"""
O["clean_eda"] = f"""WITH {PATCHY}, u AS (SELECT DISTINCT * FROM patchy)
SELECT *, coalesce({TARGET} < 10, false) AS tiempo_sospechoso FROM u WHERE NOT coalesce({TARGET} <= 0, false)"""
O["clean_eda_counts"] = f"""WITH {PATCHY}, {COPIES.format('patchy')}, u AS (SELECT DISTINCT * FROM copies),
a AS (SELECT (SELECT count(*) FROM copies) AS n, (SELECT count(*) FROM u) AS m,
 (SELECT count(*) FROM u WHERE {TARGET} <= 0) AS bad,
 (SELECT count(*) FROM u WHERE {TARGET} > 0 AND {TARGET} < 10) AS short)
SELECT n AS rows_original, m AS rows_after_duplicates, m - bad AS rows_final, n - m AS duplicates_removed,
bad AS invalid_target_removed, short AS suspicious_time_count FROM a"""

# --- profiling --------------------------------------------------------------------

O["profile_overview"] = f"""WITH {RAW} SELECT count(*) AS filas, 12 AS columnas,
'distancia_km, peso_carga_kg, paradas_previas, experiencia_chofer_anios, hora_despacho, costo_envio, consumo_nafta, id_bodega, {TARGET}' AS columnas_numericas,
9 AS cantidad_numericas, 'trafico_nivel, clima, tipo_vehiculo' AS columnas_categoricas, 3 AS cantidad_categoricas,
'{TARGET}' AS target_detectado FROM raw"""
O["missing_report"] = f"WITH {PATCHY} " + union(
    [
        f"SELECT '{c}' AS columna, count(*) - count({c}) AS cantidad_nulos, "
        f"{percent(f'count(*) - count({c})', 'count(*)')} AS porcentaje_nulos FROM patchy"
        for c in ["split_key", *NUMBERS, *CATEGORIES]
    ]
)
O["value_counts"] = f"WITH {TIDY} " + union(
    [
        f"SELECT '{c}' AS columna, {c} AS categoria, count(*) AS cantidad, "
        f"{percent('count(*)', '(SELECT count(*) FROM tidy)')} AS porcentaje FROM tidy GROUP BY {c}"
        for c in CATEGORIES
    ]
)
O["numeric_summary"] = f"WITH {PATCHY} " + union(
    [
        f"""SELECT '{c}' AS columna, count({c}) AS "count", {r(f'avg({c})')} AS mean, {r(f'stddev_samp({c})')} AS std,
{r(f'min({c})')} AS min, {r(q(c, 0.25))} AS "25%", {r(q(c, 0.5))} AS "50%", {r(q(c, 0.75))} AS "75%", {r(f'max({c})')} AS max FROM patchy"""
        for c in NUMBERS
    ]
)
TARGET_STATS = {
    "min": f"min({TARGET})", "max": f"max({TARGET})", "media": f"avg({TARGET})",
    "mediana": q(TARGET, 0.5), "desviacion_estandar": f"stddev_samp({TARGET})",
    "q1": q(TARGET, 0.25), "q3": q(TARGET, 0.75), "iqr": f"{q(TARGET, 0.75)} - {q(TARGET, 0.25)}",
    "limite_inferior_iqr": fences(TARGET)[0], "limite_superior_iqr": fences(TARGET)[1],
    "registros_target_menor_igual_0": f"(count(*) FILTER (WHERE {TARGET} <= 0))::DOUBLE",
    "registros_target_menor_10": f"(count(*) FILTER (WHERE {TARGET} < 10))::DOUBLE",
}
O["target_summary"] = f"WITH {PATCHY} " + union(
    [f"SELECT '{k}' AS metrica, {r(v)} AS valor FROM patchy" for k, v in TARGET_STATS.items()]
)
O["outliers_iqr"] = f"WITH {PATCHY}, {bounds_of('patchy', NUMBERS)} " + union(
    [
        f"""SELECT '{c}' AS columna, {r(q(c, 0.25))} AS q1, {r(q(c, 0.75))} AS q3, {r(f"{q(c, 0.75)} - {q(c, 0.25)}")} AS iqr,
{r(f'any_value({c}_lo)')} AS limite_inferior, {r(f'any_value({c}_hi)')} AS limite_superior,
count(*) FILTER (WHERE {c} < {c}_lo OR {c} > {c}_hi) AS cantidad_outliers,
{percent(f"count(*) FILTER (WHERE {c} < {c}_lo OR {c} > {c}_hi)", "count(*)")} AS porcentaje_outliers FROM patchy, bounds"""
        for c in NUMBERS
    ]
)


def corr(a: str, b: str) -> str:
    both = f"FILTER (WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"
    return f"covar_pop({a}, {b}) / nullif(stddev_pop({a}) {both} * stddev_pop({b}) {both}, 0)"


O["corr_with_target"] = f"WITH {PATCHY}, k AS (SELECT *, 1.0::DOUBLE AS constante FROM patchy) " + union(
    [
        f"SELECT '{c}' AS columna, {r(corr(c, TARGET))} AS correlacion, {r(f'abs({corr(c, TARGET)})')} AS correlacion_absoluta FROM k"
        for c in [*NUMERIC, "constante"]
    ]
)
O["corr_matrix"] = f"WITH {PATCHY} " + union(
    [
        f"SELECT '{a}' AS columna_x, '{b}' AS columna_y, {r(corr(a, b))} AS correlacion FROM patchy"
        for a in NUMBERS for b in NUMBERS
    ]
)
RULES = {
    "distancia_km > 0": "distancia_km > 0", "peso_carga_kg > 0": "peso_carga_kg > 0",
    "paradas_previas >= 0": "paradas_previas >= 0",
    "experiencia_chofer_anios >= 0": "experiencia_chofer_anios >= 0",
    "hora_despacho entre 0 y 23": "hora_despacho BETWEEN 0 AND 23",
    "costo_envio > 0": "costo_envio > 0", "consumo_nafta > 0": "consumo_nafta > 0",
    f"{TARGET} > 0": f"{TARGET} > 0",
    "id_bodega dentro del rango observado":
        "try_cast(id_bodega AS DOUBLE) BETWEEN (SELECT min(try_cast(id_bodega AS DOUBLE)) FROM patchy) "
        "AND (SELECT max(try_cast(id_bodega AS DOUBLE)) FROM patchy)",
}
O["business_rules"] = f"WITH {PATCHY}, c AS (" + union(
    [
        f"SELECT '{name}' AS regla, count(*) FILTER (WHERE NOT coalesce({rule}, false)) AS bad, count(*) AS n FROM patchy"
        for name, rule in RULES.items()
    ]
) + f""") SELECT regla, bad AS cantidad_incumplimientos, {percent("bad", "n")} AS porcentaje_incumplimientos,
CASE WHEN bad = 0 THEN 'Sin accion correctiva' WHEN regla = '{TARGET} > 0' THEN 'Eliminar registros invalidos para dataset limpio'
ELSE 'Revisar con criterio de negocio antes de eliminar' END AS accion_recomendada FROM c"""
O["scaling_report"] = f"WITH {RAW} " + union(
    [
        f"SELECT '{c}' AS columna, {r(f'avg({c})')} AS media_antes, {r(f'stddev_pop({c})')} AS std_antes, "
        f"0.0::DOUBLE AS media_despues, 1.0::DOUBLE AS std_despues FROM raw"
        for c in NUMERIC
    ]
)
O["class_distribution"] = f"""WITH {TIDY} SELECT tipo_vehiculo, count(*) AS cantidad,
round_even(count(*)::DOUBLE / (SELECT count(*) FROM tidy), 4) AS proporcion FROM tidy GROUP BY tipo_vehiculo"""
O["histogram_bins"] = f"WITH {PATCHY} " + union(
    [
        f"""SELECT '{c}' AS columna, least(floor(({c} - lo) / (hi - lo) * 20) + 1, 20)::INTEGER AS bin, count(*) AS cantidad
FROM patchy, (SELECT min({c}) AS lo, max({c}) AS hi FROM patchy) e WHERE {c} IS NOT NULL GROUP BY 1, 2"""
        for c in ("distancia_km", "costo_envio", TARGET)
    ]
)


def boxes(source: str, group: str, value: str) -> str:
    low, high = fences("v")
    return f"""v AS (SELECT {group} AS categoria, {value} AS v FROM {source} WHERE {value} IS NOT NULL),
f AS (SELECT categoria, {q('v', 0.25)} AS q1, {q('v', 0.5)} AS mediana, {q('v', 0.75)} AS q3, {low} AS lo, {high} AS hi FROM v GROUP BY categoria)
SELECT v.categoria, count(*) AS n, {r('any_value(q1)')} AS q1, {r('any_value(mediana)')} AS mediana, {r('any_value(q3)')} AS q3,
{r('min(v) FILTER (WHERE v BETWEEN lo AND hi)')} AS bigote_inferior, {r('max(v) FILTER (WHERE v BETWEEN lo AND hi)')} AS bigote_superior,
count(*) FILTER (WHERE NOT v BETWEEN lo AND hi) AS atipicos
FROM v JOIN f ON v.categoria IS NOT DISTINCT FROM f.categoria GROUP BY v.categoria"""


O["box_stats"] = f"WITH {PATCHY}, {boxes('patchy', 'trafico_nivel', TARGET)}"
O["box_stats_column"] = f"WITH {PER_KM}, " + boxes("km", "'todos'", "costo_por_km")
O["scatter_points"] = f"""WITH {PATCHY} SELECT distancia_km AS x, {TARGET} AS y,
coalesce({TARGET} < 10, false) AS tiempo_sospechoso, coalesce({TARGET} <= 0, false) AS target_invalido FROM patchy"""
O["eda_bundle"] = f"""WITH {PATCHY} SELECT 'overview' AS tabla, 1::BIGINT AS filas
UNION ALL SELECT 'column_types', 12 UNION ALL SELECT 'missing_values', 12 UNION ALL SELECT 'duplicates', 1
UNION ALL SELECT 'categorical_counts', (SELECT count(*) FROM (SELECT DISTINCT trafico_nivel FROM patchy))
 + (SELECT count(*) FROM (SELECT DISTINCT clima FROM patchy)) + (SELECT count(*) FROM (SELECT DISTINCT tipo_vehiculo FROM patchy))
 + (SELECT count(*) FROM (SELECT DISTINCT id_bodega FROM patchy))
UNION ALL SELECT 'numeric_summary', 8 UNION ALL SELECT 'target_summary', 12 UNION ALL SELECT 'outliers_iqr', 8
UNION ALL SELECT 'business_rules', 9 UNION ALL SELECT 'suspicious_times', (SELECT count(*) FROM patchy WHERE {TARGET} < 10)"""

# --- features ---------------------------------------------------------------------

ANGLE = "2 * pi() * hora_despacho / 24.0"
KM = {"costo_por_km": "costo_envio", "consumo_por_km": "consumo_nafta", "carga_por_km": "peso_carga_kg", "paradas_por_km": "paradas_previas"}


def ratio(a: str, b: str) -> str:
    return f"{a} / nullif({b}, 0)"


def mark(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 1 ELSE 0 END"


def nan_join(a: str, b: str) -> str:
    return f"coalesce({a}, 'nan') || '_' || coalesce({b}, 'nan')"


PEAK = "hora_despacho BETWEEN 7 AND 9 OR hora_despacho BETWEEN 18 AND 21"
O["feat_cyclic_hour"] = f"WITH {PATCHY} SELECT split_key, {r(f'sin({ANGLE})')} AS hora_sin, {r(f'cos({ANGLE})')} AS hora_cos FROM patchy"
O["feat_ratios_km"] = f"WITH {PATCHY} SELECT split_key, " + ", ".join(
    f"{ratio(c, 'distancia_km')} AS {n}" for n, c in KM.items()) + " FROM patchy"
O["feat_logistics"] = f"""WITH {PATCHY}, m AS (SELECT median(paradas_previas) AS mp, median(peso_carga_kg) AS mw FROM patchy)
SELECT split_key, distancia_km / (paradas_previas + 1) AS distancia_por_parada, {ratio("costo_envio", "distancia_km")} AS costo_por_km,
{ratio("consumo_nafta", "distancia_km")} AS consumo_por_km, {mark(PEAK)} AS hora_punta, {mark("paradas_previas >= mp")} AS muchas_paradas,
{mark("peso_carga_kg >= mw")} AS carga_pesada, {nan_join("trafico_nivel", "clima")} AS trafico_clima FROM patchy, m"""
O["feat_precision"] = f"""WITH {PATCHY}, m AS (SELECT median(experiencia_chofer_anios) AS me FROM patchy)
SELECT split_key, {mark("hora_despacho BETWEEN 7 AND 9")} AS hora_punta_manana, {mark("hora_despacho BETWEEN 18 AND 21")} AS hora_punta_tarde,
{mark("hora_despacho >= 22 OR hora_despacho <= 6")} AS hora_nocturna, {r("distancia_km * (1 + 0.08 * paradas_previas)", 11)} AS distancia_total_ajustada,
{r(ratio("paradas_previas", "distancia_km"), 11)} AS paradas_por_km, {r(ratio("peso_carga_kg", "distancia_km"), 11)} AS peso_por_km,
{r("peso_carga_kg * distancia_km", 11)} AS carga_x_distancia, {mark("experiencia_chofer_anios >= me")} AS chofer_experto,
{r(ratio("costo_envio", "peso_carga_kg"), 11)} AS costo_por_kg, {r(ratio("consumo_nafta", "peso_carga_kg"), 11)} AS consumo_por_kg,
{nan_join("trafico_nivel", "tipo_vehiculo")} AS trafico_vehiculo, {nan_join("clima", "tipo_vehiculo")} AS clima_vehiculo FROM patchy, m"""
O["feat_error_focused"] = f"""WITH {PATCHY}, m AS (SELECT {q("distancia_km", 0.75)} AS dh, {q("distancia_km", 0.25)} AS dl,
{q("peso_carga_kg", 0.75)} AS wh, {q("paradas_previas", 0.75)} AS ph FROM patchy),
b AS (SELECT split_key, {mark("tipo_vehiculo = 'camion'")} AS es_camion, {mark("tipo_vehiculo = 'moto'")} AS es_moto,
{mark("trafico_nivel = 'alto'")} AS trafico_alto, {mark("trafico_nivel = 'bajo'")} AS trafico_bajo, {mark(PEAK)} AS hora_punta,
{mark("distancia_km >= dh")} AS distancia_larga, {mark("distancia_km <= dl")} AS distancia_corta, {mark("peso_carga_kg >= wh")} AS carga_pesada,
{mark("paradas_previas >= ph")} AS muchas_paradas, {mark("id_bodega = '1'")} AS bodega_1, {mark("id_bodega = '4'")} AS bodega_4,
{mark("id_bodega IN ('1', '4')")} AS bodega_problematico FROM patchy, m)
SELECT *, es_camion * trafico_alto AS camion_trafico_alto, es_camion * carga_pesada AS camion_carga_pesada,
trafico_alto * hora_punta AS trafico_alto_hora_punta, distancia_larga * muchas_paradas AS distancia_larga_muchas_paradas,
bodega_problematico * trafico_alto AS bodega_problematico_trafico_alto FROM b"""
O["feat_improved"] = f"WITH {PATCHY} SELECT split_key, {improved({c: c for c in NUMERIC})} FROM patchy"
O["feat_exploratory"] = f"""WITH {RAW} SELECT split_key, {", ".join(f"{r(c, 11)} AS {c}" for c in NUMBERS)}, {listed(TEXTS)},
CAST(id_bodega AS VARCHAR) AS id_bodega, {r(f'sin({ANGLE})', 11)} AS hora_sin, {r(f'cos({ANGLE})', 11)} AS hora_cos,
""" + ", ".join(f"{r(ratio(c, 'distancia_km'), 11)} AS {n}" for n, c in KM.items()) + " FROM raw"
CATALOG = {
    "hora_sin": ("Ciclica", "Usar junto a hora_cos para respetar periodicidad diaria.", "hora_despacho"),
    "hora_cos": ("Ciclica", "Complementa hora_sin para capturar comportamiento horario.", "hora_despacho"),
    "costo_por_km": ("Ratio", "Aproxima intensidad de costo por unidad de distancia.", ratio("costo_envio", "distancia_km")),
    "consumo_por_km": ("Ratio", "Puede capturar eficiencia de ruta y vehiculo.", ratio("consumo_nafta", "distancia_km")),
    "carga_por_km": ("Ratio", "Relaciona exigencia de carga con distancia recorrida.", ratio("peso_carga_kg", "distancia_km")),
    "paradas_por_km": ("Ratio", "Representa densidad de paradas por trayecto.", ratio("paradas_previas", "distancia_km")),
    "consumo_nafta": ("Riesgo de leakage", "Comparar modelos con y sin esta variable por posible fuga.", "consumo_nafta"),
}
O["feature_catalog"] = f"WITH {TIDY} " + union(
    [
        f"SELECT '{f}' AS feature, '{t}' AS tipo_transformacion, '{d}' AS recomendacion, count({e}) AS presentes FROM tidy"
        for f, (t, d, e) in CATALOG.items()
    ]
)
O["text_normalize"] = """SELECT doc_id,
lower(trim(regexp_replace(strip_accents(coalesce(text || ' Crítico Ñandú' || chr(9) || source, '')), '^\\s+|\\s+$', '', 'g'))) AS clave FROM documents"""

# The hashed key of splits (first eight digits) and folds (next eight).
def hashed(key: str, at: int = 1) -> str:
    return f"CAST(('0x' || substr(md5(CAST({key} AS VARCHAR)), {at}, 8)) AS BIGINT)"


IN_TEST = f"{hashed('split_key')} % 10000 < 2000"

# --- labels, ranks, groups, joins ----------------------------------------------------

TRAIN_CUTS = f"""cuts AS (SELECT quantile_cont({TARGET}, 1.0::DOUBLE / 3) AS q33, quantile_cont({TARGET}, 2.0::DOUBLE / 3) AS q66
FROM patchy WHERE split_key % 10 >= 2 AND {TARGET} > 0)"""
CLASS = "CASE WHEN {0} IS NULL THEN 'normal' WHEN {0} <= q33 THEN 'rapida' WHEN {0} <= q66 THEN 'normal' ELSE 'tardia' END"
O["tercile_thresholds"] = f"WITH {PATCHY}, {TRAIN_CUTS} SELECT {r('q33')} AS q33, {r('q66')} AS q66 FROM cuts"
O["tercile_label"] = f"""WITH {PATCHY}, {TRAIN_CUTS} SELECT split_key, {TARGET},
{CLASS.format(TARGET)} AS categoria_entrega FROM patchy, cuts"""


def timed(source: str) -> str:
    return f"""cuts AS (SELECT quantile_cont({TARGET}, 1.0::DOUBLE / 3) AS q33, quantile_cont({TARGET}, 2.0::DOUBLE / 3) AS q66 FROM {source} WHERE {TARGET} > 0),
timed AS (SELECT s.*, {CLASS.format(f"(CASE WHEN {TARGET} > 0 THEN {TARGET} END)")} AS categoria_entrega FROM {source} s, cuts)"""


O["tercile_global"] = f"""WITH {PATCHY}, {timed("patchy")} SELECT categoria_entrega, count(*) AS cantidad,
round_even(count(*)::DOUBLE / (SELECT count(*) FROM timed), 4) AS proporcion FROM timed GROUP BY categoria_entrega"""


def pct_rank(c: str) -> str:
    return (f"CASE WHEN {c} IS NULL THEN NULL ELSE ((rank() OVER (ORDER BY {c} NULLS LAST)) - 1"
            f" + ((count(*) OVER (PARTITION BY {c})) + 1) / 2.0::DOUBLE) / (count({c}) OVER ()) END")


O["rank_percent"] = f"""WITH {PATCHY} SELECT split_key, {r(pct_rank("costo_envio"), 9)} AS costo_rank,
{r(f"1 - ({pct_rank('experiencia_chofer_anios')})", 9)} AS experiencia_rank FROM patchy"""
RISK_MAPS = {
    "trafico_nivel": {"bajo": 0.1, "medio": 0.5, "alto": 0.8, "critico": 1.0},
    "clima": {"soleado": 0.1, "nublado": 0.4, "lluvia": 0.8},
    "tipo_vehiculo": {"moto": 0.2, "van": 0.5, "camion": 0.8},
}


def risk_of(c: str) -> str:
    cases = " ".join(f"WHEN '{k}' THEN {v}::DOUBLE" for k, v in RISK_MAPS[c].items())
    return f"CASE lower(trim({c})) {cases} END"


RISK_PARTS = [pct_rank(c) for c in ("distancia_km", "paradas_previas", "peso_carga_kg", "costo_envio", "consumo_nafta")] + [
    f"1 - ({pct_rank('experiencia_chofer_anios')})",
    "CASE WHEN hora_despacho IS NULL THEN NULL WHEN hora_despacho BETWEEN 0 AND 5 THEN 0.6::DOUBLE "
    "WHEN hora_despacho BETWEEN 7 AND 10 OR hora_despacho BETWEEN 17 AND 20 THEN 1.0::DOUBLE ELSE 0.4::DOUBLE END",
    *[risk_of(c) for c in RISK_MAPS],
]
O["risk_score"] = f"""WITH {RAW}, holes AS (SELECT split_key, {listed(TEXTS)},
{listed(NUMERIC, "CASE WHEN split_key % 13 = 0 THEN NULL ELSE {} END AS {}")} FROM raw),
parts AS (SELECT split_key, {", ".join(f"{p} AS c{i}" for i, p in enumerate(RISK_PARTS))} FROM holes),
means AS (SELECT split_key, ({" + ".join(f"coalesce(c{i}, 0)" for i in range(len(RISK_PARTS)))})
 / nullif({" + ".join(f"(c{i} IS NOT NULL)::INT" for i in range(len(RISK_PARTS)))}, 0) AS m FROM parts),
filled AS (SELECT split_key, coalesce(m, (SELECT median(m) FROM means), 0.5) AS s FROM means),
cuts AS (SELECT quantile_cont(s, 1.0::DOUBLE / 3) AS q33, quantile_cont(s, 2.0::DOUBLE / 3) AS q66 FROM filled)
SELECT split_key, round_even(s, 4) AS riesgo_logistico, {CLASS.format("s")} AS categoria_entrega FROM filled, cuts"""
O["alias_resolve"] = f"WITH {RAW} SELECT 'delivery_time' AS columna, {r(f'avg({TARGET})')} AS media FROM raw"
GROUPS = ["id_bodega", "tipo_vehiculo", "trafico_nivel"]
O["group_mean_encode"] = f"""WITH {PATCHY}, tr AS (SELECT * FROM patchy WHERE split_key % 10 >= 2), g AS (SELECT avg({TARGET}) AS g FROM tr),
{", ".join(f"m_{c} AS (SELECT {c}, avg({TARGET}) AS m FROM tr WHERE {c} IS NOT NULL GROUP BY {c})" for c in GROUPS)}
SELECT split_key, {", ".join(r(f"coalesce(m_{c}.m, g.g)") + f" AS hist_mean_target_by_{c}" for c in GROUPS)}
FROM patchy p CROSS JOIN g {" ".join(f"LEFT JOIN m_{c} ON p.{c} = m_{c}.{c}" for c in GROUPS)}"""
O["group_mean_out_of_fold"] = f"""WITH {PATCHY}, f AS (SELECT *, ({hashed('split_key', 9)} % 5)::INTEGER AS fold FROM patchy),
k AS (SELECT trafico_nivel, fold, sum({TARGET}) AS s, count({TARGET}) AS n FROM f WHERE {TARGET} IS NOT NULL GROUP BY ALL),
t AS (SELECT trafico_nivel, sum(s) AS ts, sum(n) AS tn FROM k GROUP BY trafico_nivel)
SELECT split_key, f.fold, {r(f"coalesce((ts - s) / nullif(tn - n, 0), (SELECT avg({TARGET}) FROM f))")} AS hist_mean_target_by_trafico_nivel
FROM f LEFT JOIN k ON f.trafico_nivel = k.trafico_nivel AND f.fold = k.fold LEFT JOIN t ON f.trafico_nivel = t.trafico_nivel"""


def acc(t: int) -> str:
    return f"avg(CASE WHEN error_absoluto <= {t} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) * 100"


ACC = "acc AS (SELECT model, " + ", ".join(f"{acc(t)} AS acc_{t}_min" for t in (5, 10, 15, 20)) + " FROM errs GROUP BY model)"
SHOW_ACC = ", ".join(f"{r(f'acc_{t}_min')} AS acc_{t}_min" for t in (5, 10, 15, 20))
FULL = f"""full_metrics AS (SELECT m.*, e.mean_error, e.median_absolute_error, e.p90_absolute_error,
{", ".join(f"a.acc_{t}_min" for t in (5, 10, 15, 20))} FROM metrics m JOIN acc a USING (model) JOIN
(SELECT model, avg(error) AS mean_error, median(error_absoluto) AS median_absolute_error,
 quantile_cont(error_absoluto, 0.9) AS p90_absolute_error FROM errs GROUP BY model) e USING (model))"""
SHOW_FULL = f"""model, {SHOW_METRICS}, {r('mean_error')} AS mean_error, {r('median_absolute_error')} AS median_absolute_error,
{r('p90_absolute_error')} AS p90_absolute_error, {SHOW_ACC}"""
SCORED = f"{PREDS}, {METRICS}, {ACC}, {FULL}"
O["join_metrics"] = f"""WITH {SCORED} SELECT model, {SHOW_METRICS}, {SHOW_ACC} FROM metrics
LEFT JOIN (SELECT * FROM acc WHERE model <> 'constant') a USING (model)"""
O["pivot_tolerance"] = f"WITH {SCORED} SELECT model, {SHOW_ACC} FROM acc"
O["union_tables"] = f"""WITH {SCORED} SELECT model, {SHOW_METRICS}, NULL::DOUBLE AS accuracy_percent FROM metrics
UNION ALL SELECT model, NULL, NULL, NULL, {r('acc_10_min')} FROM acc"""
O["dedupe_by_key"] = f"WITH {SCORED} SELECT model, {SHOW_METRICS} FROM metrics"
SEGMENTS = ["trafico_nivel", "clima", "tipo_vehiculo", "id_bodega", "hora_punta", "distancia_larga", "carga_pesada", "muchas_paradas"]


def marked(model: str) -> str:
    return f"""(SELECT e.*, CASE WHEN predicho > real THEN 1 ELSE 0 END AS es_sobreestimacion,
CASE WHEN predicho < real THEN 1 ELSE 0 END AS es_subestimacion, {mark(PEAK)} AS hora_punta,
{mark("distancia_km >= (SELECT quantile_cont(distancia_km, 0.75) FROM errs WHERE model = '" + model + "')")} AS distancia_larga,
{mark("peso_carga_kg >= (SELECT quantile_cont(peso_carga_kg, 0.75) FROM errs WHERE model = '" + model + "')")} AS carga_pesada,
{mark("paradas_previas >= (SELECT quantile_cont(paradas_previas, 0.75) FROM errs WHERE model = '" + model + "')")} AS muchas_paradas
FROM errs e WHERE model = '{model}')"""


def segments(name: str, model: str) -> str:
    rows = union(
        [
            f"""SELECT '{c}' AS segment_column, CAST({c} AS VARCHAR) AS segment_value, count(*) AS n, avg(error_absoluto) AS MAE,
sqrt(avg(error * error)) AS RMSE, avg(error) AS mean_error, median(error) AS median_error, median(error_absoluto) AS median_absolute_error,
max(error_absoluto) AS max_error, avg(es_sobreestimacion) * 100 AS overestimation_rate, avg(es_subestimacion) * 100 AS underestimation_rate
FROM {name}_rows GROUP BY {c}"""
            for c in SEGMENTS
        ]
    )
    return f"{name}_rows AS {marked(model)}, {name} AS ({rows})"


SEGMENT_NUMBERS = ["MAE", "RMSE", "mean_error", "median_error", "median_absolute_error", "max_error", "overestimation_rate", "underestimation_rate"]
SHOW_SEGMENTS = "segment_column, segment_value, n, " + ", ".join(f"{r(c)} AS {c}" for c in SEGMENT_NUMBERS)
SEG = f"WITH {PREDS}, {segments('seg', 'stops')}"
O["segment_metrics"] = f"{SEG} SELECT {SHOW_SEGMENTS} FROM seg"
O["top_n"] = f"{SEG} SELECT {SHOW_SEGMENTS} FROM seg ORDER BY seg.MAE DESC, segment_column, segment_value LIMIT 5"
O["problem_segments"] = f"{SEG} SELECT {SHOW_SEGMENTS} FROM seg WHERE n >= 300 ORDER BY seg.MAE DESC, segment_column, segment_value LIMIT 8"
O["segment_labels"] = f"""{SEG} SELECT segment_column || '=' || coalesce(segment_value, 'nan') AS segment_label, n, {r('MAE')} AS MAE
FROM seg WHERE n >= 10 ORDER BY seg.MAE DESC, seg.RMSE DESC, segment_column, segment_value LIMIT 15"""
WANTED = ", ".join(f"('{c}', '{v}')" for c, v in (
    ("tipo_vehiculo", "camion"), ("trafico_nivel", "alto"), ("trafico_nivel", "bajo"), ("id_bodega", "1"),
    ("id_bodega", "4"), ("distancia_larga", "1"), ("carga_pesada", "1"), ("muchas_paradas", "1")))
O["segment_comparison"] = f"""WITH {PREDS}, {segments('old', 'distance')}, {segments('new', 'stops')},
wanted(segment_column, segment_value) AS (VALUES {WANTED})
SELECT segment_column, segment_value, coalesce(new.n, old.n) AS n, {r('old.MAE')} AS baseline_MAE, {r('new.MAE')} AS new_MAE,
{r('new.MAE - old.MAE')} AS delta_MAE, coalesce(new.MAE < old.MAE, false) AS improved
FROM wanted LEFT JOIN old USING (segment_column, segment_value) LEFT JOIN new USING (segment_column, segment_value)"""
O["rank_models"] = f"WITH {SCORED} SELECT model, {SHOW_METRICS} FROM metrics ORDER BY metrics.RMSE, metrics.MAE, metrics.R2 DESC LIMIT 1"
O["rank_models_operational"] = f"""WITH {SCORED} SELECT model, {SHOW_METRICS}, {r('acc_10_min')} AS acc_10_min FROM metrics m LEFT JOIN acc a USING (model)
ORDER BY a.acc_10_min DESC, m.RMSE, m.MAE, m.R2 DESC LIMIT 1"""
O["rank_models_precision"] = f"""WITH {SCORED} SELECT model, {SHOW_METRICS}, {SHOW_ACC} FROM metrics m LEFT JOIN acc a USING (model)
ORDER BY m.MAE, m.RMSE, m.R2 DESC LIMIT 1"""
O["rank_models_balanced"] = f"""WITH {SCORED}, el AS (SELECT * FROM full_metrics WHERE acc_10_min >= 52.5 - 2 OR (MAE <= 11.4711 - 0.2 AND RMSE <= 14.5709 - 0.2)),
pool AS (SELECT * FROM el UNION ALL SELECT * FROM full_metrics WHERE (SELECT count(*) FROM el) = 0)
SELECT {SHOW_FULL} FROM pool ORDER BY pool.MAE, pool.RMSE, pool.R2 DESC LIMIT 1"""

# --- splitting and preprocessing -------------------------------------------------------

O["split_random"] = f"""WITH {RAW} SELECT CASE WHEN {IN_TEST} THEN 'test' ELSE 'train' END AS split, clima, count(*) AS n
FROM raw GROUP BY ALL"""
# Test rows per class {0} of table {1}: whole parts, the rest to the largest remainders.
QUOTAS = """c AS (SELECT {0} AS class, count(*) AS n FROM {1} GROUP BY 1),
parts AS (SELECT class, n, floor(n * 0.2::DOUBLE + 1e-9) AS whole, n * 0.2::DOUBLE - floor(n * 0.2::DOUBLE + 1e-9) AS rest FROM c),
quotas AS (SELECT class, n, (whole + CASE WHEN row_number() OVER (ORDER BY rest DESC, class)
  <= (SELECT ceil(sum(n) * 0.2::DOUBLE - 1e-9) - sum(whole) FROM parts) THEN 1 ELSE 0 END)::BIGINT AS quota FROM parts)"""
O["split_stratified"] = f"""WITH o AS (SELECT event_id, event_type,
row_number() OVER (PARTITION BY event_type ORDER BY {hashed("event_id")} % 4096, event_id) AS k FROM events),
{QUOTAS.format("event_type", "events")}
SELECT event_id, event_type, CASE WHEN k <= quota THEN 'test' ELSE 'train' END AS split FROM o JOIN quotas ON class = event_type"""
O["split_then_label"] = f"""WITH {PATCHY}, {TRAIN_CUTS.replace("split_key % 10 >= 2", f"NOT ({IN_TEST})")}, l AS (SELECT CASE WHEN {IN_TEST} THEN 'test' ELSE 'train' END AS split,
{CLASS.format(f"(CASE WHEN {TARGET} > 0 THEN {TARGET} END)")} AS categoria_entrega FROM patchy, cuts)
SELECT split, categoria_entrega, count(*) AS n FROM l GROUP BY ALL"""
O["prepare_classification"] = f"""WITH {TIDY}, {timed("tidy")}, {QUOTAS.format("categoria_entrega", "timed")}
SELECT 'test' AS split, class AS categoria_entrega, quota AS n FROM quotas
UNION ALL SELECT 'train', class, n - quota FROM quotas"""
O["kfold_assign"] = f"""WITH {TIDY}, {timed("tidy")} SELECT ({hashed('split_key', 9)} % 5)::INTEGER AS fold, categoria_entrega, count(*) AS n
FROM timed GROUP BY ALL"""
MODES = {c: f"(SELECT {c} FROM tr WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)" for c in CATEGORIES}
O["impute"] = f"""WITH {PATCHY}, tr AS (SELECT * FROM patchy WHERE split_key % 10 >= 2),
m AS (SELECT {listed(NUMERIC, "median({}) AS {}")} FROM tr)
SELECT split_key, {", ".join(f"coalesce(p.{c}, m.{c}) AS {c}" for c in NUMERIC)},
{", ".join(f"coalesce(p.{c}, {MODES[c]}) AS {c}" for c in CATEGORIES)} FROM patchy p, m"""
O["scale_standard"] = f"""WITH {TIDY}, tr AS (SELECT * FROM tidy WHERE split_key % 10 >= 2),
m AS (SELECT {listed(NUMERIC, "avg({}) AS a_{}, stddev_pop({}) AS s_{}")} FROM tr)
SELECT split_key, {", ".join(r(f"({c} - a_{c}) / s_{c}") + f" AS {c}" for c in NUMERIC)}, 0.0::DOUBLE AS constante FROM tidy, m"""
HOT = {"trafico_nivel": ["alto", "bajo", "medio"], "clima": ["lluvia", "nublado", "soleado"]}
O["one_hot"] = f"WITH {TIDY} SELECT split_key, " + ", ".join(
    f"CASE WHEN {c} = '{v}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS {c}_{v}" for c, vs in HOT.items() for v in vs) + " FROM tidy"

# --- scoring ----------------------------------------------------------------------------

O["reg_metrics"] = f"WITH {SCORED} SELECT model, {SHOW_METRICS} FROM metrics"
O["reg_metrics_full"] = f"WITH {SCORED} SELECT {SHOW_FULL} FROM full_metrics"
TOLERANCES = "(VALUES (5), (10), (15), (20)) t(tolerance_minutes)"
O["tolerance_accuracy"] = f"""WITH {PREDS}, h AS (SELECT model, tolerance_minutes, count(*) FILTER (WHERE error_absoluto <= tolerance_minutes) AS hit_count,
count(*) AS total_count FROM errs, {TOLERANCES} GROUP BY ALL)
SELECT *, {r("hit_count::DOUBLE / total_count")} AS accuracy, {r("hit_count::DOUBLE / total_count * 100")} AS accuracy_percent FROM h"""
O["tolerance_hits"] = f"""WITH {PREDS}, h AS (SELECT tolerance_minutes, count(*) FILTER (WHERE error_absoluto <= tolerance_minutes) AS hit_count,
count(*) AS total_count FROM errs, {TOLERANCES} WHERE model = 'distance' AND tolerance_minutes < 20 GROUP BY ALL)
SELECT *, round_even(hit_count::DOUBLE / total_count * 100, 4) AS accuracy_percent FROM h"""
O["tolerance_scorer"] = f"""WITH {PREDS} SELECT {r("avg(CASE WHEN error_absoluto <= 10 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)")} AS acierto
FROM errs WHERE model = 'distance'"""
O["prediction_errors"] = f"WITH {PREDS} SELECT split_key, model, real, predicho, error, error_absoluto FROM errs"
O["error_direction"] = f"""WITH {PREDS} SELECT split_key, model, {mark("predicho > real")} AS es_sobreestimacion, {mark("predicho < real")} AS es_subestimacion,
CASE WHEN error > 0 THEN 'subestimacion' WHEN error < 0 THEN 'sobreestimacion' ELSE 'sin_error' END AS direccion_error FROM errs"""
O["error_segments"] = f"WITH {PREDS}, s AS {marked('stops')} SELECT split_key, hora_punta, distancia_larga, carga_pesada, muchas_paradas FROM s"
O["compare_versions"] = f"""WITH {SCORED} SELECT 'base' AS version, model, {SHOW_METRICS} FROM metrics WHERE model = 'distance'
UNION ALL SELECT 'tuned', model, {SHOW_METRICS} FROM metrics WHERE model = 'stops'"""
SHOW_ACC3 = ", ".join(f"{r(f'acc_{t}_min')} AS acc_{t}_min" for t in (5, 10, 15))
O["current_vs_improved"] = f"""WITH {SCORED} SELECT 'current_optimized' AS version, 11.59::DOUBLE AS MAE, 14.58::DOUBLE AS RMSE, 0.029::DOUBLE AS R2,
28.33::DOUBLE AS acc_5_min, 49.58::DOUBLE AS acc_10_min, 70.0::DOUBLE AS acc_15_min
UNION ALL SELECT 'improved_experiment', {SHOW_METRICS}, {SHOW_ACC3} FROM metrics JOIN acc USING (model) WHERE model = 'stops'"""
O["version_deltas"] = f"""WITH {SCORED}, v AS (SELECT 'current_balanced_model' AS version, 'GradientBoostingRegressor' AS model, 11.4711::DOUBLE AS MAE,
14.5709::DOUBLE AS RMSE, 0.0307::DOUBLE AS R2, 29.17::DOUBLE AS acc_5_min, 52.5::DOUBLE AS acc_10_min, 70.42::DOUBLE AS acc_15_min, NULL::DOUBLE AS p90_absolute_error
UNION ALL SELECT 'best_error_focused_model', model, MAE, RMSE, R2, acc_5_min, acc_10_min, acc_15_min, p90_absolute_error FROM full_metrics WHERE model = 'stops')
SELECT version, model, {SHOW_METRICS}, {SHOW_ACC3}, {r('p90_absolute_error')} AS p90_absolute_error, {r('MAE - 11.4711')} AS delta_MAE,
{r('RMSE - 14.5709')} AS delta_RMSE, {r('R2 - 0.0307')} AS delta_R2, {r('acc_10_min - 52.5')} AS delta_acc_10_min,
CASE WHEN version = 'current_balanced_model' THEN 'baseline'
WHEN v.MAE < 11.4711 AND v.RMSE < 14.5709 AND v.R2 >= 0.0307 AND v.acc_10_min >= 51.5 THEN 'usar modelo nuevo'
WHEN v.MAE <= 11.4711 AND v.RMSE <= 14.5709 AND v.acc_10_min >= 50.5 THEN 'modelo nuevo util para analisis, evaluar antes de reemplazar'
ELSE 'mantener modelo actual' END AS decision FROM v"""
O["tolerance_versions"] = f"""WITH {PREDS} SELECT * FROM (VALUES ('current_optimized', 5, 28.33::DOUBLE), ('current_optimized', 10, 49.58::DOUBLE),
('current_optimized', 15, 70.0::DOUBLE)) b(model, tolerance_minutes, accuracy_percent)
UNION ALL SELECT model, tolerance_minutes, {r("(count(*) FILTER (WHERE error_absoluto <= tolerance_minutes))::DOUBLE / count(*) * 100")}
FROM errs, {TOLERANCES} WHERE model = 'stops' GROUP BY model, tolerance_minutes"""
O["decision_notes"] = f"""WITH {SCORED} SELECT model, CASE WHEN model = 'constant' THEN 'baseline' ELSE
CASE WHEN MAE < 11.59 THEN 'MAE mejor que tecnico' ELSE 'MAE no mejora tecnico' END || ' | ' ||
CASE WHEN RMSE < 14.58 THEN 'RMSE mejor que tecnico' ELSE 'RMSE no mejora tecnico' END || ' | ' ||
CASE WHEN R2 > 0.029 THEN 'R2 mejor que tecnico' ELSE 'R2 no mejora tecnico' END || ' | ' ||
CASE WHEN acc_10_min >= 55.0 THEN 'mantiene/mejora acc_10 operacional' ELSE 'pierde acc_10 operacional' END END AS decision_notes,
CASE WHEN MAE < 11.59 AND RMSE < 14.58 AND R2 > 0.029 THEN 'Mejoro la estimacion exacta del tiempo de entrega.'
WHEN MAE < 11.59 OR RMSE < 14.58 THEN CASE WHEN acc_10_min < 55.0 THEN 'Mejoro tecnicamente pero perdio acierto operacional.'
ELSE 'Mejoro tecnicamente y mantuvo/mejoro acierto operacional relevante.' END
WHEN acc_10_min >= 55.0 THEN 'Mejoro operacionalmente pero no tecnicamente.'
ELSE 'Empeoro respecto a modelos anteriores para precision y operacion.' END AS conclusion,
CASE WHEN acc_10_min > 49.58 THEN 'El modelo mejoro operacionalmente porque aumento el acierto dentro de +/-10 minutos.'
WHEN RMSE < 14.58 THEN 'El modelo mejoro tecnicamente, pero no mejoro el criterio operacional principal.'
ELSE 'Las mejoras probadas no superaron el modelo actual. Se recomienda mantener el modelo anterior.' END AS conclusion_operacional FROM full_metrics"""
O["choose_final"] = f"""WITH {SCORED}, two AS (SELECT * FROM full_metrics WHERE model IN ('distance', 'stops')),
a AS (SELECT model, RMSE FROM two ORDER BY RMSE, MAE, R2 DESC LIMIT 1), b AS (SELECT model, RMSE FROM two ORDER BY acc_10_min DESC, RMSE, MAE, R2 DESC LIMIT 1)
SELECT CASE model WHEN 'distance' THEN 'base' ELSE 'tuned' END AS version, model, {r('RMSE')} AS RMSE FROM a
UNION ALL SELECT CASE model WHEN 'stops' THEN 'base' ELSE 'tuned' END, model, {r('RMSE')} FROM b"""
CLS = f"{TIDY}, {timed('tidy')}, cp AS (" + union(
    [
        f"""SELECT '{m}' AS model, categoria_entrega AS real, CASE WHEN {c} <= {lo} THEN 'rapida' WHEN {c} <= {hi} THEN 'normal' ELSE 'tardia' END AS predicho
FROM timed WHERE split_key % 10 < 2"""
        for m, (c, lo, hi) in CLASSIFIERS.items()
    ]
) + """), names AS (SELECT model, real AS clase FROM cp UNION SELECT model, predicho FROM cp),
per AS (SELECT model, clase, (SELECT count(*) FROM cp WHERE cp.model = n.model AND real = clase AND predicho = clase) AS hits,
(SELECT count(*) FROM cp WHERE cp.model = n.model AND real = clase) AS support,
(SELECT count(*) FROM cp WHERE cp.model = n.model AND predicho = clase) AS predicted FROM names n),
per2 AS (SELECT *, coalesce(hits::DOUBLE / nullif(predicted, 0), 0) AS precision, coalesce(hits::DOUBLE / nullif(support, 0), 0) AS recall,
coalesce(2.0 * hits::DOUBLE / nullif(predicted + support, 0), 0) AS f1 FROM per)"""
CLS_SUMS = ", ".join(
    [r("sum(hits)::DOUBLE / sum(support)") + " AS accuracy"]
    + [r(f"avg({m})") + f" AS {m}_macro" for m in ("precision", "recall", "f1")]
    + [r(f"sum({m} * support) / sum(support)") + f" AS {m}_weighted" for m in ("precision", "recall", "f1")]
)
O["cls_metrics"] = f"WITH {CLS} SELECT model, {CLS_SUMS} FROM per2 GROUP BY model"
O["rank_classifiers"] = f"WITH {CLS} SELECT model, {CLS_SUMS} FROM per2 GROUP BY model ORDER BY avg(f1) DESC LIMIT 1"
O["confusion_matrix"] = f"""WITH {CLS} SELECT 'actual_' || real AS actual, {", ".join(f"count(*) FILTER (WHERE predicho = '{x}') AS pred_{x}" for x in ("normal", "rapida", "tardia"))}
FROM cp WHERE model = 'by_distance' GROUP BY real"""
THREE = ["precision", "recall", "f1"]
O["cls_report"] = f"""WITH {CLS}, p AS (SELECT * FROM per2 WHERE model = 'by_distance')
SELECT clase AS fila, {", ".join(f"{r(m)} AS {m}" for m in THREE)}, support::DOUBLE AS support FROM p
UNION ALL SELECT 'accuracy', {", ".join([r("sum(hits)::DOUBLE / sum(support)")] * 4)} FROM p
UNION ALL SELECT 'macro avg', {", ".join(r(f"avg({m})") for m in THREE)}, sum(support)::DOUBLE FROM p
UNION ALL SELECT 'weighted avg', {", ".join(r(f"sum({m} * support) / sum(support)") for m in THREE)}, sum(support)::DOUBLE FROM p"""

# --- models with a plain SQL form -----------------------------------------------------------

SPLIT = f"{TIDY}, tr AS (SELECT * FROM tidy WHERE NOT ({IN_TEST})), te AS (SELECT * FROM tidy WHERE {IN_TEST})"
O["reg_mean_baseline"] = f"""WITH {SPLIT}, preds AS (SELECT 'mean_baseline' AS model, {TARGET} AS real, (SELECT avg({TARGET}) FROM tr) AS predicho FROM te),
{METRICS} SELECT model, {SHOW_METRICS} FROM metrics"""
FIT = "(SELECT regr_slope({0}, {1}) AS a, regr_intercept({0}, {1}) AS b FROM {2})"
O["reg_linear"] = f"""WITH {SPLIT}, f AS {FIT.format(TARGET, "distancia_km", "tr")}
SELECT split_key, {r("a * distancia_km + b", 4)} AS prediction FROM te, f"""
O["reg_log_target"] = f"""WITH {SPLIT}, f AS {FIT.format(f"ln(1 + {TARGET})", "distancia_km", f"tr WHERE {TARGET} > 0")}
SELECT split_key, {r("exp(a * distancia_km + b) - 1", 4)} AS prediction FROM te, f"""
O["reg_residual_correction"] = f"""WITH {SPLIT}, f AS {FIT.format(TARGET, "distancia_km", "tr")},
left_over AS (SELECT paradas_previas, {TARGET} - (a * distancia_km + b) AS e FROM tr, f),
g AS (SELECT regr_slope(e, paradas_previas) AS c, regr_intercept(e, paradas_previas) AS d FROM left_over)
SELECT split_key, {r("a * distancia_km + b + c * paradas_previas + d", 4)} AS prediction FROM te, f, g"""
O["reg_ridge_line"] = f"""WITH {SPLIT}, f AS (SELECT covar_pop({TARGET}, distancia_km) * count(*) / (var_pop(distancia_km) * count(*) + 1000) AS a,
avg({TARGET}) AS y, avg(distancia_km) AS x FROM tr)
SELECT split_key, {r("y + a * (distancia_km - x)", 4)} AS prediction FROM te, f"""
O["reg_tree_groups"] = f"""WITH {SPLIT}, g AS (SELECT paradas_previas, avg({TARGET}) AS m FROM tr GROUP BY 1)
SELECT split_key, {r("m", 4)} AS prediction FROM te JOIN g USING (paradas_previas)"""
CLASS_CUTS = TRAIN_CUTS.replace("patchy", "tidy").replace("split_key % 10 >= 2", f"NOT ({IN_TEST})")
O["flow_classification_stops"] = f"""WITH {TIDY}, {CLASS_CUTS}, l AS (SELECT split_key, paradas_previas, {IN_TEST} AS test,
{CLASS.format(f"(CASE WHEN {TARGET} > 0 THEN {TARGET} END)")} AS real FROM tidy, cuts),
v AS (SELECT paradas_previas, real, row_number() OVER (PARTITION BY paradas_previas ORDER BY count(*) DESC, real) AS k
FROM l WHERE NOT test GROUP BY paradas_previas, real)
SELECT split_key, l.real, v.real AS predicho FROM l JOIN v ON l.paradas_previas = v.paradas_previas AND k = 1 WHERE test"""
CV_MEANS = ", ".join(
    f"{r(f'{f}({m}) FILTER (WHERE NOT seen)', 4)} AS cv_{m.lower()}_{s}"
    for m in ("MAE", "RMSE", "R2") for f, s in (("avg", "mean"), ("stddev_pop", "std"))
) + ", " + ", ".join(f"{r(f'avg({m}) FILTER (WHERE seen)', 4)} AS train_{m.lower()}_mean" for m in ("MAE", "RMSE", "R2"))
O["cross_validate_line"] = f"""WITH {SPLIT}, rows AS (SELECT {TARGET} AS y, distancia_km AS x, {hashed("split_key", 9)} % 5 AS fold FROM tr),
f AS (SELECT i.k, regr_slope(y, x) AS a, regr_intercept(y, x) AS b FROM rows, range(5) i(k) WHERE fold <> k GROUP BY i.k),
e AS (SELECT k, fold <> k AS seen, y, y - (a * x + b) AS e FROM rows, f),
s AS (SELECT k, seen, avg(abs(e)) AS MAE, sqrt(avg(e * e)) AS RMSE, 1 - sum(e * e) / (var_pop(y) * count(*)) AS R2 FROM e GROUP BY k, seen)
SELECT 'line' AS model, {CV_MEANS}, '' AS cv_error FROM s"""
NEAR = """near AS (SELECT q.vec_id AS query, t.label AS value, row_number() OVER (PARTITION BY q.vec_id
ORDER BY list_distance(q.embedding::DOUBLE[], t.embedding::DOUBLE[]), t.vec_id) AS k
FROM embeddings q JOIN embeddings t ON q.vec_id % 10 < 2 AND t.vec_id % 10 >= 2)"""
O["reg_knn"] = f"WITH {NEAR} SELECT query, {r('avg(value)')} AS prediction FROM near WHERE k <= 5 GROUP BY query"
O["reg_knn_manhattan"] = f"""WITH pairs AS (SELECT q.vec_id AS query, t.vec_id AS near, t.label AS value,
list_sum(list_transform(range(1, 65), lambda i: abs(q.embedding[i]::DOUBLE - t.embedding[i]::DOUBLE))) AS d
FROM embeddings q JOIN embeddings t ON q.vec_id % 10 < 2 AND t.vec_id % 10 >= 2),
near AS (SELECT query, value, row_number() OVER (PARTITION BY query ORDER BY d, near) AS k FROM pairs)
SELECT query, {r('avg(value)')} AS prediction FROM near WHERE k <= 7 GROUP BY query"""
O["cls_knn"] = f"""WITH {NEAR}, v AS (SELECT query, value, count(*) AS n FROM near WHERE k <= 5 GROUP BY ALL)
SELECT query, arg_min(value, (-n, value)) AS predicho FROM v GROUP BY query"""
O["cluster_indexes"] = f"""WITH x AS (SELECT vec_id, label, i, embedding[i]::DOUBLE AS v FROM embeddings, range(1, 65) t(i)),
c AS (SELECT label, i, avg(v) AS m FROM x GROUP BY ALL), o AS (SELECT i, avg(v) AS m FROM x GROUP BY i),
n AS (SELECT label, count(*) AS n FROM embeddings GROUP BY label),
d AS (SELECT x.vec_id, x.label, sum((x.v - c.m) * (x.v - c.m)) AS d FROM x JOIN c USING (label, i) GROUP BY ALL),
w AS (SELECT label, sum(d) AS ss, avg(sqrt(d)) AS s FROM d GROUP BY label),
b AS (SELECT sum(n.n * (c.m - o.m) * (c.m - o.m)) AS b FROM c JOIN o USING (i) JOIN n USING (label)),
p AS (SELECT a.label AS la, z.label AS lz, sqrt(sum((a.m - z.m) * (a.m - z.m))) AS g FROM c a JOIN c z ON a.i = z.i AND a.label <> z.label GROUP BY ALL),
r AS (SELECT la, max((wa.s + wz.s) / g) AS r FROM p JOIN w wa ON wa.label = la JOIN w wz ON wz.label = lz GROUP BY la)
SELECT {r("(SELECT sum(ss) FROM w)", 4)} AS inertia,
{r("((SELECT b FROM b) / ((SELECT count(*) FROM n) - 1)) / ((SELECT sum(ss) FROM w) / ((SELECT count(*) FROM embeddings) - (SELECT count(*) FROM n)))", 4)} AS calinski_harabasz_score,
{r("(SELECT avg(r) FROM r)", 4)} AS davies_bouldin_score"""
O["cluster_profile"] = f"""WITH {TIDY}, k AS (SELECT *, (id_bodega::INT % 3)::INT AS cluster FROM tidy)
SELECT cluster, {", ".join(f"round_even(avg({c}), 2) AS {c}" for c in NUMBERS)}, count(*) AS cantidad_registros,
round_even(avg({TARGET}), 2) AS tiempo_entrega_promedio FROM k GROUP BY cluster"""
O["model_save_load"] = f"WITH {SPLIT} SELECT count(*) AS filas, 0::BIGINT AS distintas FROM te"
