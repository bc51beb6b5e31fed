"""The delivery table: column names, roles and declared types."""

from __future__ import annotations

from pyspark.sql import types as T

TARGET = "target_tiempo_entrega"
LABEL = "categoria_entrega"
RISK = "riesgo_logistico"
ID_COLUMN = "id_bodega"

NUMERIC = [
    "distancia_km",
    "peso_carga_kg",
    "paradas_previas",
    "experiencia_chofer_anios",
    "hora_despacho",
    "costo_envio",
    "consumo_nafta",
]
CATEGORICAL = ["trafico_nivel", "clima", "tipo_vehiculo", ID_COLUMN]
TEXT = [c for c in CATEGORICAL if c != ID_COLUMN]
FEATURES = NUMERIC + CATEGORICAL
REQUIRED = FEATURES + [TARGET]
NUMERIC_AND_TARGET = NUMERIC + [TARGET]

CLASSES = ["rapida", "normal", "tardia"]

CSV_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in REQUIRED])
