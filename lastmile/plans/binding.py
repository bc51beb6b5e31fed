"""Deliveries bound to the star-schema tables, and variants that exercise edge rules."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lastmile.operators.sizing import shared_folder
from lastmile.schema import NUMERIC, NUMERIC_AND_TARGET

# Valid in Spark SQL and DuckDB.
DELIVERIES = """
SELECT (l.l_orderkey*7919 + l.l_partkey*104729 + l.l_suppkey*1299709 + l.l_linenumber*15485863) % 1000003 AS split_key,
  l.l_quantity AS distancia_km,
  CASE o.o_orderpriority WHEN '1-URGENT' THEN ' Critico ' WHEN '2-HIGH' THEN 'Alto' WHEN '3-MEDIUM' THEN 'medio'
       WHEN '5-LOW' THEN 'BAJO' ELSE 'Sin Dato' END AS trafico_nivel,
  CASE l.l_returnflag WHEN 'A' THEN 'Soleado' WHEN 'N' THEN 'Nublado' ELSE 'Lluvia' END AS clima,
  CASE o.o_orderstatus WHEN 'O' THEN 'Moto' WHEN 'F' THEN 'Van' ELSE 'Camion' END AS tipo_vehiculo,
  CAST(p.p_size AS DOUBLE) AS peso_carga_kg,
  CAST(l.l_linenumber - 1 AS DOUBLE) AS paradas_previas,
  CAST(l.l_suppkey % 21 AS DOUBLE) AS experiencia_chofer_anios,
  CAST(l.l_orderkey % 24 AS DOUBLE) AS hora_despacho,
  o.o_totalprice / 1000.0 AS costo_envio,
  l.l_tax * 100.0 AS consumo_nafta,
  CAST(l.l_suppkey % 5 + 1 AS INT) AS id_bodega,
  0.8 * l.l_quantity + 2.0 * (l.l_linenumber - 1) + l.l_extendedprice * (1 - l.l_discount) / 5000.0 - 3.0 AS target_tiempo_entrega
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    sql = DELIVERIES
    tables = {}
    for name in ("lineitem", "orders", "part"):
        sql = sql.replace(f" {name} ", f" {{{name}}} ")
        tables[name] = table(spark, sf_dir, name)
    return spark.sql(sql, **tables)


def with_copies(df: DataFrame) -> DataFrame:
    """Some rows once more, as exact copies."""
    return df.unionAll(df.where("split_key % 100 = 7"))


def as_text(df: DataFrame) -> DataFrame:
    """Numbers as text with a decimal comma, as a raw file would hold them."""
    return df.withColumns(
        {c: F.translate(F.col(c).cast("string"), ".", ",") for c in NUMERIC_AND_TARGET}
    )


def with_nulls(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {c: F.expr(f"CASE WHEN split_key % 13 = 0 THEN NULL ELSE {c} END") for c in NUMERIC_AND_TARGET}
    )


def with_null_features(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {c: F.expr(f"CASE WHEN split_key % 13 = 0 THEN NULL ELSE {c} END") for c in NUMERIC}
    )


def scratch(spark: SparkSession) -> str:
    """A fresh folder for written results, beside the shared checkpoints where there are any."""
    return f"{shared_folder(spark)}/results/{uuid.uuid4().hex}"


# Simple arithmetic predictors, so that every score can be checked without a fitted model.
PREDICTORS = {
    "distance": "10.0D + 0.7D * distancia_km",
    "constant": "33.0D",
    "stops": "5.0D + 0.8D * distancia_km + 1.5D * paradas_previas",
}


def predictions(df: DataFrame) -> DataFrame:
    """Long predictions of the test rows: model, real, predicho and the row's columns."""
    named = F.array(
        *[F.struct(F.lit(m).alias("model"), F.expr(e).alias("predicho")) for m, e in PREDICTORS.items()]
    )
    return (
        df.where("split_key % 10 < 2")
        .withColumn("_p", F.explode(named))
        .select(
            F.col("_p.model").alias("model"), F.col("target_tiempo_entrega").alias("real"),
            F.col("_p.predicho").alias("predicho"), *df.columns,
        )
        .drop("target_tiempo_entrega")
    )


CLASSIFIERS = {"by_distance": ("distancia_km", 17.0, 34.0), "by_cost": ("costo_envio", 150.0, 300.0)}


def class_predictions(labelled: DataFrame) -> DataFrame:
    """Long class predictions of the test rows by simple cut-offs."""
    def cut(column: str, low: float, high: float):
        c = F.col(column)
        return F.when(c <= low, "rapida").when(c <= high, "normal").otherwise("tardia")

    named = F.array(
        *[F.struct(F.lit(m).alias("model"), cut(*rule).alias("predicho")) for m, rule in CLASSIFIERS.items()]
    )
    return (
        labelled.where("split_key % 10 < 2")
        .withColumn("_p", F.explode(named))
        .select(
            F.col("_p.model").alias("model"), F.col("categoria_entrega").alias("real"),
            F.col("_p.predicho").alias("predicho"),
        )
    )
