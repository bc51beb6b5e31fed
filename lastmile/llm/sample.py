"""Bounded samples of labelled documents for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HELD_OUT = 2


def held_out(id_column: str = "doc_id") -> Column:
    """Whether labels of the row must not be learnt from: CRC-32 of the id as text, modulo 4."""
    crc = F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary"))
    return crc % 4 == HELD_OUT


def labelled(
    docs: DataFrame, labels: DataFrame, label: str, most: int, id_column: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(id, text, y) of at most ``most`` labelled documents that are not held out.

    Which ones is decided by a hash of the id. Null labels and ids are left out; of repeated
    labels the greater counts. Repeated documents give a row each; users aggregate by ``_id``.
    The ids, bounded by ``most``, are broadcast.
    """
    chosen = (
        labels.where(F.col(label).isNotNull() & F.col(id_column).isNotNull() & ~held_out(id_column))
        .groupBy(F.col(id_column).alias("_id")).agg((F.max(label) > 0).cast("int").alias("y"))
        .orderBy(F.xxhash64("_id"), "_id").limit(most)
    )
    return (
        docs.select(F.col(id_column).alias("_id"), F.coalesce(text, F.lit("")).alias("text"))
        .join(F.broadcast(chosen), "_id")
    )
