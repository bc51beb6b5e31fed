"""Keeping a caller's columns apart from an operator's own."""

from __future__ import annotations

from pyspark.sql import DataFrame


def shielded(docs: DataFrame, used: tuple[str, ...]) -> DataFrame:
    """The frame with all columns but the ``used`` ones under names that operators do not use."""
    return docs.toDF(*[c if c in used else f"_in{i}" for i, c in enumerate(docs.columns)])


def restored(out: DataFrame, inner: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of a shielded frame in the order and under the names of the caller's."""
    return out.select(*inner.columns).toDF(*docs.columns)
