"""Lines that many documents share are dropped everywhere but in one document.

Long lines are exploded as (document, position, hash of the normalised line). The number of
distinct documents of each hash is counted, the places of lines over the threshold are
gathered per document, and each text is put together again from the positions that are left.
Texts themselves are moved once, to meet the places of their dropped lines. All steps are
DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lastmile.llm.shield import shielded
from lastmile.operators.sizing import small_side, written

WHITE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MIN_CHARS = 40
MIN_DOCUMENTS = 5


def lines_of(text: str = "text") -> Column:
    """The text's lines; a null or empty text is one empty line."""
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n")


def line_key(line: Column) -> Column:
    """The line without white space around it, ASCII letters in lower case."""
    return F.translate(F.btrim(line, F.lit(WHITE)), UPPER, UPPER.lower())


def long_lines(docs: DataFrame, id_column: str, text: str, min_chars: int) -> DataFrame:
    """(row hashes, id, position, line hashes) of the lines with keys of ``min_chars`` or more.

    Hashes are pairs of 64 bits, so that different lines or rows do not meet at any size.
    """
    keys = F.transform(lines_of(text), lambda line, at: F.struct(at.alias("at"), line_key(line).alias("key")))
    long = F.filter(keys, lambda x: F.length(x["key"]) >= min_chars)
    return (
        docs.select(*row_hashes(id_column, text), F.col(id_column).alias("_id"), F.explode(long).alias("_line"))
        .select(
            "_r1", "_r2", "_id", F.col("_line.at").alias("_at"),
            F.xxhash64("_line.key").alias("_h1"), F.xxhash64(F.lit(1), "_line.key").alias("_h2"),
        )
    )


def row_hashes(id_column: str, text: str) -> list[Column]:
    parts = [F.col(id_column).isNull(), F.col(id_column), F.coalesce(F.col(text), F.lit(""))]
    return [F.xxhash64(*parts).alias("_r1"), F.xxhash64(F.lit(1), *parts).alias("_r2")]


def deduplicated(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS,
    min_documents: int = MIN_DOCUMENTS, n_lines: str = "n_lines", n_dropped: str = "n_dropped",
) -> DataFrame:
    """The rows with repeated lines dropped from ``text``, and the numbers of lines before and dropped.

    A key found in at least ``min_documents`` documents loses all its lines except in the
    document with the largest id. Rows of one id are one document, and so are all rows without
    an id, which comes before all others; repeated rows lose the same lines. A null or empty
    text is one empty line; a null text whose line stays, stays null. A text whose lines are
    all dropped is empty. Result columns replace a caller's of the same names.

    Hot lines: distinct (line, document) pairs are spread by both, and only then counted per
    line, summed in each task before the shuffle. The shared lines are broadcast where their
    counted number allows; beyond it adaptive execution splits the hot ones of a plain join.
    """
    inner = shielded(docs.drop(n_lines, n_dropped), (id_column, text))
    lines = written(long_lines(inner, id_column, text, min_chars))
    per_document = lines.groupBy("_h1", "_h2", "_id").agg(F.lit(1).alias("_one"))
    shared = small_side(
        per_document.groupBy("_h1", "_h2").agg(F.count("*").alias("_documents"), F.max("_id").alias("_keeper"))
        .where(F.col("_documents") >= min_documents).drop("_documents")
    )
    places = (
        lines.join(shared, ["_h1", "_h2"]).where(~F.col("_id").eqNullSafe(F.col("_keeper")))
        .groupBy("_r1", "_r2").agg(F.collect_set("_at").alias("_dropped"))
    )
    parts = lines_of(text)
    left = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("_dropped"))
    kept = F.array_join(F.transform(left, lambda at: F.get(parts, at)), "\n")
    out = (
        inner.withColumns(dict(zip(("_r1", "_r2"), row_hashes(id_column, text))))
        .join(places, ["_r1", "_r2"], "left")
        .withColumn("_n", F.size(parts).cast("long"))
        .withColumn("_gone", F.coalesce(F.size("_dropped"), F.lit(0)).cast("long"))
        .withColumn(text, F.when(F.col("_dropped").isNull(), F.col(text)).otherwise(kept))
    )
    whole = out.select(*inner.columns, "_n", "_gone")
    return whole.toDF(*[c for c in docs.columns if c not in (n_lines, n_dropped)], n_lines, n_dropped)
