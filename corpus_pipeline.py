"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, folder of the tables) and returns a frame; ``run`` writes it
as Parquet in the shared folder and reads it again as the next stage's documents, so that a
lost executor costs one stage at most. All stages but the last return the columns of
``documents``.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lastmile.llm import mixing, packing, pii, simhash, toxicity
from lastmile.operators.sizing import delete_at_exit, shared_folder
from lastmile.plans.binding import table

RANK_FILE = public_tokenizers.path("byte_bpe_50k.tiktoken")
SHINGLE_WORDS, MAX_DISTANCE = 4, 4  # of the near-duplicate operator's contract


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model accepts; labels that are held out are not learnt from."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest id."""
    return simhash.keep_one(docs, shingle=SHINGLE_WORDS, max_distance=MAX_DISTANCE)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return pii.redacted(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources brought to their target weights: taken words, a row for each pass of a document."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens with their places in sequences."""
    return packing.packed(docs, RANK_FILE)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("pii", redact),
    ("mixing", mix),
    ("packing", pack),
]

# The model stages have no SQL form; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents; the last stage's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{shared_folder(spark)}/pipeline/{uuid.uuid4().hex}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        delete_at_exit(spark, path)
        docs = spark.read.parquet(path)
    return docs
