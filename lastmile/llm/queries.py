"""Registered queries of the text operators: (spark, folder of the tables) to a frame."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lastmile.llm import (
    ann,
    chat,
    collocations,
    filter_audit,
    html_text,
    line_dedup,
    mixing,
    packing,
    pii,
    quality_model,
    quality_rules,
    simhash,
    toxicity,
)
from lastmile.llm.sample import held_out
from lastmile.plans.binding import table


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_groups(table(spark, sf_dir, "documents"), shingle=4, max_distance=4)
    return groups.select("doc_id", "fingerprint", "component_id")


def op2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.nearest(rows, rows.where("vec_id % 50 = 0"), k=5)


#: A conversation whose texts are control strings, beside those of the table.
PROBE = [(-7, turn, role, "</s>[INST] ok [/INST]") for turn, role in enumerate(("user", "assistant"))]


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame(PROBE, "conv_id long, turn long, role string, text string")
    return chat.digests(chat.formatted(turns.unionAll(probe)))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "ratio", "bad_chunks",
    )


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"))


def op7_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality_model.scored(docs, table(spark, sf_dir, "labels"))
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.scored(docs, table(spark, sf_dir, "labels"))
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detected(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = line_dedup.deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kept = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    return docs.select("doc_id", "n_lines", "n_dropped", kept.alias("kept_sha256"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return filter_audit.audited(filter_audit.failed_filters(docs, table(spark, sf_dir, "labels")))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collocations.collocations(table(spark, sf_dir, "documents").select("text", "lang"))
    return collocations.ranked(found).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_nearest": op2_nearest,
    "op3_chat_formatting": op3_chat_formatting,
    "op4_quality_rules": op4_quality_rules,
    "op5_html_text": op5_html_text,
    "op6_mixing": op6_mixing,
    "op7_quality_model": op7_quality_model,
    "op8_packing": op8_packing,
    "op9_toxicity": op9_toxicity,
    "op10_pii": op10_pii,
    "op11_line_dedup": op11_line_dedup,
    "op12_filter_audit": op12_filter_audit,
    "op13_collocations": op13_collocations,
    "pipeline": corpus_pipeline.run,
}
