"""Quality scores: accuracy on held-out labels, vectors, and odd rows."""

import zlib

import numpy as np

from lastmile.llm import quality_model
from lastmile.llm.queries import QUERIES

MEDIUM = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{MEDIUM}/labels.parquet").collect()}
    rows = QUERIES["op7_quality_model"](spark, MEDIUM).collect()
    assert len(rows) == spark.read.parquet(f"{MEDIUM}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([p == y for p, y in held]) >= 0.97


def test_context_sums():
    ids = np.array([3, 5, 3, 9])
    sums = np.zeros((quality_model.VOCABULARY, quality_model.SIZE), np.float32)
    quality_model.context_sums(ids, sums)
    index = quality_model.INDEX
    assert np.array_equal(sums[9], index[3] + index[5])
    assert np.array_equal(sums[5], 2 * index[3] + index[9])
    assert np.array_equal(sums[3], 2 * index[5] + index[9] + 2 * index[3])


def test_odd_rows_and_tables(spark):
    docs = spark.createDataFrame(
        [(i, f"calm plain words of prose number {i} and more of them here." if i % 2 else "BUY!! NOW!! CHEAP!! " * 9, "s") for i in range(200)]
        + [(None, None, None), (7, "", "s"), (7, "", "s"), (500, "x" * 300_000, "s"), (501, " \n \t", "s")],
        "doc_id long, text string, score string",
    )
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(None, 1), (3, None)], "doc_id long, quality int")
    out = quality_model.scored(docs, labels)
    assert out.columns == ["doc_id", "text", "score", "predicted"] and out.count() == 205
    wrong = out.where("doc_id < 200 AND text <> '' AND predicted <> doc_id % 2").count()
    assert wrong <= 4
    assert quality_model.scored(docs.limit(0), labels).count() == 0
    assert quality_model.scored(docs, labels.limit(0)).where("score BETWEEN 0 AND 1").count() == 205


def test_word_vectors_cover_all_documents(spark):
    """Words of documents without a label have their context too; texts are no neighbours of each other."""
    docs = spark.createDataFrame([(1, "calm plain words"), (2, "unlabelled rare terms"), (3, None)], "doc_id long, text string")
    model = quality_model.fit(docs, spark.createDataFrame([(1, 1)], "doc_id long, quality int"))
    index, at = quality_model.INDEX, quality_model.word_id
    for word, near in (("rare", ("unlabelled", "terms")), ("words", ("calm", "plain"))):
        want = index[at(word)] + sum(index[at(w)] for w in near)
        assert np.allclose(model.vectors[at(word)], want / np.linalg.norm(want), atol=1e-6)


def test_context_sums_in_pieces(monkeypatch):
    ids = np.random.default_rng(3).integers(-1, 40, 500)
    whole, pieces = (np.zeros((quality_model.VOCABULARY, quality_model.SIZE), np.int64) for _ in range(2))
    quality_model.context_sums(ids, whole)
    monkeypatch.setattr(quality_model, "PAIRS_AT_ONCE", 7)
    quality_model.context_sums(ids, pieces)
    want = np.zeros_like(whole, float)
    for i, a in enumerate(ids):
        for b in ids[i + 1 : i + 3]:
            if a >= 0 and b >= 0:
                want[a] += quality_model.INDEX[b]
                want[b] += quality_model.INDEX[a]
    assert np.array_equal(whole, want.reshape(whole.shape)) and np.array_equal(pieces, whole)
