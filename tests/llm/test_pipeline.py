"""The pipeline: every stage against what it must do to its own input, with planted documents."""

import re
from collections import Counter, defaultdict

import corpus_pipeline
import pytest
import test_packing
import test_pii
import test_simhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer
import public_tokenizers

from lastmile.llm import mixing

SMALL = "/root/testdata/sf0.001"
LARGE = "/root/testdata/sf0.1"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def planted(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    clean = docs.where("length(text) > 1500").orderBy("doc_id").first()
    words = clean.text.split(" ")
    near = " ".join([*words[:-1], "changed"])
    rows = [
        (-1, clean.text, "en", "src0", len(clean.text)), (-2, near, "en", "src1", len(near)),
        (-3, ("you stupid idiot, worthless pathetic moron scum " * 30), "en", "src0", 1),
        (-4, "mail the boss at some.one@mail9.example.com or +1 (017) 555-7713 " + "calm words here " * 40, "en", None, 1),
        (-5, "", "en", "src2", 0), (-6, None, None, None, 0),
    ]
    return docs.unionAll(spark.createDataFrame(rows, docs.schema)), clean


def test_stages(spark, planted):
    docs, clean = planted
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "simhash_near_dedup", "pii", "mixing", "packing"]

    # Labels of the larger table share ids with other texts: only its own documents may be learnt from.
    large = spark.read.parquet(f"{LARGE}/documents.parquet").select(*columns)
    both = large.unionAll(docs.where("doc_id < 0"))
    kept = stages["toxicity"](spark, both, LARGE)
    assert kept.columns == columns
    left = {r.doc_id for r in kept.select("doc_id").collect()}
    assert -3 not in left and {-1, -2, -4, -5, -6} <= left
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{LARGE}/labels.parquet").collect()}
    clean_ids = [d for d, t in labels.items() if not t]
    assert sum(d not in left for d in clean_ids) <= 0.01 * len(clean_ids)
    assert sum(d in left for d, t in labels.items() if t) <= 0.12 * sum(labels.values())

    single = stages["simhash_near_dedup"](spark, docs, SMALL)
    assert single.columns == columns
    rows = [(r.doc_id, test_simhash.unsigned(test_simhash.simhash.fingerprint(r.text))) for r in docs.collect()]
    groups = dict(test_simhash.slow_components(rows))
    assert sorted(r.doc_id for r in single.collect()) == sorted(set(groups.values()))
    assert groups[clean.doc_id] == groups[-1] == groups[-2] == -2

    safe = stages["pii"](spark, docs, SMALL)
    assert safe.columns == columns and safe.count() == docs.count()
    texts = {r.doc_id: r.text for r in safe.collect()}
    assert not any(test_pii.slow(t) for t in texts.values())
    assert texts[-4].startswith("mail the boss at [EMAIL] or [PHONE] calm words") and texts[-6] is None
    for r in docs.collect():
        assert test_pii.slow(r.text) or "[" in (texts[r.doc_id] or "") or texts[r.doc_id] == r.text

    mixed = stages["mixing"](spark, docs, SMALL)
    assert mixed.columns == columns
    before = {r.doc_id: r for r in docs.collect()}
    words, by_source = Counter(), Counter()
    for r in mixed.collect():
        n = len(WORD.findall(r.text))
        words[r.doc_id] += n
        by_source[r.source] += n
        assert not Counter(WORD.findall(r.text)) - Counter(WORD.findall(before[r.doc_id].text))
    sizes = defaultdict(int)
    for r in before.values():
        sizes[r.source] += len(WORD.findall(r.text or ""))
    targets = {r.source: r.target for r in mixing.sized_documents(docs)[1].collect()}
    for s in sizes:
        assert abs(by_source[s] - targets[s]) <= 0.02 * targets[s] + 3 * mixing.BLOCK_WORDS
    assert all(n <= 2 * len(WORD.findall(before[d].text)) for d, n in words.items())

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    lengths = test_packing.check(stages["packing"](spark, docs, SMALL).collect(), {d: r.text for d, r in before.items()}, tokenizer)
    assert test_packing.padding(lengths) <= 0.01 * sum(lengths)


def test_run(spark):
    out = corpus_pipeline.run(spark, SMALL)
    rows = out.collect()
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    known = {r.doc_id for r in docs.collect()}
    assert rows and {r.doc_id for r in rows} <= known
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    again = corpus_pipeline.run(spark, SMALL)
    key = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert sorted(tuple(r) for r in out.select(key).collect()) == sorted(tuple(r) for r in again.select(key).collect())


def test_clashing_columns_stay(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(60)
    names = ["_row", "_toxic", "size", "spans", "base", "_words", "_parts", "_copy", "_id", "_k", "fingerprint", "_in0", "score", "source_no"]
    wide = docs.select("*", *[F.concat(F.lit(n), F.col("doc_id").cast("string")).alias(n) for n in names])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, wide, SMALL)
        assert out.columns == wide.columns
        rows = out.collect()
        assert rows and all(r[n] == f"{n}{r.doc_id}" for r in rows for n in names)
    assert corpus_pipeline.STAGES[-1][1](spark, wide, SMALL).count() > 0


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").where(F.lit(False))
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SMALL)
        assert out.count() == 0
