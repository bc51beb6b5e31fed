"""Packing: ids equal to the reference tokenizer's, exact cover of documents and sequences, little padding."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lastmile.llm import packing
from lastmile.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def padding(lengths):
    return sum(0 if n & (n - 1) == 0 else 1024 - n for n in lengths)


def check(rows, texts, tokenizer):
    """rows of single-row documents; returns the sequences' lengths."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(texts)
    for d, parts in by_doc.items():
        ids = np.array([*tokenizer.encode(texts[d] or "", add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for r in sorted(parts, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    return [sum(r.length for r in parts) for parts in by_sequence.values()]


def test_query(spark, tokenizer):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    lengths = check(QUERIES["op8_packing"](spark, SMALL).collect(), texts, tokenizer)
    assert padding(lengths) <= 0.01 * sum(lengths)


def test_edge_rows(spark, tokenizer):
    texts = {1: None, 2: "", 3: "a<|endoftext|>b  \n\n  é😀", 4: "word " * 40_000, None: "x\t\ty ", 6: "''ll 'S 's 12ab_ –"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").selectExpr("*", "0 AS length", "1 AS offset")
    check(packing.packed(docs, RANKS).collect(), texts, tokenizer)
    twice = packing.packed(docs.unionAll(docs), RANKS, keep_ids=True)
    assert twice.count() == 2 * packing.packed(docs, RANKS).count()
    whole = {r.sequence_id: r.ids for r in packing.sequences(twice).collect()}
    for r in twice.collect():
        assert whole[r.sequence_id][r.offset : r.offset + r.length] == r.ids
    assert packing.packed(docs.limit(0), RANKS).count() == 0


@pytest.mark.parametrize(
    "lengths",
    [[1], [512, 512, 1024], [341] * 900, [340] * 500 + [5] * 50, list(range(1, 513)) * 3, [300] * 1000 + list(range(1, 513)) * 4],
)
def test_plan_places_each_piece_once(lengths):
    counts = np.bincount(lengths, minlength=1025)
    made = packing.plan(counts)
    room = defaultdict(list)
    for n in sorted(set(lengths)):
        s, o = made.place(np.full(counts[n], n), np.arange(counts[n]))
        for a, b in zip(s.tolist(), o.tolist()):
            room[a].append((b, n))
    assert sorted(room) == list(range(len(room)))
    for parts in room.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 1024


def test_fit_is_near_the_histogram():
    counts = np.bincount(list(range(100, 513)) * 50, minlength=1025)
    combos = packing.combinations(counts)
    x = packing.nonnegative_fit(combos, counts)
    made = np.zeros(1025)
    for c, times in zip(combos, x):
        for n, k in c.items():
            made[n] += k * times
    assert (x >= 0).all() and np.abs(made - counts).sum() < 0.1 * counts.sum()
