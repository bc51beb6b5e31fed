"""Quality rules against plain counting, and what the bands reject."""

import base64
import random
import re
from collections import Counter

from lastmile.llm import quality_rules
from lastmile.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def slow(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in seen
            seen.add(line)
    counts = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(inside))
    return (*counts, counts[0] < 50 or 100 * counts[4] > 50 * counts[0])


def counts(r):
    return r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed


def test_query_against_plain_counting(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = QUERIES["op4_quality_rules"](spark, SMALL).collect()
    assert {r.doc_id: counts(r) for r in rows} == {d: slow(t) for d, t in texts.items()}
    assert not any(r.kept and r.base_failed for r in rows)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    good = [r for r in rows if labels.get(r.doc_id) == 1 and not r.base_failed]
    assert good and all(r.kept for r in good)


def test_bands(spark):
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("etaoinshrdlu") for _ in range(rnd.randint(2, 9)))
    prose = " ".join(word() for _ in range(3000))
    encoded = " ".join(base64.b64encode(rnd.randbytes(45)).decode() for _ in range(300))
    # Three-word windows differ all along, so only the compression shows the repetition.
    lines = "\n".join(f"item {i} of the list was sold to customer number {i} on day {i} for price {i} in store {i}" for i in range(400))
    texts = [prose, encoded, lines, prose + " " + encoded, "", None, " \n\v ", "one two", prose * 40]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "'x' AS kept", "1 AS n_words")
    rows = {r.doc_id: r for r in quality_rules.judged(docs.unionAll(docs)).collect()}
    assert [rows[i].kept for i in range(9)] == [True, False, False, False, False, False, False, False, False]
    assert not rows[1].base_failed and not rows[2].base_failed and not rows[3].base_failed
    assert {i: counts(r) for i, r in rows.items()} == {i: slow(t) for i, t in enumerate(texts)}
    assert quality_rules.judged(docs.limit(0)).count() == 0


def test_many_different_words_do_not_overflow():
    words = [str(i).encode() for i in range(3_000_000)]
    assert quality_rules.repeated_words(words + words[:5]) == 10
