"""Phrases whose words belong together, mined from sorted streams of phrase counts.

Counting goes by order, from single words up. A phrase that is frequent has frequent parts
only, so a pass over the texts counts hashes of those phrases whose two parts are frequent by
the pass before, and the exact phrases of the order below whose hashes were frequent. What the
tasks need of the pass before is a bitmap of fixed size, which can only let through too much.

The exact counts of all orders are one stream, kept in two sort orders. In prefix order a phrase
is preceded by its first words and followed by its extensions to the right; in suffix order,
words reversed, by its last words and its extensions to the left. Each pass reads its range of
the stream in lockstep with a stack of the phrases that the current one extends: that gives
the counts of the parts of all cuts and the count of the most frequent extension, without a
hash table or a join. Where a phrase's extensions run over into later ranges, which happens
for at most three phrases at each border, its counts are handed to those ranges.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lastmile.operators.sizing import checkpointed, written

MAX_WORDS = 4
MIN_COUNT = 30
COVERED_PERCENT = 80
TOP = 2000
SCALE = 2_000_000
NO_LANG = "und"

PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
BITS = 26  # of the bitmap of frequent hashes, 8 MB
BUCKET_BITS = 15  # of a bitmap row, as Spark's bitmap functions cut them
CHUNK_BYTES = 1_500_000  # of text counted at a time
BASE = 0xD1342543DE82EF95  # of the polynomial in a word's hash, odd
INVERSE = pow(BASE, -1, 2**64)

LOWER = bytes(10 if c in PIECE_ENDS else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))
COUNTS = "h long, lang string, phrase string, n long"


# --- counting -------------------------------------------------------------------------------


def chunks(text: bytes, order: int, most: int = CHUNK_BYTES) -> Iterator[tuple[bytes, int]]:
    """A normalised text in parts of bounded size, each with the number of words it repeats.

    Parts end with a piece, or in a piece that is longer with a word; the next part then
    begins with the last ``order - 1`` words again, so that each phrase of so many words or
    one more lies in one part whole.
    """
    at, repeated, limit = 0, 0, most
    while len(text) - at > limit:
        cut = text.rfind(b"\n", at, at + limit) + 1
        if cut > at:
            yield text[at:cut], repeated
            at, repeated, limit = cut, 0, most
            continue
        cut = text.rfind(b" ", at, at + limit)
        if cut <= at:
            later = re.compile(b"[ \n]").search(text, at + limit)
            if not later:
                break
            cut = later.start()
        head = text[at:cut].rsplit(None, order - 1) if order > 1 else [text[at:cut]]
        if len(head) < order:  # longer words than the limit: take more of them
            limit += most
            continue
        yield text[at:cut], repeated
        at, repeated, limit = at + len(head[0]), order - 1, most
    yield text[at:], repeated


class Words:
    """The words of a normalised buffer: hash, piece and text of each."""

    def __init__(self, data: bytes, text_starts: np.ndarray):
        raw = np.frombuffer(data, np.uint8)
        inside = np.zeros(len(raw) + 2, bool)
        inside[1:-1] = (raw != 32) & (raw != 10)
        self.edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.raw, starts = raw, self.edges[::2]
        self.hash = word_hashes(raw, starts, self.edges[1::2])
        self.piece = np.cumsum(raw == 10, dtype=np.int32)[starts]
        self.text = np.searchsorted(text_starts, starts, "right") - 1

    def numbered(self, used: np.ndarray) -> tuple[np.ndarray, pa.Array]:
        """Number in a dictionary of each word that is marked as used, and the dictionary."""
        buffers = [None, pa.py_buffer(self.edges.astype(np.int32)), pa.py_buffer(self.raw)]
        words_and_gaps = pa.Array.from_buffers(pa.binary(), len(self.edges) - 1, buffers)
        at = np.flatnonzero(used)
        words = words_and_gaps.take(pa.array(2 * at)).dictionary_encode()
        number = np.zeros(len(self), np.int64)
        number[at] = words.indices.to_numpy(zero_copy_only=False)
        return number, words.dictionary

    def __len__(self) -> int:
        return len(self.hash)

    def phrases(self, order: int) -> np.ndarray:
        """Whether a phrase of so many words begins at each word, all in one piece."""
        out = np.zeros(len(self), bool)
        if order <= len(self):
            out[: len(self) - order + 1] = self.piece[: len(self) - order + 1] == self.piece[order - 1 :]
        return out


def mixed(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    h = (h ^ word) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word: its bytes as a polynomial modulo 2^64, with the bits mixed.

    Differences of one running sum over the buffer, divided by the power at the word's start.
    UTF-8 has no byte 255, so that no byte counts as zero.
    """
    total = np.full(len(raw) + 1, BASE, np.uint64)
    np.cumprod(total, out=total)
    total[1:] *= raw + np.uint8(1)
    np.cumsum(total, out=total)
    h = total[ends] - total[starts]
    total[0], total[1:] = 1, INVERSE
    np.cumprod(total, out=total)
    h *= total[starts]
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return h ^ (h >> np.uint64(31))


def count_buffer(
    data: bytes, text_starts: np.ndarray, langs: list[str], order: int, last: int, bitmap: np.ndarray | None, repeated: int = 0,
) -> Iterator[pa.RecordBatch]:
    """Hashes of phrases of ``order`` words and exact phrases of one word less, with their counts.

    ``langs`` is the part of each text. Of phrases with a word less those whose hash is in the
    bitmap count, of phrases with ``order`` words those of which both ends do.
    """
    words = Words(data, text_starts)
    if not len(words):
        return
    lang_names, lang = np.unique(np.array(langs, object).astype(str), return_inverse=True)
    lang = lang[words.text].astype(np.int64)
    place = np.arange(len(words))
    if order == 1:
        totals = np.bincount(lang[repeated:], minlength=len(lang_names))
        seen = np.flatnonzero(totals)
        yield counts_batch([None] * len(seen), lang_names[seen].tolist(), [""] * len(seen), totals[seen])
        frequent = np.ones(len(words), bool)
    lang_hash = np.fromiter((xxhash.xxh64_intdigest(x, seed=1) for x in lang_names.tolist()), np.uint64, len(lang_names))
    own, h = words.hash, lang_hash[lang]
    for k in range(order - 1):
        h = mixed(h, np.roll(own, -k))
    if order > 1:
        at = h & np.uint64(2**BITS - 1)
        bit = bitmap[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1
        frequent = (bit == 1) & words.phrases(order - 1)
        first = np.flatnonzero(frequent & (place + order - 1 > repeated))
        if len(first):
            used = np.zeros(len(words), bool)
            for k in range(order - 1):
                used[first + k] = True
            number, dictionary = words.numbered(used)
            key = lang[first]
            for k in range(order - 1):
                if k and k % 2 == 0:  # a buffer's langs or phrases with two words more stay in 63 bits
                    key = np.unique(key, return_inverse=True)[1]
                key = key * len(dictionary) + number[first + k]
            _, example, n = np.unique(key, return_index=True, return_counts=True)
            start = first[example]
            parts = [dictionary.take(pa.array(number[start + k])) for k in range(order - 1)]
            phrases = pc.binary_join_element_wise(*parts, pa.scalar(b" ")).cast(pa.string())
            yield counts_batch([None] * len(n), lang_names[lang[start]].tolist(), phrases, n)
    if order <= last:
        begins = frequent & words.phrases(order) & (place + order > repeated)
        if order > 1:
            begins[:-1] &= frequent[1:]
        hashes, n = np.unique(mixed(h, np.roll(own, 1 - order))[begins].view(np.int64), return_counts=True)
        yield counts_batch(hashes, [None] * len(n), [None] * len(n), n)


def counts_batch(hashes, langs, phrases, n) -> pa.RecordBatch:
    columns = [pa.array(hashes, pa.int64()), pa.array(langs, pa.string()), pa.array(phrases, pa.string()), pa.array(n, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, ["h", "lang", "phrase", "n"])


def counting(order: int, last: int, shared) -> Callable:
    """A pass over (lang, text): COUNTS of bounded buffers of texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = None if shared is None else np.frombuffer(shared.value, np.uint8)

        def buffers() -> Iterator[tuple[bytes, list[int], list[str], int]]:
            held, starts, langs, size = [], [], [], 0
            for batch in batches:
                for lang, text in zip(batch.column(0), batch.column(1)):
                    data = (text.as_py() or "").encode().translate(LOWER)
                    name = lang.as_py()
                    if len(data) > CHUNK_BYTES:
                        for part, repeated in chunks(data, order):
                            yield part, [0], [name], repeated
                        continue
                    held.append(data)
                    starts.append(size)
                    langs.append(name)
                    size += len(data) + 1
                    if size > CHUNK_BYTES:
                        yield b"\n".join(held), starts, langs, 0
                        held, starts, langs, size = [], [], [], 0
            if held:
                yield b"\n".join(held), starts, langs, 0

        for data, starts, langs, repeated in buffers():
            yield from count_buffer(data, np.array(starts), langs, order, last, bitmap, repeated)

    return run


def bitmap_of(hashes: DataFrame) -> bytes:
    """The lowest BITS bits of all hashes as a bitmap, 2^BITS bits however many there are."""
    at = F.col("h").bitwiseAND(2**BITS - 1) + 1
    rows = (
        hashes.groupBy(F.bitmap_bucket_number(at).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")).collect()
    )
    width = 2**BUCKET_BITS // 8
    out = np.zeros(2**BITS // 8, np.uint8)
    for r in rows:
        out[(r["bucket"] - 1) * width : r["bucket"] * width] = np.frombuffer(r["bits"], np.uint8)
    return out.tobytes()


def frequent_phrases(
    docs: DataFrame, text: str = "text", lang: str = "lang", min_count: int = MIN_COUNT, max_words: int = MAX_WORDS,
) -> DataFrame:
    """(lang, path, n): phrases of 1 to ``max_words`` words found ``min_count`` times or more, as arrays
    of words, and for each lang the empty phrase with the number of all its words, where it has so many."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(NO_LANG)).alias("lang"), F.col(text).alias("text"))
    found, shared = [], None
    for order in range(1, max_words + 2):
        counted = written(
            texts.mapInArrow(counting(order, max_words, shared), COUNTS)
            .groupBy("h", "lang", "phrase").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)
        )
        if shared is not None:
            shared.destroy()
        found.append(counted.where(F.col("phrase").isNotNull()).select("lang", "phrase", "n"))
        if order <= max_words:
            shared = spark.sparkContext.broadcast(bitmap_of(counted.where(F.col("h").isNotNull())))
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionAll(more)
    path = F.when(F.col("phrase") == "", F.array().cast("array<string>")).otherwise(F.split("phrase", " "))
    return rows.select("lang", path.alias("path"), "n")


# --- lockstep passes --------------------------------------------------------------------------


def open_at_borders(placed: DataFrame) -> dict[tuple, tuple[int, int]]:
    """(n, count of the most frequent extension) of the phrases that extend over a border between ranges.

    These are the beginnings of each range's first phrase, so there are at most as many per
    range as a phrase has words.
    """
    first = placed.groupBy("_part").agg(F.min(F.struct("lang", "path")).alias("first"))
    lengths = F.when(F.size("first.path") > 0, F.sequence(F.lit(0), F.size("first.path") - 1)).otherwise(F.array().cast("array<int>"))
    begins = F.transform(lengths, lambda k: F.slice(F.col("first.path"), F.lit(1), k))
    open_ones = F.broadcast(written(first.select("first.lang", F.explode(begins).alias("path")).distinct()))
    shorter = F.slice(F.col("path"), F.lit(1), F.size("path") - 1)
    extended = placed.where(F.size("path") > 0).select("lang", shorter.alias("path"), F.col("n").alias("more"))
    rows = (
        placed.select("lang", "path", "n", F.lit(0).cast("long").alias("more"))
        .unionByName(extended.withColumn("n", F.lit(0).cast("long")))
        .join(open_ones, ["lang", "path"]).groupBy("lang", "path").agg(F.max("n").alias("n"), F.max("more").alias("more"))
    )
    return {(r["lang"], tuple(r["path"])): (r["n"], r["more"]) for r in rows.collect()}


def in_lockstep(stream: DataFrame, parts: str, most: str) -> DataFrame:
    """The stream (lang, path, n, ...) in sorted order with the counts of each path's beginnings.

    ``parts`` holds the counts of its first 0, 1, ... words, ``most`` the greatest count of a
    path that has one word more (0 if there is none). Every beginning of a path must be in the
    stream. A task holds only the paths that begin the current one.
    """
    spark = stream.sparkSession
    key = ["lang", "path"]
    placed = checkpointed(stream.repartitionByRange(*key).sortWithinPartitions(*key)).withColumn("_part", F.spark_partition_id())
    handed = spark.sparkContext.broadcast(open_at_borders(placed))
    schema = ", ".join(f"{c} {t}" for c, t in stream.dtypes) + f", {parts} array<long>, {most} long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_rows: list[tuple[tuple, dict | None, list[int]]] = []  # path, row (None: of an earlier range), [n, most]
        began = False

        def closed(row: dict | None, counts: list[int]) -> list[dict]:
            return [] if row is None else [row | {most: counts[1]}]

        for batch in batches:
            out, layout = [], batch.schema
            for row in batch.to_pylist():
                path = tuple(row["path"])
                here = (row["lang"], *path)
                if not began:
                    began = True
                    for k in range(len(path)):
                        known = handed.value.get((row["lang"], path[:k]))
                        if known:
                            open_rows.append((here[: k + 1], None, list(known)))
                while open_rows and here[: len(open_rows[-1][0])] != open_rows[-1][0]:
                    out += closed(*open_rows.pop()[1:])
                if open_rows and len(open_rows[-1][0]) == len(here) - 1:
                    counts = open_rows[-1][2]
                    counts[1] = max(counts[1], row["n"])
                later = handed.value.get((row["lang"], path), (0, 0))[1]
                open_rows.append((here, row | {parts: [x[2][0] for x in open_rows]}, [row["n"], later]))
            yield as_batch(out, layout)
        if open_rows:
            yield as_batch([r for x in reversed(open_rows) for r in closed(*x[1:])], layout)

    def as_batch(rows: list[dict], layout: pa.Schema) -> pa.RecordBatch:
        whole = layout.append(pa.field(parts, pa.list_(pa.int64()))).append(pa.field(most, pa.int64()))
        return pa.RecordBatch.from_pylist(rows, whole)

    return placed.drop("_part").mapInArrow(run, schema)


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", min_count: int = MIN_COUNT, max_words: int = MAX_WORDS,
    covered_percent: int = COVERED_PERCENT, scale: int = SCALE,
) -> DataFrame:
    """All collocations: lang, phrase, a, l, r, n, score and ``cut`` (words before the lowest-scoring cut).

    Texts are lower-cased (A-Z), cut into pieces at punctuation and line ends, and pieces into
    words. A phrase of 2 to ``max_words`` words is a candidate if it occurs ``a`` >=
    ``min_count`` times within pieces, overlaps included. Its cut after k words has l and r
    occurrences of the parts and the score floor(scale * a / (l + r)); the lowest counts, ties
    to the smallest k. Candidates inside a longer candidate with ``covered_percent`` of their
    count or more are dropped; it is enough to look at extensions by one word, since those of
    a longer phrase occur as often at least. ``n`` is the number of all words of the lang.

    A null text is empty, a null lang is ``und``; repeated rows count each; other columns are
    not read, whatever their names. Texts and words of any length are read in bounded parts.
    """
    rows = written(frequent_phrases(docs, text, lang, min_count, max_words))
    backwards = F.reverse("path").alias("path")
    by_suffix = in_lockstep(rows.select("lang", backwards, "n"), "_ends", "_before")
    return scored(
        in_lockstep(by_suffix.select("lang", backwards, "n", "_ends", "_before"), "_starts", "_after"), covered_percent, scale
    )


def scored(by_prefix: DataFrame, covered_percent: int = COVERED_PERCENT, scale: int = SCALE) -> DataFrame:
    """The candidates that no longer one covers, with the cut of the lowest score; exact beyond 64 bits."""
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    cut = F.expr(
        f"""array_min(transform(sequence(1, size(path) - 1), k -> struct(
        (cast(n AS decimal(20,0)) * {scale}) div (cast(_starts[k] AS decimal(20,0)) + _ends[size(path) - k]) AS score,
        k AS cut, _starts[k] AS l, _ends[size(path) - k] AS r)))"""
    )
    return (
        by_prefix.where(F.size("path") >= 2)
        .where(F.greatest(wide("_before"), wide("_after")) * 100 < wide("n") * covered_percent)
        .withColumn("_cut", cut)
        .select(
            "lang", F.array_join("path", " ").alias("phrase"), F.col("n").alias("a"), "_cut.l", "_cut.r",
            F.get("_starts", F.lit(0)).alias("n"), F.col("_cut.score").alias("score"), "_cut.cut",
        )
    )


def ranked(found: DataFrame, top: int = TOP, spread: int = 64) -> DataFrame:
    """The first ``top`` of each lang with their ``rank``; each lang's rows meet only after a first choice in parts."""
    order = [F.desc("score"), F.desc("a"), "phrase"]
    part = F.pmod(F.xxhash64("phrase"), F.lit(spread))
    chosen = (
        found.withColumn("_part", part)
        .withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order)))
        .where(F.col("rank") <= top)
    )
    last = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    return chosen.withColumn("rank", last).where(F.col("rank") <= top).drop("_part")
