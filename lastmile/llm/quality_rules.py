"""Quality rules: counted base rules, then zstandard compression bands.

A text is compressed whole and in chunks of fixed size. Repetitive text compresses too well,
encoded or random text hardly at all; what is usual depends on the length, so each band of
lengths has its own limits.
"""

from __future__ import annotations

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lastmile.llm.batches import per_slice

WHITE = " \t\n\r\v\f"
SYMBOLS = "[#*$%&|<>]"
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50

# From so many UTF-8 bytes on, the ratio (bytes before / after) that is usual.
# Prose lies well inside; random letters or base64 lie below, repeated lines above.
BANDS = (
    (0, 0.0, float("inf")),
    (256, 1.20, 2.20),
    (512, 1.35, 2.35),
    (1024, 1.50, 2.50),
    (2048, 1.65, 2.70),
    (4096, 1.70, 2.90),
    (8192, 1.75, 3.10),
    (16384, 1.75, 3.40),
    (65536, 1.75, 3.80),
)
LEVEL = 3
CHUNK_BYTES = 2048
MAX_BAD_CHUNKS = 0.25  # share of the chunks that may lie outside their limits


def repeated_words(words: list[bytes], width: int = 3) -> int:
    """Words inside windows of ``width`` words that are found twice or more."""
    if len(words) <= width:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    window = np.zeros(len(words) - width + 1, np.int64)
    roomy = len(numbers) ** width >= 2**63
    for i in range(width):
        window = window * len(numbers) + ids[i : i + len(window)]
        if roomy:  # number the windows anew at each step, so that keys never overflow
            window = np.unique(window, return_inverse=True)[1].astype(np.int64)
    _, number, times = np.unique(window, return_inverse=True, return_counts=True)
    twice = times[number] > 1
    covered = np.zeros(len(words), bool)
    for i in range(width):
        covered[i : i + len(window)] |= twice
    return int(covered.sum())


def duplicate_lines(text: str) -> int:
    lines = [line for line in text.split("\n") if line.strip(WHITE)]
    return len(lines) - len(set(lines))


def outside(size: int, ratio: float, bands=BANDS) -> bool:
    low, high = next((lo, hi) for least, lo, hi in reversed(bands) if size >= least)
    return not low <= ratio <= high


def compression(data: bytes, compressor, bands=BANDS, chunk: int = CHUNK_BYTES) -> tuple[float, float]:
    """(ratio of the whole, share of chunks outside their limits); (0, 0) for no bytes."""
    if not data:
        return 0.0, 0.0
    ratio = lambda part: len(part) / len(compressor.compress(part))
    whole = ratio(data)
    if len(data) <= chunk:
        return whole, float(outside(len(data), whole, bands))
    parts = [data[i : i + chunk] for i in range(0, len(data), chunk)]
    return whole, sum(outside(len(p), ratio(p), bands) for p in parts) / len(parts)


def judged(
    docs: DataFrame, text: str = "text", bands=BANDS, chunk_bytes: int = CHUNK_BYTES,
    max_bad_chunks: float = MAX_BAD_CHUNKS,
) -> DataFrame:
    """The rows with counts, ``ratio``, ``bad_chunks``, ``base_failed`` and ``kept``.

    Null and empty texts have no words, fail the base rule and are not kept. Columns of the
    same names as the results are replaced. Repeated rows are judged alike.
    """
    schema = (
        "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
        " ratio double, bad_chunks double, in_band boolean"
    )

    def prepare():
        compressor = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)

        def judge(value: str | None) -> tuple:
            value = value or ""
            data = value.encode()
            words = data.split()
            whole, bad = compression(data, compressor, bands, chunk_bytes)
            return (
                len(words), len(value) - sum(map(value.count, WHITE)),
                sum(map(value.count, SYMBOLS[1:-1])), duplicate_lines(value), repeated_words(words),
                whole, bad, not outside(len(data), whole, bands) and bad <= max_bad_chunks,
            )

        return lambda texts: [judge(t) for t in texts]

    names = [c.split()[0] for c in schema.split(",")][:-1]
    own = [c for c in docs.columns if c not in (*names, "base_failed", "kept", "_judged")]
    base_failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    )
    return (
        docs.withColumn("_judged", per_slice(text, schema, prepare))
        .select(*own, *[F.col(f"_judged.{n}").alias(n) for n in names], F.col("_judged.in_band").alias("_in"))
        .withColumn("base_failed", base_failed)
        .withColumn("kept", ~F.col("base_failed") & F.col("_in"))
        .drop("_in")
    )
