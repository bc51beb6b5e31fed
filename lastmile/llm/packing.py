"""Packing token sequences of fixed length by non-negative least squares.

Documents are cut into full windows and a rest; a rest over half a window gives up half a
window. Only the histogram of piece lengths, at most one count per length, is packed on the
driver: shallow combinations of lengths that fill a window are enumerated, a non-negative
least-squares fit says how often to repeat each, the counts are rounded down, and what is
left is packed greedily. The resulting plan is as small as the histogram; pieces find their
place in it by their rank among pieces of their length.
"""

from __future__ import annotations

import base64
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lastmile.operators.sizing import written

WINDOW = 1024
END_OF_TEXT = 0
SPECIAL = "<|endoftext|>"
# The vocabulary's own pre-token pattern, with possessive repeats: the same pieces, found faster.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
PIECES_PER_BUCKET = 2_000
TRIPLES_PER_LENGTH = 6
ITERATIONS = 400


def load_encoding(path: str):
    """The byte-level vocabulary of a rank file; the special string has the next free id."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "packing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={SPECIAL: len(ranks)}
    )


def encode(encoding, text: str) -> np.ndarray:
    allowed = "all" if SPECIAL in text else set()
    ids = encoding.encode_to_numpy(text, allowed_special=allowed, disallowed_special=())
    return np.append(ids, END_OF_TEXT).astype("<u4")


def cut_points(tokens: int, window: int = WINDOW) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full windows, then a rest of at most half a window."""
    full = tokens // window * window
    pieces = [(at, window) for at in range(0, full, window)]
    rest, half = tokens - full, window // 2
    if rest > half:
        pieces.append((full, half))
        full, rest = full + half, rest - half
    return pieces + ([(full, rest)] if rest else [])


def tokenized_pieces(
    docs: DataFrame, rank_file: str, id_column: str = "doc_id", text: str = "text", window: int = WINDOW,
    keep_ids: bool = False,
) -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens[, ids]) of every document's pieces."""
    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long"
    schema += ", ids array<int>" if keep_ids else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = load_encoding(rank_file)
        for batch in batches:
            done: dict[str, list] = {}  # copies within a batch are encoded once
            texts, owner, rows = batch.column(1).to_pylist(), [], []
            for i, value in enumerate(texts):
                value = value or ""
                if (pieces := done.get(value)) is None:
                    ids = encode(encoding, value)
                    pieces = done[value] = [
                        (a, n, zlib.crc32(ids[a : a + n]), len(ids), *([ids[a : a + n].astype("i4")] if keep_ids else []))
                        for a, n in cut_points(len(ids), window)
                    ]
                owner += [i] * len(pieces)
                rows += pieces
            columns = [batch.column(0).take(pa.array(owner, pa.int64()))]
            columns += [pa.array([r[k] for r in rows], pa.int64()) for k in range(4)]
            if keep_ids:
                columns.append(pa.array([r[4] for r in rows], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in schema.split(", ")])

    return docs.select(id_column, text).mapInArrow(run, schema)


def combinations(counts: np.ndarray, window: int = WINDOW) -> list[dict[int, int]]:
    """Length combinations of at most three different lengths that fill a window exactly.

    For each present length: with two others at a few evenly spaced choices of the second,
    and repeated as often as some other length fills the remainder.
    """
    present = [n for n in np.flatnonzero(counts).tolist() if 0 < n <= window]
    here, found = set(present), {}

    def add(*lengths: int) -> None:
        combo: dict[int, int] = {}
        for n in lengths:
            combo[n] = combo.get(n, 0) + 1
        found[tuple(sorted(combo.items()))] = combo

    for a in present:
        if a == window:
            add(a)
            continue
        seconds = [b for b in present if b <= a and window - a - b in here and window - a - b <= b]
        for k in range(min(TRIPLES_PER_LENGTH, len(seconds))):
            b = seconds[k * len(seconds) // min(TRIPLES_PER_LENGTH, len(seconds))]
            add(a, b, window - a - b)
        for times in range(window // a, 0, -1):
            left = window - a * times
            if not left:
                add(*[a] * times)
            elif left in here:
                add(*[a] * times, left)
                if left <= a:
                    break
    return list(found.values())


def nonnegative_fit(combos: list[dict[int, int]], counts: np.ndarray, iterations: int = ITERATIONS) -> np.ndarray:
    """Repeat counts x >= 0 that minimise the squared distance of their lengths to the histogram.

    Accelerated projected gradient on the sparse columns, scaled to the histogram.
    """
    column = np.repeat(np.arange(len(combos)), [len(c) for c in combos])
    row = np.array([n for c in combos for n in c], np.int64)
    times = np.array([t for c in combos for t in c.values()], float)
    forward = lambda x: np.bincount(row, times * x[column], len(counts))
    backward = lambda r: np.bincount(column, times * r[row], len(combos))
    v = np.ones(len(combos))
    for _ in range(30):  # largest eigenvalue by power iteration
        v = backward(forward(v))
        top = np.linalg.norm(v)
        v /= top
    step, target = 1.0 / (1.05 * top), counts.astype(float)
    x = y = np.zeros(len(combos))
    momentum = 1.0
    for _ in range(iterations):
        after = np.maximum(0.0, y - step * backward(forward(y) - target))
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        y = after + (momentum - 1) / following * (after - x)
        x, momentum = after, following
    return x


@dataclass
class Plan:
    """Where pieces go. Row i: pieces of ``length`` from rank ``first`` on, ``per`` of them in
    each sequence from ``sequence`` on, the first at ``offset``."""

    length: np.ndarray
    first: np.ndarray
    per: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    total: np.ndarray  # pieces by length

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        base = np.concatenate(([0], np.cumsum(self.total)))
        at = np.searchsorted(base[self.length] + self.first, base[length] + rank, side="right") - 1
        inside = rank - self.first[at]
        return self.sequence[at] + inside // self.per[at], self.offset[at] + inside % self.per[at] * length


def greedy(left: dict[int, int], window: int) -> Iterator[tuple[dict[int, int], int]]:
    """Longest-first combinations of what is left and how often to repeat each.

    Every step uses up some length, so there are at most as many steps as lengths.
    """
    lengths = sorted(left)
    while lengths:
        room, combo, upto = window, {}, len(lengths)
        while room and (upto := bisect_right(lengths, room, 0, upto)):
            n = lengths[upto - 1]
            take = min(room // n, left[n])
            combo[n] = take
            room -= n * take
            upto -= 1
        times = min(left[n] // take for n, take in combo.items())
        for n, take in combo.items():
            left[n] -= take * times
            if not left[n]:
                lengths.remove(n)
        yield combo, times


def plan(counts: np.ndarray, window: int = WINDOW) -> Plan:
    """Pack a histogram (pieces by length) into windows."""
    left = {n: int(c) for n, c in enumerate(counts) if n and c}
    used = dict.fromkeys(left, 0)
    rows, sequence = [], 0

    def emit(combo: dict[int, int], times: int) -> None:
        nonlocal sequence
        offset = 0
        for n, take in sorted(combo.items(), reverse=True):
            rows.append((n, used[n], take, sequence, offset))
            used[n] += take * times
            offset += n * take
        sequence += times

    combos = combinations(counts, window)
    if combos:
        wanted = np.floor(nonnegative_fit(combos, counts) + 1e-6).astype(int)
        for i in np.argsort(-wanted, kind="stable").tolist():
            combo = combos[i]
            times = min(int(wanted[i]), *(left[n] // take for n, take in combo.items()))
            if times > 0:
                emit(combo, times)
                for n, take in combo.items():
                    left[n] -= take * times
    for combo, times in greedy({n: c for n, c in left.items() if c}, window):
        emit(combo, times)
    rows.sort()
    columns = [np.array(c, np.int64) for c in zip(*rows)] or [np.zeros(0, np.int64)] * 5
    return Plan(*columns, total=np.asarray(counts, np.int64))


def ranked(pieces: DataFrame, per_bucket: int = PIECES_PER_BUCKET) -> DataFrame:
    """Add ``_rank`` among the pieces of a length, from 0, without gathering a length in one task.

    Pieces are dealt into hashed buckets; ranks count inside a bucket and over bucket sizes.
    """
    buckets = max(1, pieces.count() // per_bucket)
    dealt = pieces.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "start"), F.lit(buckets)))
    sizes = dealt.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    across = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("length", "_bucket", F.coalesce(F.sum("_n").over(across), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("length", "_bucket").orderBy("doc_id", "start", "ids_crc32")
    return (
        dealt.withColumn("_inside", F.row_number().over(inside) - 1)
        .join(before, ["length", "_bucket"])
        .withColumn("_rank", F.col("_before") + F.col("_inside"))
        .drop("_bucket", "_inside", "_before")
    )


def packed(
    docs: DataFrame, rank_file: str, id_column: str = "doc_id", text: str = "text", window: int = WINDOW,
    keep_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids].

    Null and empty texts are the single end token. Repeated rows are documents of their own,
    null ids are kept. Sequence numbers are gapless; an empty table gives no rows. Columns
    beside the id and the text are ignored.
    """
    pieces = written(tokenized_pieces(docs, rank_file, id_column, text, window, keep_ids))
    histogram = np.zeros(window + 1, np.int64)
    for row in pieces.groupBy("length").count().collect():  # at most one row per length
        histogram[row["length"]] = row["count"]
    packing = plan(histogram, window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "_rank"))
            sequence, offset = packing.place(length, rank)
            names = [n for n in batch.schema.names if n != "_rank"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
                [*names, "sequence_id", "offset"],
            )

    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema)
    return ranked(pieces).select(*pieces.columns, "_rank").mapInArrow(
        run, f"{columns}, sequence_id long, offset long"
    ).withColumnRenamed("doc_id", id_column)


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids): the packed sequences of ``packed(..., keep_ids=True)``, at most a window long."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return pieces.groupBy("sequence_id").agg(parts.alias("_p")).select(
        "sequence_id", F.flatten(F.transform("_p", lambda p: p["ids"])).alias("ids")
    )
