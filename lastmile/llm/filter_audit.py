"""How filters interact: what each removes at each place of every order they can run in.

A document's failed conditions are a mask. Every mask has one packed counter, a big integer
whose fields are all outcomes of all steps of all orders: with five filters 120 orders of five
steps are 600 steps. Packed counters are added up per part, in each task, then in groups
of tasks, then over all; fields are wide enough that no sum reaches the next field. The sums are
unpacked once, one row per part, order and step.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lastmile.llm.batches import per_slice
from lastmile.llm.shield import shielded
from lastmile.operators.sizing import small_side, written

FILTERS = "ABCDE"
SYMBOLS = b"#$%&*|"
UPPER = bytes(range(65, 91))
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_UPPER_PERCENT = 3
OUTCOMES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
FIELD_BITS = 64  # a count of documents stays below 2^63
FAN_IN = 64  # partial sums of one part that a task adds up


def steps(filters: str = FILTERS) -> list[tuple[str, int]]:
    """(order, place of the step from 0), the order of the steps' fields."""
    return [("".join(o), i) for o in itertools.permutations(filters) for i in range(len(filters))]


def outcome(order: str, place: int, mask: int, good: bool, toxic: bool, filters: str = FILTERS) -> tuple[int, ...]:
    """The step's OUTCOMES for one document with the mask of failed filters."""
    failed = {f for i, f in enumerate(filters) if mask >> i & 1}
    here, before = order[place] in failed, bool(failed & set(order[:place]))
    removed = here and not before
    return (
        not here and not before, removed, here and before, failed == {order[place]}, removed and good, removed and toxic,
    )


def packed_counter(mask: int, good: bool, toxic: bool, filters: str = FILTERS) -> int:
    """One document's outcomes of all steps as one integer, a field of FIELD_BITS for each."""
    total = 0
    for n, (order, place) in enumerate(steps(filters)):
        for k, value in enumerate(outcome(order, place, mask, good, toxic, filters)):
            total |= int(value) << FIELD_BITS * (n * len(OUTCOMES) + k)
    return total


def unpacked(total: int, filters: str = FILTERS) -> list[tuple[str, int, tuple[int, ...]]]:
    """(order, place, counts) of a sum of packed counters."""
    width = FIELD_BITS // 8
    data = total.to_bytes(width * len(OUTCOMES) * len(steps(filters)), "little")
    fields = [int.from_bytes(data[i : i + width], "little") for i in range(0, len(data), width)]
    size = len(OUTCOMES)
    return [(o, i, tuple(fields[n * size : (n + 1) * size])) for n, (o, i) in enumerate(steps(filters))]


SUMS = "part string, packed binary"


def counted(filters: str = FILTERS) -> Callable:
    """Packed sums of rows (part, mask, good, toxic) that are sorted by part: one integer is held at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple, int] = {}

        def rows() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(batch.column(i).to_pylist() for i in range(4)))

        for part, group in itertools.groupby(rows(), key=lambda row: row[0]):
            total = 0
            for _, *key in group:
                key = tuple(key)
                if key not in known:
                    known[key] = packed_counter(*key, filters)
                total += known[key]
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.string()), pa.array([as_bytes(total)], pa.binary())], ["part", "packed"])

    return run


def as_bytes(total: int) -> bytes:
    return total.to_bytes(total.bit_length() // 8 + 1, "little")


def merged_group(table: pa.Table) -> pa.Table:
    total = sum(int.from_bytes(x.as_py(), "little") for x in table.column("packed"))
    return pa.table({"part": table.column("part")[:1], "packed": pa.array([as_bytes(total)], pa.binary())})


def packed_sums(masks: DataFrame, filters: str = FILTERS) -> DataFrame:
    """(part, packed): the sum of the packed counters of each part's documents, added up in a tree.

    ``masks`` has part, mask, good, toxic. Each task gives one sum for each part it sees; while
    a part may have more than FAN_IN of them they are added up in groups of tasks.
    """
    sums = written(
        masks.select("part", "mask", "good", "toxic").sortWithinPartitions("part").mapInArrow(counted(filters), SUMS)
        .withColumn("_task", F.spark_partition_id())
    )
    tasks = sums.agg(F.max("_task")).first()[0] or 0
    while tasks >= FAN_IN:
        tasks //= FAN_IN
        sums = sums.withColumn("_task", F.floor(F.col("_task") / FAN_IN).cast("int"))
        sums = written(
            sums.groupBy("_task", "part").applyInArrow(
                lambda key, table: merged_group(table.select(["part", "packed"])).append_column(
                    "_task", pa.array([key[0].as_py()], pa.int32())
                ),
                SUMS + ", _task int",
            )
        )
    return sums.select("part", "packed").groupBy("part").applyInArrow(merged_group, SUMS)


def audited(masks: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, filter order and step (from 1) with the OUTCOMES and ``shapley``.

    ``masks`` has part, mask (bit i: the document fails filter i), good and toxic. ``shapley``
    is what the step's filter removes, summed over all orders at whatever place it has.
    """
    names = ["part", "filter_order", "step", *OUTCOMES, "shapley"]
    kinds = [pa.string(), pa.string(), pa.int32(), *[pa.int64()] * (len(OUTCOMES) + 1)]
    schema = "part string, filter_order string, step int, " + ", ".join(f"{n} long" for n in names[3:])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = unpacked(int.from_bytes(data, "little"), filters)
                removed = dict.fromkeys(filters, 0)
                for order, place, counts in found:
                    removed[order[place]] += counts[OUTCOMES.index("removed")]
                out = [(part, o, i + 1, *counts, removed[o[i]]) for o, i, counts in found]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    return packed_sums(masks, filters).mapInArrow(rows, schema)


def text_facts(text: str | None) -> tuple[bool, bool, bool, bool, bytes]:
    """The conditions A to D of one text, and its digest."""
    text = text or ""
    data = text.encode()
    words = data.split()
    capitals = len(data) - len(data.translate(None, UPPER))
    return (
        len(words) < MIN_WORDS, 100 * len(set(words)) < MIN_DISTINCT_PERCENT * len(words),
        100 * capitals > MAX_UPPER_PERCENT * len(text), len(data.translate(None, SYMBOLS)) < len(data),
        hashlib.sha256(data).digest(),
    )


def failed_filters(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", part: str = "lang",
) -> DataFrame:
    """(part, mask, good, toxic) of each document: which of the filters A to E it fails.

    A: under 200 words; B: under half of the words distinct; C: more than 3 % capitals;
    D: symbols; E: the same text as a document with a smaller id. A null text is empty, a null
    part an empty string. Documents without an id fail no E and cause none. Of repeated labels
    the greater counts; a null label is none. Repeated rows count each. Other columns are not
    read, whatever their names.

    Texts are read once and leave as masks and digests; the smallest id is taken per digest, in
    each task before the shuffle, and only digests with several ids are joined back, by a broadcast
    where their counted number allows.
    """
    facts = per_slice(text, "a boolean, b boolean, c boolean, d boolean, digest binary", lambda: lambda texts: [text_facts(t) for t in texts])
    read = written(
        shielded(docs, (id_column, text, part)).withColumn("_f", facts).select(
            F.col(id_column).alias("_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
            sum(F.when(F.col(f"_f.{n}"), 1 << i).otherwise(0) for i, n in enumerate("abcd")).alias("_mask"),
            F.col("_f.digest").alias("_digest"),
        )
    )
    first = small_side(
        read.groupBy("_digest").agg(F.min("_id").alias("_first"), F.max("_id").alias("_last"))
        .where(F.col("_first") < F.col("_last")).drop("_last")
    )
    known = labels.groupBy(F.col(id_column).alias("_id")).agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")
    )
    copy = F.coalesce(F.col("_id") > F.col("_first"), F.lit(False))
    no = F.lit(False)
    return read.join(first, "_digest", "left").join(known, "_id", "left").select(
        "part", (F.col("_mask") + F.when(copy, 16).otherwise(0)).alias("mask"),
        F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic"),
    )
