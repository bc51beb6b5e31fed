"""SimHash near-duplicate groups by deletion-variant signatures.

The 64 fingerprint bits are cut into so few segments that two linked fingerprints differ by
at most one bit in one of them. Each segment value is indexed as it is and once for every
bit left out (a wildcard), so linked fingerprints share an index key. Rows of equal keys meet
in one sorted run, where the bit distance is verified.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lastmile.llm.graph import components
from lastmile.llm.shield import restored, shielded
from lastmile.operators.sizing import small_side, written

BITS = 64
BLOCK = 4096  # fingerprints of one key that are compared with each other in one piece of work
SHORT_RUN = 16
HASHES_AT_ONCE = 65_536


def fingerprint(text: str | None, shingle: int = 4, seed: int = 42) -> int:
    """Majority bits of the XXH64 of all word shingles, as a signed 64-bit integer."""
    words = (text or "").encode().lower().split()  # bytes: only A-Z and only ASCII white space
    if not words:
        return 0
    joined = memoryview(b" ".join(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1)).tolist()
    ends = ends[shingle - 1 :].tolist() or [len(joined)]
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(ends), HASHES_AT_ONCE):
        part = zip(starts[at : at + HASHES_AT_ONCE], ends[at : at + HASHES_AT_ONCE])
        hashes = np.array([digest(joined[a:b], seed) for a, b in part], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    majority = np.packbits(2 * ones > len(ends), bitorder="little")
    return int(majority.view("<i8")[0])


def with_fingerprint(docs: DataFrame, text: str, shingle: int, name: str) -> DataFrame:
    @F.pandas_udf("long")
    def fingerprints(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in texts:
            yield pd.Series([fingerprint(t, shingle) for t in part], dtype="int64")

    return docs.withColumn(name, fingerprints(F.col(text)))


def segments(max_distance: int) -> list[tuple[int, int]]:
    """(first bit, width): the fewest segments of which one has at most one differing bit."""
    count = max_distance // 2 + 1
    cuts = [round(i * BITS / count) for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _value(first: int, width: int):
    return F.shiftrightunsigned("fp", first).bitwiseAND(F.lit((1 << width) - 1).cast("long"))


def variants(points: DataFrame, max_distance: int) -> DataFrame:
    """(fp, key, side): one row for each segment as it is and for each wildcard in it.

    ``side`` is the bit under the wildcard: equal sides have equal segments and meet under
    the segment's own key, so under a wildcard only unequal sides are compared.
    """
    entries = []
    for number, (first, width) in enumerate(segments(max_distance)):
        value = _value(first, width)
        tag = lambda wildcard: F.lit((number * (BITS + 1) + wildcard) << 40).cast("long")  # noqa: B023, E731
        entries.append(F.struct((tag(0) + value).alias("key"), F.lit(0).cast("tinyint").alias("side")))
        for bit in range(width):
            rest = value.bitwiseAND(F.lit(((1 << width) - 1) ^ (1 << bit)).cast("long"))
            side = F.shiftrightunsigned(value, bit).bitwiseAND(F.lit(1).cast("long"))
            entries.append(F.struct((tag(bit + 1) + rest).alias("key"), side.cast("tinyint").alias("side")))
    return points.select("fp", F.explode(F.array(*entries)).alias("_v")).select("fp", "_v.key", "_v.side")


def crowded_keys(points: DataFrame, max_distance: int, block: int) -> DataFrame:
    """Keys with more than a block of fingerprints and the number of blocks they are cut into.

    Counted over the plain segment values, of which there are three for a fingerprint and
    not sixty-seven; a wildcard's key holds two of them.
    """
    counted = []
    for number, (first, width) in enumerate(segments(max_distance)):
        value = _value(first, width)
        counted.append(F.struct(F.lit(number).alias("segment"), value.alias("value"), F.lit(width).alias("width")))
    full = (
        points.select(F.explode(F.array(*counted)).alias("_s")).select("_s.*")
        .groupBy("segment", "value", "width").agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > block // 2)
    )
    wildcards = F.expr(
        f"transform(sequence(0, width), w -> shiftleft(CAST(segment * {BITS + 1} + w AS BIGINT), 40)"
        " + CASE WHEN w = 0 THEN value ELSE value & ~shiftleft(1L, w - 1) END)"
    )
    return (
        full.select(F.explode(wildcards).alias("key"), "n")
        .groupBy("key").agg(F.sum("n").alias("n"))
        .where(F.col("n") > block)
        .select("key", F.ceil(F.col("n") / F.lit(block)).cast("int").alias("blocks"))
    )


def cells(index: DataFrame, crowded: DataFrame) -> DataFrame:
    """Index rows with the cell they are compared in and their part of it (-1: all pairs).

    The rows of a crowded key are dealt into blocks; each pair of blocks is a cell.
    """
    wildcard = F.shiftright("key", 40) % (BITS + 1) != 0
    block = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    others = F.expr("transform(sequence(0, blocks - 1), o -> struct(least(_b, o) AS low, greatest(_b, o) AS high))")
    plain = F.when(wildcard, F.col("side").cast("int")).otherwise(F.lit(-1))
    return (
        index.join(crowded, "key", "left")
        .withColumn("_b", F.coalesce(block, F.lit(0)))
        .withColumn("_o", F.explode(F.when(F.col("blocks").isNull(), F.expr("array(struct(0 AS low, 0 AS high))")).otherwise(others)))
        .select(
            "fp", "key", F.expr("_o.low * coalesce(blocks, 1) + _o.high").cast("int").alias("cell"),
            F.when(~wildcard & (F.col("_o.low") != F.col("_o.high")), (F.col("_b") == F.col("_o.high")).cast("int"))
            .otherwise(plain).alias("part"),
        )
    )


class Links:
    """Linked pairs of one task; a pair already connected through others is not repeated."""

    def __init__(self) -> None:
        self.above: dict[int, int] = {}
        self.found: list[tuple[int, int]] = []

    def root(self, x: int) -> int:
        above = self.above
        while (up := above.get(x, x)) != x:
            above[x] = x = above.get(up, up)
        return x

    def add(self, a: int, b: int) -> None:
        x, y = self.root(a), self.root(b)
        if x != y:
            self.above[max(x, y)] = min(x, y)
            self.found.append((a, b))


def distance_of(a: np.ndarray, b) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64))  # of a negative number it counts the absolute value


def link_long_run(fp: np.ndarray, part: np.ndarray, distance: int, links: Links) -> None:
    """Search outwards from reached points; only points not yet reached are compared."""
    pool = np.arange(len(fp))
    while len(pool):
        frontier, pool = [pool[0]], pool[1:]
        while frontier and len(pool):
            at = frontier.pop()
            near = distance_of(fp[pool], fp[at]) <= distance
            if part[at] >= 0:
                near &= part[pool] != part[at]
            for other in pool[near].tolist():
                links.add(int(fp[at]), int(fp[other]))
                frontier.append(other)
            pool = pool[~near]


def link_runs(run: np.ndarray, fp: np.ndarray, part: np.ndarray, distance: int, links: Links) -> None:
    """Verified pairs within runs of equal ``run`` numbers; the columns are sorted by run."""
    starts = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
    sizes = np.diff(np.r_[starts, len(run)])
    for a, n in zip(starts[sizes > SHORT_RUN].tolist(), sizes[sizes > SHORT_RUN].tolist()):
        link_long_run(fp[a : a + n], part[a : a + n], distance, links)
    short = np.repeat(sizes <= SHORT_RUN, sizes)
    left = np.flatnonzero(short)
    for step in range(1, SHORT_RUN):
        left = left[left + step < len(run)]
        left = left[run[left] == run[left + step]]
        if not len(left):
            break
        right = left + step
        hit = distance_of(fp[left], fp[right]) <= distance
        hit &= (part[left] < 0) | (part[left] != part[right])
        for a, b in zip(fp[left[hit]].tolist(), fp[right[hit]].tolist()):
            links.add(a, b)


def verified_links(placed: DataFrame, distance: int) -> DataFrame:
    """Links (a, b) among fingerprints that share a cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        links, rest = Links(), None
        for batch in batches:
            columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "cell", "fp", "part")]
            if rest is not None:
                columns = [np.concatenate(x) for x in zip(rest, columns)]
            key, cell = columns[:2]
            if not len(key):
                continue
            change = np.r_[False, (key[1:] != key[:-1]) | (cell[1:] != cell[:-1])]
            number = np.cumsum(change)
            last = int(np.searchsorted(number, number[-1]))  # the last run may go on in the next batch
            link_runs(number[:last], columns[2][:last], columns[3][:last], distance, links)
            rest = [c[last:] for c in columns]
            if len(links.found) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*links.found)], ["a", "b"])
                links.found = []
        if rest is not None:
            link_runs(np.zeros(len(rest[0]), int), rest[2], rest[3], distance, links)
        pairs = links.found
        yield pa.RecordBatch.from_arrays(
            [pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], ["a", "b"]
        )

    together = placed.repartition("key", "cell").sortWithinPartitions("key", "cell")
    return together.select("key", "cell", "fp", "part").mapInArrow(run, "a long, b long")


def near_links(points: DataFrame, max_distance: int = 4, block: int = BLOCK) -> DataFrame:
    """Links (a, b) that connect all pairs of distinct ``fp`` within the bit distance.

    Pairs that other links of a task already connect are left out, so a group of many near
    copies gives about as many links as members and its connected parts stay the same.
    """
    crowded = small_side(crowded_keys(points, max_distance, block))
    return verified_links(cells(variants(points, max_distance), crowded), max_distance)


def rooted(docs: DataFrame, id_column: str, text: str, shingle: int, max_distance: int, block: int) -> DataFrame:
    """The columns but the text, ``_fp``, ``_root`` (a fingerprint that stands for the connected
    group) and ``component_id`` (its smallest non-null id, which unlike groups may share)."""
    own = [c for c in docs.columns if c not in (text, "fingerprint", "component_id", "_fp", "_root")]
    marked = written(with_fingerprint(docs.select(*own, text), text, shingle, "_fp").drop(text))
    points = written(
        marked.groupBy(F.col("_fp").alias("fp")).agg(F.min(id_column).alias("first_id"))
    )
    roots = components(near_links(points.select("fp"), max_distance, block))
    linked = points.join(roots, points.fp == roots.node, "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("_root")
    )
    named = linked.groupBy("_root").agg(F.min("first_id").alias("component_id"))
    by_point = linked.join(named, "_root").select(F.col("fp").alias("_fp"), "_root", "component_id")
    return marked.join(by_point, "_fp").select(*own, "_fp", "_root", "component_id")


def near_groups(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", shingle: int = 4,
    max_distance: int = 4, block: int = BLOCK,
) -> DataFrame:
    """One row per document: its columns but the text, ``fingerprint`` and ``component_id``.

    Null texts count as empty; texts without a word have fingerprint zero and are linked
    like any other. ``component_id`` is the smallest non-null id of the connected group, null
    where the group has none. Repeated rows give one row each. An empty table gives no rows.
    Columns named fingerprint, component_id, _fp or _root in ``docs`` are replaced.
    """
    found = rooted(docs, id_column, text, shingle, max_distance, block)
    own = [c for c in found.columns if c not in ("_fp", "_root", "component_id")]
    return found.select(*own, F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", shingle: int = 4,
    max_distance: int = 4,
) -> DataFrame:
    """The documents without near copies: one of each group stays, that with the smallest id.

    Of several rows with that id, one stays; a row without an id only where its group has no
    other. Groups are those of linked texts, also where unlike texts share an id or have none.
    """
    inner = shielded(docs, (id_column, text))
    keyed = inner.withColumn("_row", F.xxhash64(*inner.columns))
    groups = rooted(keyed.select(id_column, "_row", text), id_column, text, shingle, max_distance, BLOCK)
    first = F.min(F.struct(F.col(id_column).isNull().alias("_none"), F.col(id_column).alias("_id"), "_row"))
    kept = groups.groupBy("_root").agg(first.alias("_k")).select("_k._id", "_k._row")
    rows = keyed.join(kept, (keyed[id_column].eqNullSafe(kept["_id"])) & (keyed["_row"] == kept["_row"]), "left_semi")
    return restored(rows.dropDuplicates([id_column, "_row"]), inner, docs)
