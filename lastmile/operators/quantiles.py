"""Exact quantiles and ranks that do not gather a column in one task.

``percentile`` keeps every distinct value of a group in one reducer, which is fine
for a bounded table and fatal for an unbounded one. Here a row count decides:
up to ``SMALL_ROWS`` rows the built-in is used, beyond it the values are cut into
ranges (boundaries from a mergeable sketch), the ranges are counted, and only the
ranges that hold a wanted rank are looked at; a range that is still large is cut again.
Both ways are exact and give the same results: NaN is the greatest value, ranks on equal
values are that value (infinities too), others are interpolated by the built-in's formula.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lastmile.operators.sizing import written, small_side

SMALL_ROWS = 1_000_000
ROWS_PER_RANGE = 500_000
MAX_RANGES = 10_000  # of one pass; large ranges are cut again in the next


def all_range_bounds(df: DataFrame, columns: list[str], rows: int) -> dict[str, list[float]]:
    """Inner boundaries that cut each column into ranges of roughly equal row counts.

    One pass for all columns; at most MAX_RANGES numbers each reach the driver.
    """
    ranges = min(MAX_RANGES, math.ceil(rows / ROWS_PER_RANGE))
    if ranges < 2 or not columns:
        return {c: [] for c in columns}
    grid = [i / ranges for i in range(1, ranges)]
    found = df.agg(*[F.percentile_approx(c, grid, 10 * ranges).alias(c) for c in columns]).first()
    # NaN has no place in an order, so what is not finite goes before sorting.
    return {c: sorted({b for b in found[c] or [] if math.isfinite(b)}) for c in columns}


def range_bounds(df: DataFrame, value: str, rows: int) -> list[float]:
    return all_range_bounds(df, [value], rows)[value]


def with_range(df: DataFrame, value: str, bounds: list[float]) -> DataFrame:
    """Add ``_range``, the index of the value range; rows without a value are dropped.

    NaN has the last range to itself.
    """
    present = df.where(F.col(value).isNotNull())
    if not bounds:
        return present.withColumn("_range", F.isnan(value).cast("double"))
    splits = [-math.inf, *bounds, math.inf]
    ranged = Bucketizer(splits=splits, inputCol=value, outputCol="_range", handleInvalid="keep")
    return ranged.transform(present)


def _same(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[n].eqNullSafe(right[n]) for n in names])


def _at_ranks(
    df: DataFrame, keys: list[str], value: str, targets: DataFrame, rows: int, last_largest: float = math.inf
) -> DataFrame:
    """(keys, _i, _rank, value): the value at each wanted rank, counted from 0 within its keys.

    Only the ranges that hold a rank are kept. While the largest of them has more rows than
    one sorted run should, they are cut again, as groups of their own; copies of one value,
    which no cut divides, collapse anyway.
    """
    bounds = range_bounds(df, value, rows)
    ranged = with_range(df, value, bounds)
    sizes = ranged.groupBy(*keys, "_range").agg(F.count("*").alias("_n"))
    running = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, 0)
    ended = sizes.withColumn("_end", F.sum("_n").over(running))  # at most MAX_RANGES rows per key
    hit = (ended["_end"] > targets["_rank"]) & (ended["_end"] - ended["_n"] <= targets["_rank"])
    placed = small_side(
        ended.join(targets, _same(ended, targets, keys) & hit).select(
            *[targets[k] for k in keys], "_range", "_n", "_i", "_rank",
            (F.col("_rank") - F.col("_end") + F.col("_n")).alias("_local"),
        )
    )
    spots = small_side(placed.select(*keys, "_range").distinct())
    near = ranged.join(spots, _same(ranged, spots, [*keys, "_range"]), "left_semi")
    inner, level = [*keys, "_range"], f"_range{len(keys)}"
    largest, left = placed.select(*inner, "_n").distinct().agg(F.max("_n"), F.sum("_n")).first()
    if largest and 2 * ROWS_PER_RANGE < largest < last_largest and left < rows:
        deeper = [*keys, level]
        found = _at_ranks(
            written(near.withColumnRenamed("_range", level)), deeper, value,
            placed.select(*keys, F.col("_range").alias(level), "_i", F.col("_local").alias("_rank")), left, largest,
        ).withColumnsRenamed({level: "_range", "_rank": "_local"})
    else:
        counted = near.groupBy(*inner, value).agg(F.count("*").alias("_c"))
        within = Window.partitionBy(*inner).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
        ranked = counted.withColumn("_last", F.sum("_c").over(within))
        here = (ranked["_last"] > placed["_local"]) & (ranked["_last"] - ranked["_c"] <= placed["_local"])
        found = ranked.join(placed, _same(ranked, placed, inner) & here).select(
            *[placed[k] for k in inner], "_i", "_local", ranked[value]
        )
    found = written(found)  # a row per wanted rank
    return found.join(placed, _same(found, placed, [*inner, "_i", "_local"])).select(
        *[placed[k] for k in keys], placed["_i"], placed["_rank"], found[value]
    )


def _ranged_quantiles(
    df: DataFrame, keys: list[str], value: str, probs: list[float], rows: int
) -> DataFrame:
    """One row per key with array ``q``; exact linear interpolation between ranks."""
    kept = df.where(F.col(value).isNotNull())
    wanted = F.array(
        *[F.struct(F.lit(i).alias("i"), F.lit(float(p)).alias("p")) for i, p in enumerate(probs)]
    )
    spots = (
        kept.groupBy(*keys).agg(F.count("*").alias("_total"))
        .withColumn("_w", F.explode(wanted))
        .withColumn("_pos", F.col("_w.p") * (F.col("_total") - 1))
        .select(*keys, F.col("_w.i").alias("_i"), "_pos", F.floor("_pos").alias("_lo"), F.ceil("_pos").alias("_hi"))
    )
    spots = written(spots)
    ranks = F.explode(F.array_distinct(F.array("_lo", "_hi")))
    found = _at_ranks(kept, keys, value, spots.select(*keys, "_i", ranks.alias("_rank")), rows)
    points = found.join(spots, _same(found, spots, [*keys, "_i"])).select(
        *[spots[k] for k in keys], spots["_i"], "_pos", "_lo", "_hi", "_rank", found[value].alias("_v")
    ).groupBy(*keys, "_i", "_pos", "_lo", "_hi").agg(
        F.max(F.when(F.col("_rank") == F.col("_lo"), F.col("_v"))).alias("_a"),
        F.max(F.when(F.col("_rank") == F.col("_hi"), F.col("_v"))).alias("_b"),
    )
    between = (F.col("_hi") - F.col("_pos")) * F.col("_a") + (F.col("_pos") - F.col("_lo")) * F.col("_b")
    exact = F.when(F.col("_a") == F.col("_b"), F.col("_a")).otherwise(between)
    return points.groupBy(*keys).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("_i", exact.alias("v")))), lambda s: s["v"]
        ).alias("q")
    )


def grouped_quantiles(
    df: DataFrame,
    keys: list[str],
    value: str,
    probs: list[float],
    rows: int | None = None,
    small_rows: int = SMALL_ROWS,
) -> DataFrame:
    """Exact quantiles per group: the keys and an array column ``q`` (one entry per prob)."""
    rows = df.count() if rows is None else rows
    df = df.select(*keys, F.col(value).cast("double").alias(value))
    if rows <= small_rows:
        return df.groupBy(*keys).agg(
            F.percentile(value, F.array(*[F.lit(float(p)) for p in probs])).alias("q")
        )
    return _ranged_quantiles(df, keys, value, probs, rows)


def quantiles(
    df: DataFrame,
    wanted: dict[str, list[float]],
    rows: int | None = None,
    small_rows: int = SMALL_ROWS,
) -> dict[str, list[float | None]]:
    """Exact quantiles of several columns as plain numbers: a fit result for literals.

    A column without values gives nulls.
    """
    names = list(wanted)
    if not names:
        return {}
    rows = df.count() if rows is None else rows
    if rows <= small_rows:
        row = df.agg(
            *[
                F.percentile(F.col(c).cast("double"), F.array(*[F.lit(float(p)) for p in ps])).alias(c)
                for c, ps in wanted.items()
            ]
        ).first()
        return {c: list(row[c]) if row[c] is not None else [None] * len(wanted[c]) for c in names}
    probs = sorted({float(p) for ps in wanted.values() for p in ps})
    long = (
        df.select(*[F.col(c).cast("double").alias(c) for c in names])
        .unpivot([], names, "_column", "_value")
        .where(F.col("_value").isNotNull())
    )
    found = {
        r["_column"]: dict(zip(probs, r["q"]))
        for r in _ranged_quantiles(long, ["_column"], "_value", probs, rows * len(names)).collect()
    }
    return {c: [found.get(c, {}).get(float(p)) for p in ps] for c, ps in wanted.items()}


def value_ranks(df: DataFrame, columns: list[str], rows: int | None = None) -> DataFrame:
    """Ranks of the distinct values of several columns, as one long table.

    Per (``_column``, ``_value``): ``_n`` copies, ``_below`` smaller rows, ``_total`` rows.
    Copies collapse before the shuffle; the running count is taken range by range and
    shifted by the ranges before it, so no task sees a whole column.
    """
    rows = df.count() if rows is None else rows
    bounds = all_range_bounds(df, columns, rows)
    parts = []
    for c in columns:
        one = df.select(F.lit(c).alias("_column"), F.col(c).alias("_value"))
        parts.append(with_range(one, "_value", bounds[c]))
    ranged = reduce(lambda a, b: a.unionAll(b), parts)
    counted = written(
        ranged.groupBy("_column", "_range", "_value").agg(F.count("*").alias("_n"))
    )
    sizes = counted.groupBy("_column", "_range").agg(F.sum("_n").alias("n")).collect()
    starts, totals = [], dict.fromkeys(columns, 0)
    for r in sorted(sizes, key=lambda r: (r["_column"], r["_range"])):  # <= MAX_RANGES per column
        starts.append((r["_column"], r["_range"], totals[r["_column"]]))
        totals[r["_column"]] += r["n"]
    offsets = df.sparkSession.createDataFrame(
        [(*s, totals[s[0]]) for s in starts], "_column string, _range double, _start long, _total long"
    )
    within = (
        Window.partitionBy("_column", "_range")
        .orderBy("_value")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        counted.withColumn("_upto", F.sum("_n").over(within))
        .join(F.broadcast(offsets), ["_column", "_range"])
        .select(
            "_column", "_value", "_n",
            (F.col("_start") + F.col("_upto") - F.col("_n")).alias("_below"), "_total",
        )
    )
