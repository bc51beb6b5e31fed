"""Connected parts of a graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lastmile.operators.sizing import release, written


def _toward_smallest(links: DataFrame, upper_only: bool) -> DataFrame:
    """Point each neighbour at the smallest node that its neighbour sees.

    ``upper_only``: for each node take all its neighbours and move the greater ones;
    otherwise take the smaller neighbours and move them and the node.
    """
    both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v"))) if upper_only else links
    smallest = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    if upper_only:
        moved = links.select(F.col("v").alias("u"), F.col("u").alias("v"))  # u: the smaller end
        return moved.join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    near = links.join(smallest, "u")
    return near.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(
        smallest.select("u", F.col("m").alias("v"))
    )


def _clean(links: DataFrame) -> DataFrame:
    return links.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    ).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every linked node but the roots; root: the smallest node of its part.

    Alternates the two star operations until the links stay as they are; each round is
    written to the shared folder. Every node's neighbours are only aggregated, never listed.
    """
    a, b = links.columns[:2]
    current = written(_clean(links.select(F.col(a).alias("u"), F.col(b).alias("v"))))
    state = None
    while True:
        now = current.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now[0] == 0 or now == state:
            return current.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state, before = now, current
        current = written(_clean(_toward_smallest(_clean(_toward_smallest(current, True)), False)))
        release(before)
