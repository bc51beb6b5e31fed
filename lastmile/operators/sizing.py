"""Decisions that depend on the measured size of a side, and cutting of lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
COPIES_PER_CHUNK = 100_000


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder every executor can reach.

    It is the one named in ``spark.checkpoint.dir``. Only a session in one process
    (tests, a laptop) may go without it and gets a folder of its own; on a cluster a
    folder of the driver's machine would lose rows, so that a missing one is an error.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not runs_in_one_process(context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="lastmile-checkpoint-"))
    return context.getCheckpointDir().rstrip("/")


def runs_in_one_process(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def delete_at_exit(spark: SparkSession, path: str) -> None:
    """Have the file system remove the folder when the session's process ends."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(folder)


def release(df: DataFrame) -> None:
    """Remove the files of a ``written`` table that nothing reads any more."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame) -> DataFrame:
    """Write the frame once as a table in the shared folder and read on from there.

    Cuts the lineage, so that later passes neither repeat the work nor depend on lost
    executors; being columnar, they read only the columns they use.
    """
    path = f"{shared_folder(df.sparkSession)}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    delete_at_exit(df.sparkSession, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """Like ``written`` with rows and partitions kept as they are."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def small_side(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """A join side: materialised once, broadcast only when its counted rows are few.

    Beyond the limit the plain join is used, where adaptive execution splits hot keys.
    """
    kept = written(df)
    return F.broadcast(kept) if kept.count() <= limit else kept


def repeat_rows(df: DataFrame, times: str) -> DataFrame:
    """Every row as often as its ``times`` column says, without that column.

    Many copies are written out in chunks spread over the tasks, so no single task
    emits a whole group of copies.
    """
    kept = [c for c in df.columns if c != times]
    size = F.lit(COPIES_PER_CHUNK).cast("long")
    chunked = (
        df.where(F.col(times) > 0)
        .withColumn("_chunks", F.ceil(F.col(times) / size).cast("long"))
        .withColumn("_chunk", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_chunks"))))
        .repartition(*kept, "_chunk")
    )
    copies = F.least(size, F.col(times) - (F.col("_chunk") - 1) * size).cast("int")
    return chunked.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), copies))).select(*kept)


def running_before(
    df: DataFrame, order: list[str], weight: str | None = None, name: str = "_before"
) -> DataFrame:
    """Add the number of rows (or the summed weight) that come earlier in the order.

    A range sort is written once; totals run inside each sorted partition and are
    shifted by the partitions before it. Only partition totals reach the driver.
    Rows should be distinct in the order columns, so that the sort spreads evenly.
    """
    size = F.col(weight) if weight else F.lit(1).cast("long")
    placed = checkpointed(df.sort(*order)).withColumns(
        {"_part": F.spark_partition_id(), "_size": size}
    )
    totals = placed.groupBy("_part").agg(F.sum("_size").alias("n")).collect()
    starts, seen = [], 0
    for r in sorted(totals, key=lambda r: r["_part"]):
        starts.append((r["_part"], seen))
        seen += r["n"]
    offsets = F.broadcast(df.sparkSession.createDataFrame(starts, "_part int, _start long"))
    inside = (
        Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        placed.withColumn("_run", F.sum("_size").over(inside) - F.col("_size"))
        .join(offsets, "_part")
        .withColumn(name, F.col("_start") + F.col("_run"))
        .drop("_part", "_start", "_run", "_size")
    )
