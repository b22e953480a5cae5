"""Work on groups of any size, and the shared folder for intermediate data.

Positions come from a range partitioning over keys and order together, so a hot
group lies on as many tasks as it needs; blocks are cut by position and depend
neither on the size of a group nor on where partitions end. Joins need no help
from here: adaptive execution splits the partitions of hot keys, and no count
runs ahead of the real work.
"""

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def shared_folder(spark) -> str:
    """The session's checkpoint folder; only a local session without one gets a temporary folder, removed at its end."""
    sc = spark.sparkContext
    folder = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="cartoloom-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage through the shared checkpoint folder of the cluster."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_path(spark, name) -> str:
    """A fresh path below the shared checkpoint folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name) -> DataFrame:
    """Cut the lineage like ``checkpoint``, through compressed files that are read by column; for wide or many rows."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def group_position(df: DataFrame, keys, order, name) -> DataFrame:
    """0-based position of every row inside its group; ``order`` should tell all rows of a group apart.

    Rows are range partitioned and written once. Only a partition's first group
    can have begun in an earlier one, so the table of starts has at most one row
    per partition, which bounds its broadcast.
    """
    keys = list(keys)
    ranged = checkpoint(df.repartitionByRange(*keys, *order).withColumn("_pid", F.spark_partition_id()))
    counts = ranged.groupBy(*keys, "_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("_start", F.sum("_n").over(before)).where("_start > 0").select(
        F.col("_pid").alias("_at"), "_start", *[F.col(k).alias(f"_at_{k}") for k in keys])
    same = F.col("_pid") == F.col("_at")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_at_{k}"))
    rank = F.row_number().over(Window.partitionBy("_pid", *keys).orderBy(*order)) - 1
    out = ranged.withColumn("_rank", rank).join(F.broadcast(starts), same, "left")
    return out.select(*df.columns, (F.coalesce("_start", F.lit(0)) + F.col("_rank")).cast("bigint").alias(name))


def dense_index(df: DataFrame, order, name) -> DataFrame:
    """0-based dense position in a total order, without ordering everything in one task."""
    return group_position(df, [], order, name)


def chunked(df: DataFrame, keys, order, size, chunk_col="chunk") -> DataFrame:
    """Number blocks of ``size`` rows inside every group, by position; the last block may be shorter."""
    return group_position(df, keys, order, "_pos").withColumn(chunk_col, F.floor(F.col("_pos") / size)).drop("_pos")


def sorted_arrays(df: DataFrame, keys, order, value, name, size=10_000, part="part") -> DataFrame:
    """Sorted arrays of at most ``size`` values per group; read in ``part`` order they are one sorted list."""
    blocks = chunked(df, keys, order, size, part)
    return blocks.groupBy(*keys, part).agg(F.sort_array(F.collect_list(value)).alias(name))
