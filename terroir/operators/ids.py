"""Dense 1..n ids by a total order without a single-partition window.

``Window.orderBy(...)`` with no partition moves every row to one task.  For a
fact-sized input the ids are instead assigned in two passes over a range
partitioning: per-partition counts (one row per partition) give offsets, and
each row adds its position inside its partition.  The range bounds are sampled from the input, whose row order
after a shuffle is not repeatable, so the ranged frame is checkpointed
(reliable checkpoint in the shared ``spark.checkpoint.dir``) before it is
counted and numbered: both passes then read the same partitions, and a lost
executor re-reads the checkpoint instead of re-sampling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def range_local_index(df: DataFrame, order_cols: list, num_partitions: int | None = None) -> DataFrame:
    """Range-partition by ``order_cols`` and add (_pid, _local): partition id
    and position inside the partition.  The result must be written (or
    checkpointed) before ``attach_row_number`` reads it twice."""
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    cols = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    return (df.repartitionByRange(n, *cols).sortWithinPartitions(*cols)
            .withColumn("_pid", F.spark_partition_id())
            .withColumn("_local", F.monotonically_increasing_id()
                        - F.shiftleft(F.spark_partition_id().cast("long"), 33)))


def attach_row_number(ranged: DataFrame, name: str = "row_num") -> DataFrame:
    """Turn (_pid, _local) of a *stable* (written / checkpointed) ranged frame
    into a global 1-based number: offsets come from per-partition counts
    (one row per partition, broadcast)."""
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid",
        F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"))
    return (ranged.join(F.broadcast(offsets), "_pid")
            .withColumn(name, (F.col("_off") + F.col("_local") + 1).cast("long"))
            .drop("_pid", "_local", "_off"))


def global_row_number(df: DataFrame, order_cols: list, name: str = "row_num",
                      num_partitions: int | None = None) -> DataFrame:
    """Append a 1-based ``name`` column numbering rows by ``order_cols``.

    ``order_cols`` must define a total order (ties are numbered in an
    arbitrary but repeatable way only when the tied rows are identical).
    """
    from terroir.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    ranged = range_local_index(df, order_cols, num_partitions).checkpoint(eager=True)
    return attach_row_number(ranged, name)


def rank_by_first(df: DataFrame, key: str, order_col: str, name: str) -> DataFrame:
    """Dimension ids: one row per ``key``, numbered 1..n by min(order_col)."""
    firsts = df.groupBy(key).agg(F.min(order_col).alias("_first"))
    return global_row_number(firsts, ["_first", key], name).drop("_first")


def rank_within_groups(df: DataFrame, group: str, order_cols: list, name: str) -> DataFrame:
    """1..n per ``group`` by ``order_cols`` for many small groups at once: one
    global numbering ordered by (group, order_cols), minus each group's start
    (one row per group; AQE broadcasts it only when it is
    small at run time).  The input (an aggregate) is
    checkpointed first so the range sampling does not recompute it."""
    numbered = global_row_number(df.checkpoint(eager=True), [group, *order_cols], "_g")
    starts = numbered.groupBy(group).agg(F.min("_g").alias("_start"))
    return (numbered.join(starts, group)
            .withColumn(name, (F.col("_g") - F.col("_start") + 1).cast("int")).drop("_g", "_start"))
