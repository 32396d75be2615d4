"""Written hand-offs between the steps of an operator.

Every intermediate result that is read more than once, or that must not be
recomputed after an executor is lost, is written as Parquet below the shared
folder that the cluster names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from terroir.session import ensure_checkpoint_dir


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back (cuts the lineage)."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
