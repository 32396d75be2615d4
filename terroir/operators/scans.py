"""Running aggregates per key whose keys may span any number of tasks.

A window ``PARTITION BY key`` brings all rows of a key to one task, so a
key with a third of all rows decides how long the job takes.  Here the rows are
first ranged by (key, order) and checkpointed: a hot key then covers many
partitions, and a partition boundary cuts at most one key.  Each partition runs
its own rows; what a key brings along from the partitions before (or behind)
is one row per (partition, cut key), hence at most two rows per partition, and
is broadcast.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terroir.operators.ids import range_local_index
from terroir.session import ensure_checkpoint_dir

COMBINE = {"sum": lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)), "min": F.least, "max": F.greatest}


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once below the shared folder and read back (cuts the lineage; new column ids, so it joins its own source)."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/terroir/scans/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ranged(df: DataFrame, keys: list[str], order: list[str], num_partitions: int | None = None) -> DataFrame:
    """``df`` ranged and sorted by (keys, order), plus ``_pid`` and ``_local``; written, so both stay as they are."""
    return stored(range_local_index(df, [*keys, *order], num_partitions))


def same(keys: list[str], left: str = "l", right: str = "r") -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def cut_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """(_pid, *keys) of the keys that lie in several partitions of a ranged frame: at most two per partition."""
    ends = df.groupBy("_pid").agg(F.min(F.struct(*keys)).alias("a"), F.max(F.struct(*keys)).alias("b"))
    found = ends.select("_pid", F.explode(F.array_distinct(F.array("a", "b"))).alias("k")).select("_pid", "k.*").collect()
    pids: dict[tuple, list[int]] = {}
    for r in found:
        pids.setdefault(tuple(r)[1:], []).append(r["_pid"])
    rows = [(p, *k) for k, ps in pids.items() if len(ps) > 1 for p in ps]
    return df.sparkSession.createDataFrame(rows, df.select("_pid", *keys).schema)


def running(df: DataFrame, keys: list[str], order: list[str], lanes: dict[str, tuple[str, Column]],
            reverse: bool = False, cut: DataFrame | None = None, cut_on: list[str] | None = None) -> DataFrame:
    """``df`` plus, per lane, the aggregate ('sum', 'min' or 'max') of a column over the key's earlier rows
    (``reverse``: later rows), without the row itself; null (sums: 0) where there is none.

    ``df`` is a ranged frame by ``keys`` and an order of which ``order`` is a sort within the key.
    It may be ranged by some of the keys only, ``cut_on``: what is carried is then one row per partition
    and combination of the other keys within a cut one.
    """
    cut_on = cut_on or keys
    cut = cut_keys(df, cut_on) if cut is None else cut
    sort = [F.col(c).desc() if reverse else F.col(c).asc() for c in order]
    here = Window.partitionBy("_pid", *keys).orderBy(*sort).rowsBetween(Window.unboundedPreceding, -1)
    agg = {"sum": F.sum, "min": F.min, "max": F.max}
    local = df.withColumns({f"_here_{n}": agg[kind](c).over(here) for n, (kind, c) in lanes.items()})
    parts = df.alias("l").join(F.broadcast(cut.alias("r")), (F.col("l._pid") == F.col("r._pid")) & same(cut_on)).select("l.*")
    totals = parts.groupBy("_pid", *keys).agg(*[agg[kind](c).alias(f"_all_{n}") for n, (kind, c) in lanes.items()])
    pid = F.col("_pid").desc() if reverse else F.col("_pid").asc()
    before = Window.partitionBy(*keys).orderBy(pid).rowsBetween(Window.unboundedPreceding, -1)     # cut keys only
    carried = totals.select("_pid", *keys, *[agg[kind](f"_all_{n}").over(before).alias(f"_in_{n}") for n, (kind, _) in lanes.items()])
    joined = local.alias("l").join(F.broadcast(carried.alias("r")), (F.col("l._pid") == F.col("r._pid")) & same(keys), "left")
    return joined.select(*[F.col(f"l.{c}") for c in df.columns],
                         *[COMBINE[kind](F.col(f"l._here_{n}"), F.col(f"r._in_{n}")).alias(n) for n, (kind, _) in lanes.items()])
