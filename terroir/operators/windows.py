"""Window operators.

Global windows (no PARTITION BY) only ever run on small *aggregated* frames
(series per period, rankings of dimension members); fact-sized frames use
partitioned windows or the two-pass ids of ``operators.ids``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedup_by_id(df: DataFrame, id_col: str) -> DataFrame:
    """One row per id.  The survivor is the smallest row (deterministic).

    Only the ids that repeat are sorted by all columns; a hash aggregate of
    the id column finds them, the other rows pass unsorted.  Whether there are
    any is asked first: where none repeats, no row is moved."""
    others = [c for c in df.columns if c != id_col]
    repeated = df.groupBy(id_col).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(F.col(id_col).alias("_id"))
    if repeated.isEmpty():
        return df
    same = F.col(id_col).eqNullSafe(F.col("_id"))
    w = Window.partitionBy(id_col).orderBy(*[F.col(c).asc_nulls_last() for c in others])
    chosen = df.join(repeated, same, "left_semi").withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
    return df.join(repeated, same, "left_anti").unionByName(chosen)


def chronological_index(df: DataFrame, period: str, partition: list[str] | None = None,
                        name: str = "orden") -> DataFrame:
    """row_number() over (order by period) - 1, optionally per series."""
    w = Window.partitionBy(*(partition or [])).orderBy(period)
    return df.withColumn(name, (F.row_number().over(w) - 1).cast("int"))


def rank_index(df: DataFrame, value: str, label: str, partition: list[str] | None = None,
               name: str = "orden") -> DataFrame:
    """row_number() over (order by value desc) - 1 with a label tie-break."""
    w = Window.partitionBy(*(partition or [])).orderBy(F.col(value).desc(), F.col(label).asc())
    return df.withColumn(name, (F.row_number().over(w) - 1).cast("int"))


def top_n_by_rank(df: DataFrame, value: str, label: str, n: int = 12,
                  partition: list[str] | None = None, name: str = "orden") -> DataFrame:
    """Rank then keep orden < n (Catalyst infers a window group limit)."""
    return rank_index(df, value, label, partition, name).filter(F.col(name) < n)


def quintile(df: DataFrame, value: str, tie: str, name: str, buckets: int = 5) -> DataFrame:
    """Quantile bucket of rank(method='first') the way qcut on ranks does.

    rn = position by (value, tie); bucket = max(1, ceil(q*(rn-1)/(n-1))) with
    integer ceil-division.  rn comes from the two-pass dense numbering (no
    single-partition window however many clients), n from a scalar count.
    """
    from terroir.operators.ids import global_row_number
    n = df.agg(F.count(F.lit(1))).scalar()
    rn = F.col("_rn")
    num = (rn - 1) * buckets
    den = n - 1
    ceil_div = F.when(den <= 0, F.lit(1)).otherwise(F.floor((num + den - 1) / den))
    return (global_row_number(df, [value, tie], "_rn")
            .withColumn(name, F.greatest(F.lit(1), ceil_div).cast("int")).drop("_rn"))


def quintiles(df: DataFrame, metrics: dict[str, str], tie: str, buckets: int = 5) -> DataFrame:
    """W05 for several metrics in ONE numbering pass: the metrics are stacked
    as (name, value) rows, ranked within each name by the two-pass ids, then
    pivoted back (explicit pivot values) and joined on ``tie``."""
    from terroir.operators.ids import rank_within_groups
    n = df.agg(F.count(F.lit(1))).scalar()
    stacked = df.select(tie, F.explode(F.array(*[F.struct(F.lit(k).alias("_q"), F.col(c).cast("double").alias("_v"))
                                                   for k, c in metrics.items()])).alias("_s")).select(tie, "_s.*")
    ranked = rank_within_groups(stacked, "_q", ["_v", tie], "_rn")
    num = (F.col("_rn") - 1) * buckets
    den = n - 1
    b = F.greatest(F.lit(1), F.when(den <= 0, F.lit(1)).otherwise(F.floor((num + den - 1) / den))).cast("int")
    wide = ranked.groupBy(tie).pivot("_q", list(metrics)).agg(F.first(b))
    return df.join(wide, tie)


def zscore(df: DataFrame, series: str, value: str, eps: float = 1e-9) -> DataFrame:
    """Z against the whole series' mean and population std; 0 if std ≤ eps."""
    w = Window.partitionBy(series)
    mu = F.avg(value).over(w)
    sd = F.stddev_pop(value).over(w)
    return (df.withColumn("media", mu).withColumn("sigma", sd)
            .withColumn("z", F.when(F.col("sigma") > eps, (F.col(value) - F.col("media")) / F.col("sigma"))
                        .otherwise(F.lit(0.0))))



def latest_by(df: DataFrame, keys: list[str], ts: str) -> DataFrame:
    """Per key the newest record (max_by over a struct, no sort)."""
    others = [c for c in df.columns if c not in keys]
    agg = df.groupBy(*keys).agg(F.max_by(F.struct(*others), F.col(ts)).alias("_l"))
    return agg.select(*keys, *[F.col(f"_l.{c}").alias(c) for c in others])
