"""Serving aggregates over the reviews star.

Averages are computed as exact sums (integers / decimals) divided by counts
and rounded with ``round_half_up`` so the figures do not depend on partition
order.  Joins to name dimensions are left to AQE (broadcast at runtime when
the dimension is small, shuffled otherwise).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terroir.functions import exact_avg, round_half_up, title_year
from terroir.operators.star import UNKNOWN

ALL = "__ALL__"


def _priced(c="price"):
    return F.when(F.col(c) > 0, F.col(c))


def _avg_points(c="points"):
    return round_half_up(exact_avg(F.sum(F.col(c).cast("long")), F.count(F.lit(1))), 1)


def _avg_price(c="price"):
    return round_half_up(exact_avg(F.sum(_priced(c)), F.count(_priced(c))), 2)


def with_dim(fact: DataFrame, dim: DataFrame, key: str, name_as: str) -> DataFrame:
    """Inner equi join fact → one name dimension."""
    return fact.join(dim.select(key, F.col("nombre").alias(name_as)), key)


def review_kpis(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """One-row KPI vector; dim counts include unknown/unused members."""
    k = fact.agg(
        F.count(F.lit(1)).alias("total_resenas"),
        _avg_points().alias("puntuacion_promedio"),
        _avg_price().alias("precio_promedio"),
        F.max(_priced()).cast("double").alias("precio_maximo"),
        F.min(_priced()).cast("double").alias("precio_minimo"))
    counts = [dims[d].agg(F.count(F.lit(1))).scalar().alias(a)   # J12 scalar subqueries
              for d, a in (("dim_pais", "total_paises"), ("dim_variedad", "total_variedades"),
                           ("dim_bodega", "total_bodegas"))]
    return k.select("*", *counts)


def by_country(fact: DataFrame, dim_pais: DataFrame) -> DataFrame:
    """A02."""
    j = with_dim(fact, dim_pais, "id_pais", "pais").filter(F.col("pais") != UNKNOWN)
    return j.groupBy("pais").agg(
        F.count(F.lit(1)).alias("total"), _avg_points().alias("puntuacion_promedio"),
        _avg_price().alias("precio_promedio"), F.countDistinct("id_variedad").alias("variedades"))


def by_variety(fact: DataFrame, dim_variedad: DataFrame) -> DataFrame:
    """A03."""
    j = with_dim(fact, dim_variedad, "id_variedad", "variedad").filter(F.col("variedad") != UNKNOWN)
    return j.groupBy("variedad").agg(
        F.count(F.lit(1)).alias("total"), _avg_price().alias("precio_promedio"),
        F.count(_priced()).alias("total_con_precio"))


def by_winery(fact: DataFrame, dim_bodega: DataFrame) -> DataFrame:
    """A04."""
    j = with_dim(fact, dim_bodega, "id_bodega", "bodega").filter(F.col("bodega") != UNKNOWN)
    return j.groupBy("bodega").agg(F.count(F.lit(1)).alias("total"), _avg_points().alias("puntuacion_promedio"))


def by_region(fact: DataFrame, dim_region: DataFrame) -> DataFrame:
    """A05."""
    j = with_dim(fact, dim_region, "id_region", "region").filter(F.col("region") != UNKNOWN)
    return j.groupBy("region").agg(F.count(F.lit(1)).alias("total"))


def points_histogram(fact: DataFrame) -> DataFrame:
    """Rows per points value (0 included, no gap filling)."""
    return fact.groupBy(F.col("points").alias("puntuacion")).agg(F.count(F.lit(1)).alias("total"))


def price_trend(fact: DataFrame, dim_variedad: DataFrame) -> DataFrame:
    """Avg price per (variety, year) plus '__ALL__' rows, in ONE pass.

    The year is extracted once; GROUPING SETS ((variedad, anio), (anio))
    replaces the reference's UNION ALL of two scans (U02).
    """
    j = (with_dim(fact, dim_variedad, "id_variedad", "variedad")
         .withColumn("anio", title_year("title"))
         .filter((F.col("price") > 0) & (F.col("anio") != "")))
    g = j.groupingSets([["variedad", "anio"], ["anio"]], "variedad", "anio").agg(
        F.grouping("variedad").alias("_g"),
        round_half_up(exact_avg(F.sum("price"), F.count(F.lit(1))), 2).alias("precio_promedio"),
        F.count(F.lit(1)).alias("total"))
    return g.select(F.when(F.col("_g") == 1, F.lit(ALL)).otherwise(F.col("variedad")).alias("variedad"),
                    "anio", "precio_promedio", "total")


def pricing_base(fact: DataFrame, dim_variedad: DataFrame, min_n: int = 200, top: int = 12) -> DataFrame:
    """Per variety with price>0, HAVING n >= min_n, top-N by n (name tie-break)."""
    j = (with_dim(fact, dim_variedad, "id_variedad", "variedad")
         .filter((F.col("price") > 0) & (F.col("variedad") != UNKNOWN)))
    g = j.groupBy("variedad").agg(
        F.count(F.lit(1)).alias("demanda"),
        exact_avg(F.sum("price"), F.count(F.lit(1))).alias("precio_prom"),
        exact_avg(F.sum(F.col("points").cast("long")), F.count(F.lit(1))).alias("puntos_prom"))
    return g.filter(F.col("demanda") >= min_n).orderBy(F.col("demanda").desc(), "variedad").limit(top)


def demand_by_country(fact: DataFrame, dim_pais: DataFrame, top: int = 8) -> DataFrame:
    """Review count and avg points per country, top-N by count."""
    j = with_dim(fact, dim_pais, "id_pais", "pais").filter(F.col("pais") != UNKNOWN)
    g = j.groupBy("pais").agg(F.count(F.lit(1)).alias("demanda"), _avg_points().alias("puntos"))
    return g.orderBy(F.col("demanda").desc(), "pais").limit(top)


def page_counts(filtered: DataFrame, per_page: int) -> DataFrame:
    """Total of a filtered join and the number of pages."""
    return filtered.agg(F.count(F.lit(1)).alias("total")).select(
        "total", F.ceil(F.col("total") / F.lit(per_page)).cast("long").alias("paginas"))
