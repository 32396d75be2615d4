"""Search, filter and top-k operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terroir.functions import exact_avg, round_half_up


class TenantError(ValueError):
    """Raised when a filter tries to read another tenant's rows."""


def star_view(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Fact joined to its six dimensions (orphans drop out)."""
    j = fact
    for dim, key, name in (("dim_pais", "id_pais", "pais"), ("dim_variedad", "id_variedad", "variedad"),
                           ("dim_bodega", "id_bodega", "bodega"), ("dim_provincia", "id_provincia", "provincia"),
                           ("dim_region", "id_region", "region")):
        j = j.join(dims[dim].select(key, F.col("nombre").alias(name)), key)
    j = j.join(dims["dim_catador"].select("id_catador", F.col("nombre").alias("catador")), "id_catador")
    return j


def search_filter(country: str | None = None, variety: str | None = None, winery: str | None = None,
                  min_points: int | None = None, max_price: float | None = None) -> Column:
    """Conjunction of the supplied predicates only (TRUE when none).

    ``winery`` is a LIKE '%x%' pattern ('%' / '_' in the value stay
    wildcards); ``max_price`` keeps the 0 "no price" sentinel.
    """
    preds = []
    if country:
        preds.append(F.col("pais") == country)
    if variety:
        preds.append(F.col("variedad") == variety)
    if winery:
        preds.append(F.col("bodega").like(f"%{winery}%"))
    if min_points is not None:
        preds.append(F.col("points") >= min_points)
    if max_price is not None:
        preds.append(F.col("price") <= max_price)
    return reduce(lambda a, b: a & b, preds, F.lit(True))


def page(df: DataFrame, page_no: int = 1, per_page: int = 20, max_per_page: int = 200,
         order: str = "points", tie: str = "id_resena") -> DataFrame:
    """Offset paging by ``order`` desc with an id tie-break."""
    page_no, per_page = max(1, int(page_no)), int(per_page)
    if not 1 <= per_page <= max_per_page:
        raise ValueError(f"per_page must be between 1 and {max_per_page}, not {per_page}")
    return (df.orderBy(F.col(order).desc(), F.col(tie).asc())
            .offset((page_no - 1) * per_page).limit(per_page))


def search_page_and_total(rows: DataFrame, filters: dict, page_no: int = 1, per_page: int = 20,
                          max_per_page: int = 200) -> tuple[list, int, int]:
    """P05 + O06 + A23 as the dashboard endpoint runs them: ONE filtered plan,
    persisted for its two actions (the total and the page), then released.
    Returns (page rows, total, pages); the page is bounded by ``max_per_page``."""
    from pyspark import StorageLevel
    filtered = rows.filter(search_filter(**filters)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        total = filtered.count()
        per = int(per_page)
        got = page(filtered, page_no, per, max_per_page).collect()
        return got, total, -(-total // per)
    finally:
        filtered.unpersist()


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """TakeOrderedAndProject."""
    return df.orderBy(*order).limit(k)


def top_countries(a02: DataFrame, k: int = 15) -> DataFrame:
    return top_k(a02, k, F.col("puntuacion_promedio").desc(), F.col("pais").asc())


def top_price_varieties(a03: DataFrame, k: int = 12) -> DataFrame:
    return top_k(a03.filter(F.col("precio_promedio") > 0), k,
                 F.col("precio_promedio").desc(), F.col("variedad").asc())


def top_wineries(a04: DataFrame, min_n: int = 10, k: int = 10) -> DataFrame:
    return top_k(a04.filter(F.col("total") >= min_n), k,
                 F.col("puntuacion_promedio").desc(), F.col("bodega").asc())


def by_volume(agg: DataFrame, label: str, k: int | None = None) -> DataFrame:
    ordered = agg.orderBy(F.col("total").desc(), F.col(label).asc())
    return ordered if k is None else ordered.limit(k)


def browse(aggs: dict[str, tuple[DataFrame, str]], k: int = 6) -> DataFrame:
    """Top k of each aggregate by volume, unioned with a tag."""
    parts = [by_volume(df, label, k).select(F.lit(tag).alias("grupo"), F.col(label).alias("nombre"), "total")
             for tag, (df, label) in aggs.items()]
    return reduce(DataFrame.unionByName, parts)


def compare_markets(a02: DataFrame, names: list[str]) -> DataFrame:
    """IN-list of at most 4 names, output in the given order.

    The list is a literal of at most 4 entries: joined as a broadcast
    (position, name) frame and ordered by position.
    """
    names = list(dict.fromkeys(names))
    if len(names) > 4:
        raise ValueError(f"at most 4 markets can be compared, not {len(names)}")
    spark = a02.sparkSession
    pos = spark.createDataFrame(list(enumerate(names)), "pos int, pais string")
    return a02.join(F.broadcast(pos), "pais").orderBy("pos").drop("pos")


def search_log(df: DataFrame, user: str | None = None, action: str | None = None, day: str | None = None,
               limit: int | None = None, user_col: str = "usuario", action_col: str = "accion",
               ts_col: str = "ts", id_col: str = "id") -> DataFrame:
    """Audit-log search, newest first by id; all hits unless ``limit`` is given."""
    preds = [F.lit(True)]
    if user:
        preds.append(F.col(user_col).cast("string").like(f"%{user}%"))
    if action:
        preds.append(F.col(action_col).like(f"%{action}%"))
    if day:
        preds.append(F.to_date(ts_col) == F.lit(day).cast("date"))
    hits = df.filter(reduce(lambda a, b: a & b, preds)).orderBy(F.col(id_col).desc())
    return hits if limit is None else hits.limit(limit)


def tenant_scope(df: DataFrame, owner, filters: dict | None = None, col: str = "cliente") -> DataFrame:
    """The owner predicate is always applied; a conflicting filter is an error."""
    filters = dict(filters or {})
    if col in filters and str(filters[col]) != str(owner):
        raise TenantError("fuga_multitenant")
    out = df.filter(F.col(col) == F.lit(owner))
    for k, v in filters.items():
        if k != col:
            out = out.filter(F.col(k) == F.lit(v))
    return out


def usage_of(a10: DataFrame, client_id) -> DataFrame:
    """Point lookup; a non-integer id yields no row."""
    key = F.lit(str(client_id)).try_cast("int")
    return a10.filter(F.col("id_cliente") == key)
