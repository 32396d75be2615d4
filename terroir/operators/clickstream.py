"""Legacy clickstream star (D10-D13, J03, J10, J11, U04, P07) built from a
text staging table, and the normalised entity model.

New dimension members are inserted only when absent (left anti join on the
trimmed name); the fact resolves six name dimensions plus the composite
(date, hour) time key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terroir.functions import blank_to_zero, parse_flag, parse_iso19, time_parts

# (dimension, id column, staging column)
SIMPLE_DIMS = [("dim_categoria", "id_categoria", "category"), ("dim_marca", "id_marca", "brand"),
               ("dim_canal", "id_canal", "channel"), ("dim_dispositivo", "id_dispositivo", "device"),
               ("dim_region", "id_region", "region"), ("dim_trafico", "id_trafico", "traffic_source")]


def to_staging_text(click: DataFrame) -> DataFrame:
    """Typed clickstream → text staging (all strings, ``timestamp_raw``, ``device``)."""
    flag = lambda c: F.when(F.col(c), F.lit("1")).otherwise(F.lit("0"))
    return click.select(
        "session_id", "user_id",
        F.date_format("timestamp_utc", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp_raw"),
        F.col("event_index").cast("string").alias("event_index"), "user_action", "product_id", "category", "brand",
        F.format_string("%.2f", "price").alias("price"), "channel", F.col("device_type").alias("device"), "region",
        "traffic_source",
        F.coalesce(F.col("time_spent_sec").cast("string"), F.lit("")).alias("time_spent_sec"),
        F.col("session_length").cast("string").alias("session_length"),
        F.coalesce(F.col("interaction_count").cast("string"), F.lit("")).alias("interaction_count"),
        flag("is_conversion").alias("is_conversion"), flag("drop_off_flag").alias("drop_off_flag"))


def non_blank(df: DataFrame, col: str) -> DataFrame:
    """``col IS NOT NULL AND TRIM(col) <> ''``."""
    return df.filter(F.col(col).isNotNull() & (F.trim(F.col(col)) != ""))


def distinct_values(df: DataFrame, col: str, alias: str = "nombre") -> DataFrame:
    """SELECT DISTINCT trim(col)."""
    return non_blank(df, col).select(F.trim(F.col(col)).alias(alias)).distinct()


def clickstream_dims(staging: DataFrame, existing: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """D10 with J10: the six name dimensions in one pass.  The names of all six
    columns are stacked and made distinct in one aggregate of one scan; those
    that ``existing`` lacks are numbered per dimension by name (two-pass ids,
    no single-task window) after its largest id and appended."""
    from terroir.operators.ids import rank_within_groups
    existing = existing or {}
    entries = F.array(*[F.struct(F.lit(dim).alias("dim"), F.trim(F.col(col)).alias("nombre")) for dim, _, col in SIMPLE_DIMS])
    names = (staging.select(F.explode(entries).alias("e")).select("e.*")
             .filter(F.col("nombre").isNotNull() & (F.col("nombre") != "")).distinct())
    known = None
    for dim, id_col, _ in SIMPLE_DIMS:
        if dim in existing:
            part = existing[dim].select(F.lit(dim).alias("dim"), F.col(id_col).alias("_id"), "nombre")
            known = part if known is None else known.unionByName(part)
    if known is not None:
        names = names.join(known.select("dim", "nombre"), ["dim", "nombre"], "left_anti")
    numbered = rank_within_groups(names, "dim", ["nombre"], "_id")
    if known is not None:
        last = known.groupBy("dim").agg(F.max("_id").alias("_last"))
        numbered = (numbered.join(last, "dim", "left")
                    .select("dim", "nombre", (F.col("_id") + F.coalesce("_last", F.lit(0))).cast("int").alias("_id")))
    out = {}
    for dim, id_col, _ in SIMPLE_DIMS:
        new = numbered.filter(F.col("dim") == dim).select(F.col("_id").alias(id_col), "nombre")
        out[dim] = existing[dim].select(id_col, "nombre").unionByName(new) if dim in existing else new
    return out


def time_dim(staging: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """D11 + J11: distinct (date, hour) with parts, Monday = 0; only unseen
    (date, hour) pairs are added (NOT EXISTS → left anti on two columns)."""
    ts = parse_iso19("timestamp_raw")
    p = time_parts(ts)
    rows = (non_blank(staging, "timestamp_raw").select(
        ts.cast("date").alias("fecha"), p["anio"].alias("anio"), p["mes"].alias("mes"), p["dia"].alias("dia"),
        p["hora"].alias("hora"), p["dia_semana"].alias("dia_semana")).filter(F.col("fecha").isNotNull()).distinct())
    start = F.lit(0)
    if existing is not None:
        rows = rows.join(existing.select("fecha", "hora"), ["fecha", "hora"], "left_anti")
        start = F.coalesce(F.lit(existing.agg(F.max("id_tiempo")).first()[0]), F.lit(0))
    # one row per (date, hour): bounded by the calendar, ordered window is fine
    ided = rows.select((start + F.row_number().over(Window.orderBy("fecha", "hora"))).cast("int").alias("id_tiempo"),
                       "fecha", "anio", "mes", "dia", "hora", "dia_semana")
    return ided if existing is None else existing.unionByName(ided)


def clickstream_fact(staging: DataFrame, dims: dict[str, DataFrame], tdim: DataFrame) -> DataFrame:
    """Casts (F09), flags (F08) and seven inner joins, the time
    dimension on the composite (date, hour) key.  Dimensions are small:
    AQE broadcasts them at runtime."""
    ts = parse_iso19("timestamp_raw")
    f = non_blank(staging, "timestamp_raw").select(
        "session_id", "user_id", "user_action",
        blank_to_zero("price", "decimal(10,2)").alias("price"),
        parse_flag("is_conversion").alias("is_conversion"), parse_flag("drop_off_flag").alias("drop_off_flag"),
        blank_to_zero("session_length", "int").alias("session_length"),
        blank_to_zero("interaction_count", "int").alias("interaction_count"),
        blank_to_zero("time_spent_sec", "int").alias("time_spent_sec"),
        *[F.trim(F.col(col)).alias(f"_{col}") for _, _, col in SIMPLE_DIMS],
        ts.cast("date").alias("_fecha"), F.hour(ts).alias("_hora"))
    for dim, id_col, col in SIMPLE_DIMS:
        f = f.join(dims[dim].select(id_col, F.col("nombre").alias(f"_{col}")), f"_{col}")
    f = f.join(tdim.select("id_tiempo", F.col("fecha").alias("_fecha"), F.col("hora").alias("_hora")),
               ["_fecha", "_hora"])
    return f.drop(*[c for c in f.columns if c.startswith("_")])


def normalise_clickstream(click: DataFrame, order: list[str] | None = None) -> dict[str, DataFrame]:
    """Users (first region/device), products (first price), sessions
    (first channel/source), all interactions, transactions = conversions.
    "First" is the smallest (timestamp, session, event_index): min_by per key,
    no sort of the whole table."""
    order = order or ["timestamp_utc", "session_id", "event_index"]
    o = F.struct(*[F.col(c) for c in order])

    def first(keys, cols):
        return click.groupBy(*keys).agg(*[F.min_by(F.col(c), o).alias(c) for c in cols])
    return {
        "usuarios": first(["user_id"], ["region", "device_type"]),
        "productos": first(["product_id"], ["category", "brand", "price"]),
        "sesiones": first(["session_id"], ["user_id", "channel", "traffic_source", "session_length"]),
        "interacciones": click.select("session_id", "event_index", "timestamp_utc", "user_action", "product_id",
                                      "time_spent_sec", "interaction_count", "is_conversion", "drop_off_flag"),
        "transacciones": click.filter(F.col("is_conversion")).select(
            "session_id", "event_index", "timestamp_utc", "product_id", "price"),
    }


def counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per normalised table (one aggregate each, stacked)."""
    return reduce(DataFrame.unionByName, [df.agg(F.count(F.lit(1)).alias("filas"))
                                          .select(F.lit(n).alias("tabla"), "filas") for n, df in tables.items()])
