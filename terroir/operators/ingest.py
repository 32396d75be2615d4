"""Batch ingest validation (Q06) and its report.

One ``when`` chain yields the first failing reason per row; valid rows are
deduplicated on the natural key keeping the first by input order (W07);
the report is a single aggregate over the batch.  ``now`` is a parameter so
runs are reproducible.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terroir.functions import lenient_double, round_half_up, strip

# Minimum schema per source type and natural keys.
REQUIRED = {
    "reseñas": ["title", "points", "taster_name", "winery"],
    "precios": ["title", "price", "moneda", "fecha_precio"],
    "puntuaciones": ["title", "points", "taster_name", "fecha_cata"],
}
NATURAL_KEYS = {
    "reseñas": ["taster_name", "title", "winery"],
    "precios": ["title", "mercado", "fecha_precio"],
    "puntuaciones": ["taster_name", "title", "fecha_cata"],
}
# Accepted currency codes.
CURRENCIES = ("USD", "EUR", "GBP", "CLP", "ARS", "MXN", "ZAR", "AUD", "BRL")
DATE_COLUMNS = ("fecha_precio", "fecha_cata", "fecha_resena")
REJECT_THRESHOLD = 0.05
POINTS_RANGE = (80, 100)


def _as_text(c: str) -> Column:
    return F.col(c).cast("string")


def rejection_reason(df: DataFrame, kind: str, now_date: str) -> Column:
    """First failing rule, '' when valid (rule order of the reference)."""
    chain = None

    def add(cond, reason):
        nonlocal chain
        chain = F.when(cond, reason) if chain is None else chain.when(cond, reason)
    for c in REQUIRED[kind]:
        v = _as_text(c) if c in df.columns else F.lit(None).cast("string")
        missing = v.isNull() | (strip(v) == "")            # any white space, tabs included
        if c in df.columns and df.schema[c].dataType.typeName() in ("double", "float"):
            missing = missing | F.isnan(c)
        add(missing, F.lit(f"campo_faltante:{c}"))
    if kind in ("reseñas", "puntuaciones"):
        pts = lenient_double("points")
        add(pts.isNull() | ~pts.between(*POINTS_RANGE),
            F.concat(F.lit("dominio:puntaje_fuera_de_rango:"), F.coalesce(_as_text("points"), F.lit("None"))))
    if kind == "precios":
        prc = lenient_double("price")
        add(prc.isNull() | (prc <= 0),
            F.concat(F.lit("dominio:precio_no_positivo:"), F.coalesce(_as_text("price"), F.lit("None"))))
        cur = F.upper(strip(F.coalesce(_as_text("moneda"), F.lit(""))))
        add(~cur.isin(*CURRENCIES),
            F.concat(F.lit("dominio:moneda_no_iso4217:"), F.coalesce(_as_text("moneda"), F.lit("None"))))
    for dc in DATE_COLUMNS:
        if dc in df.columns:
            d = F.to_date(F.try_to_timestamp(F.trim(_as_text(dc))))
            add((F.trim(_as_text(dc)) != "") & d.isNotNull() & (d > F.lit(now_date).cast("date")),
                F.concat(F.lit("dominio:fecha_futura:"), _as_text(dc)))
    return chain.otherwise(F.lit(""))


def ingest_batch(df: DataFrame, kind: str, source: str, ingest_date: str, ordinal: str = "ordinal",
                 threshold: float = REJECT_THRESHOLD) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Q06 → (valid deduplicated rows, rejects with reason, one-row report).

    ``ordinal`` is the input order (first wins in dedup).  The report keeps
    the reference's rules: 0 rows → FALLIDA; reject share strictly above the
    threshold → FALLIDA (nothing loaded); any reject → PARCIAL.
    """
    tagged = df.withColumn("motivo_rechazo", rejection_reason(df, kind, ingest_date))
    valid = tagged.filter(F.col("motivo_rechazo") == "").drop("motivo_rechazo")
    rejects = (tagged.filter(F.col("motivo_rechazo") != "")
               .withColumn("fuente", F.lit(source)).withColumn("fecha_ingesta", F.lit(ingest_date)))
    keys = [k for k in NATURAL_KEYS[kind] if k in df.columns]
    if keys:
        # one exchange by key; each input task passes on one row per key at most
        w = Window.partitionBy(*keys).orderBy(F.col(ordinal).asc_nulls_last())
        deduped = (valid.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1")
                   .select(*keys, *[c for c in valid.columns if c not in keys]))
    else:
        deduped = valid
    report = batch_report(tagged, kind, source, ingest_date, keys, threshold)
    return deduped, rejects, report


def batch_report(tagged: DataFrame, kind: str, source: str, ingest_date: str,
                 keys: list[str], threshold: float = REJECT_THRESHOLD) -> DataFrame:
    """A20 in ONE aggregate over the tagged batch: counts by outcome and the
    deduplicated count as count(DISTINCT natural key) over the valid rows."""
    valid = F.col("motivo_rechazo") == ""
    dedup = (F.count_distinct(F.when(valid, F.struct(*[F.col(k) for k in keys]))) if keys
             else F.count_if(valid))
    r = tagged.agg(F.count(F.lit(1)).alias("filas_leidas"), F.count_if(valid).alias("filas_validas"),
                   F.count_if(~valid).alias("filas_rechazadas"), dedup.alias("_dedup"))
    pct = F.when(F.col("filas_leidas") > 0, F.col("filas_rechazadas") / F.col("filas_leidas")).otherwise(F.lit(0.0))
    state = (F.when(F.col("filas_leidas") == 0, "FALLIDA").when(pct > threshold, "FALLIDA")
             .when(F.col("filas_rechazadas") > 0, "PARCIAL").otherwise("COMPLETADA"))
    return r.select(
        F.lit(source).alias("fuente"), F.lit(kind).alias("tipo"), F.lit(ingest_date).alias("fecha_ingesta"),
        F.lit(",".join(keys)).alias("clave_natural"), "filas_leidas", "filas_validas",
        (F.col("filas_validas") - F.col("_dedup")).alias("filas_duplicadas"), "filas_rechazadas",
        F.when(state == "FALLIDA", F.lit(0)).otherwise(F.col("_dedup")).cast("long").alias("filas_cargadas"),
        round_half_up(pct * 100, 2).alias("pct_rechazo"), F.lit(round(threshold * 100, 2)).alias("umbral_pct"),
        state.alias("estado"))
