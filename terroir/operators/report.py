"""Daily report document (A21) and archive.

The document is a one-row DataFrame: the latest row of the daily
consolidation (A11), the review KPIs (A01) and the scorecard quality figure
(A08) combined as scalar subqueries into nested structs and rendered with
``to_json``.  Status PUBLICADO, or FALLIDO when there is no consolidation
row; BLOQUEADO_SIN_CALIDAD when the quality seal is not ok.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terroir.functions import one_row

SECTIONS = ["operacion", "catalogo", "calidad", "trazabilidad"]


def daily_report(a11: DataFrame, a01: DataFrame, a08: DataFrame, fecha: str, seal_ok: bool = True) -> DataFrame:
    spark = a11.sparkSession
    latest = a11.orderBy(F.col("id_tiempo").desc()).limit(1)
    n = a11.agg(F.count(F.lit(1))).scalar()
    op, cat, cal = one_row(latest), one_row(a01), one_row(a08.select("periodo", "calidad"))
    base = spark.range(1).select(
        F.lit(fecha).alias("fecha"),
        F.when(F.lit(not seal_ok), "BLOQUEADO_SIN_CALIDAD").when(n == 0, "FALLIDO").otherwise("PUBLICADO")
        .alias("estado"),
        op.alias("operacion"), cat.alias("catalogo"), cal.alias("calidad"))
    doc = F.struct(
        F.col("operacion"), F.col("catalogo"), F.col("calidad"),
        F.struct(F.lit("daily_consolidation").alias("fuente_operacion"), F.lit("review_kpis").alias("fuente_catalogo"),
                 F.lit("scorecard_kpis").alias("fuente_calidad"), F.col("operacion.periodo").alias("periodo"))
        .alias("trazabilidad"))
    return base.select("fecha", "estado",
                       F.when(F.col("estado") == "PUBLICADO", F.to_json(doc)).alias("documento"),
                       F.when(F.col("estado") == "PUBLICADO", F.lit(len(SECTIONS))).otherwise(F.lit(0))
                       .alias("secciones"))
