"""Registered round trips of the sinks: write, write again, read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terroir import sinks as K
from terroir.plans.registry import register
from terroir.session import ensure_checkpoint_dir
from terroir.sources import testdata as T


def fresh(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one: each run of a round trip starts without a table."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/terroir/sinks/{name}-{uuid.uuid4().hex}"


# ====================================================== K01 / K02: a source is landed again with fewer rows
def _customers(spark, sf_dir) -> DataFrame:
    return T.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")


@register("k01_landing", """SELECT c_custkey, c_name, c_nationkey, 'a' AS fuente, '2024-01-02' AS fecha_ingesta FROM customer WHERE c_nationkey % 4 = 0
  UNION ALL SELECT c_custkey, c_name, c_nationkey, 'b', '2024-01-02' FROM customer WHERE c_nationkey % 2 = 1
  UNION ALL SELECT c_custkey, c_name, c_nationkey, 'a', '2024-01-03' FROM customer WHERE c_nationkey % 5 = 0""")
def k01_landing(spark, sf_dir):
    c, n, base = _customers(spark, sf_dir), F.col("c_nationkey"), fresh(spark, "landing")
    K.land(c.filter(n % 2 == 0), base, "a", "2024-01-02")
    K.land(c.filter(n % 2 == 1), base, "b", "2024-01-02")
    K.land(c.filter(n % 5 == 0), base, "a", "2024-01-03")
    out = K.land(c.filter(n % 4 == 0), base, "a", "2024-01-02")                   # the same partition once more
    return spark.read.parquet(out).withColumn("fecha_ingesta", F.col("fecha_ingesta").cast("string"))


@register("k02_rejects", """SELECT c_custkey, c_name, c_nationkey, 'nacion_' || CAST(c_nationkey AS VARCHAR) AS motivo_rechazo, 'a' AS fuente
  FROM customer WHERE c_nationkey > 20""")
def k02_rejects(spark, sf_dir):
    c, base = _customers(spark, sf_dir), fresh(spark, "rejects")
    bad = c.withColumn("motivo_rechazo", F.concat(F.lit("nacion_"), F.col("c_nationkey").cast("string")))
    assert K.land_rejects(bad.filter("c_nationkey > 1000"), base, "a", "2024-01-02") is None
    out = K.land_rejects(bad.filter("c_nationkey > 20"), base, "a", "2024-01-02")
    return spark.read.parquet(out).drop("fecha_ingesta")


# ====================================================== K08: two months are written anew
@register("k08_replace_period", """SELECT o_orderkey, CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS id_tiempo,
    CASE WHEN year(o_orderdate) * 100 + month(o_orderdate) IN (199503, 199504) THEN 'nuevo' ELSE 'viejo' END AS lote FROM orders
  WHERE NOT (year(o_orderdate) * 100 + month(o_orderdate) = 199504 AND o_orderkey % 2 = 1)""")
def k08_replace_period(spark, sf_dir):
    from terroir.functions import period_id
    rows = T.table(spark, sf_dir, "orders").select("o_orderkey", period_id("o_orderdate").alias("id_tiempo"))
    path = fresh(spark, "periods")
    K.replace_period(rows.withColumn("lote", F.lit("viejo")), path)
    again = rows.filter("id_tiempo = 199503 OR (id_tiempo = 199504 AND o_orderkey % 2 = 0)")
    K.replace_period(again.withColumn("lote", F.lit("nuevo")), path)
    return spark.read.parquet(path).select("o_orderkey", "id_tiempo", "lote")


# ====================================================== K09 / K10: signals emitted again
@register("k09_upsert", """SELECT c_custkey AS clave, CAST(CASE WHEN c_custkey % 10 = 3 THEN c_nationkey + 100 ELSE c_nationkey END AS BIGINT) AS valor,
    c_custkey % 2 = 0 AS procesada, CAST(CASE WHEN c_custkey % 10 = 3 THEN 2 ELSE 1 END AS INTEGER) AS corrida FROM customer
  UNION ALL SELECT -1 - s_suppkey, s_nationkey, FALSE, 1 FROM supplier""")
def k09_upsert(spark, sf_dir):
    """Customers, then every tenth again and the suppliers as new keys: the value is
    replaced, ``procesada`` kept, ``corrida`` counted up."""
    c, path = T.table(spark, sf_dir, "customer"), fresh(spark, "upsert")
    one = F.lit(1).alias("corrida")
    K.upsert(spark, path, c.select(F.col("c_custkey").alias("clave"), F.col("c_nationkey").alias("valor"),
                                   (F.col("c_custkey") % 2 == 0).alias("procesada"), one), ["clave"])
    again = c.filter("c_custkey % 10 = 3").select(F.col("c_custkey").alias("clave"), (F.col("c_nationkey") + 100).alias("valor"),
                                                  F.lit(False).alias("procesada"), one)
    new = T.table(spark, sf_dir, "supplier").select((-1 - F.col("s_suppkey")).alias("clave"), F.col("s_nationkey").alias("valor"),
                                                    F.lit(False).alias("procesada"), one)
    types = {"clave": "bigint", "valor": "bigint"}
    return K.upsert(spark, path, again.unionByName(new), ["clave"], ["procesada"], "corrida").withColumns(
        {k: F.col(k).cast(t) for k, t in types.items()})


@register("k10_insert_absent", """SELECT c_custkey AS clave, 'base' AS lote FROM customer WHERE c_custkey % 2 = 0
  UNION ALL SELECT c_custkey, 'nuevo' FROM customer WHERE c_custkey % 2 = 1 AND c_custkey % 3 = 0""")
def k10_insert_absent(spark, sf_dir):
    keys, path = T.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("clave")), fresh(spark, "absent")
    K.append(keys.filter("clave % 2 = 0").withColumn("lote", F.lit("base")), path)
    twice = keys.filter("clave % 3 = 0").withColumn("lote", F.lit("nuevo"))
    new = K.insert_absent(spark.read.parquet(path), twice.unionAll(twice), ["clave"])
    K.append(new, path)
    return spark.read.parquet(path)


# ====================================================== K13: one day's report is written again
@register("k13_report_archive", """SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS fecha, event_type AS tipo, count(*) AS eventos,
    CASE WHEN CAST(ts AS DATE) = DATE '2024-01-10' THEN 2 ELSE 1 END AS edicion FROM events GROUP BY 1, 2, 4""")
def k13_report_archive(spark, sf_dir):
    daily = (T.table(spark, sf_dir, "events").groupBy(F.to_date("ts").cast("string").alias("fecha"), F.col("event_type").alias("tipo"))
             .agg(F.count(F.lit(1)).alias("eventos")))
    path = fresh(spark, "reports")
    K.write_report(daily.withColumn("edicion", F.lit(1)), path)
    K.write_report(daily.filter("fecha = '2024-01-10'").withColumn("edicion", F.lit(2)), path)
    return spark.read.schema("tipo string, eventos long, edicion int, fecha string").json(path).select("fecha", "tipo", "eventos", "edicion")
