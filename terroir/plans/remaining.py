"""Registered queries of operators that no other query reaches: seals and the gated inference run, availability
rows, conversion drops, tenant scope, registry and header rules, dates, keys and presence checks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terroir import functions as FN
from terroir.functions import sql_round_half_up as R
from terroir.operators import alerts as AL
from terroir.operators import catalog as CT
from terroir.operators import quality as Q
from terroir.operators import search as S
from terroir.operators import windows as W
from terroir.plans import events as PE
from terroir.plans.registry import register
from terroir.session import ensure_checkpoint_dir
from terroir.sources import readers as RD
from terroir.sources import testdata as T

# ====================================================== W08 / Q09 / M08 (seals: one suite per user number mod 7)
NOW = "2024-01-31 12:00:00"
_SEALS_SQL = """WITH seal AS (SELECT 'suite-' || CAST(user_id % 7 AS VARCHAR) AS suite, event_type <> 'error' AS exito, ts AS fecha, event_id,
    CAST(CASE WHEN user_id % 7 = 3 THEN 2.0 WHEN user_id % 7 <> 5 THEN 1000.0 END AS DOUBLE) AS vigencia_horas FROM events),
newest AS (SELECT * FROM seal QUALIFY row_number() OVER (PARTITION BY suite ORDER BY fecha DESC) = 1)
"""


def _seals(spark, sf_dir) -> DataFrame:
    e = T.table(spark, sf_dir, "events")
    n = F.col("user_id") % 7
    return e.select(F.concat(F.lit("suite-"), n.cast("string")).alias("suite"), (F.col("event_type") != "error").alias("exito"),
                    F.col("ts").alias("fecha"), "event_id", F.when(n == 3, 2.0).when(n != 5, 1000.0).alias("vigencia_horas"))


@register("w08_newest_seals", _SEALS_SQL + "SELECT * FROM newest")
def w08_newest_seals(spark, sf_dir):
    return W.latest_by(_seals(spark, sf_dir), ["suite"], "fecha").select("suite", "exito", "fecha", "event_id", "vigencia_horas")


Q09_SQL = _SEALS_SQL + f""", st AS (SELECT suite, CASE WHEN NOT exito THEN 'fallido'
    WHEN date_diff('second', fecha, TIMESTAMP '{NOW}') / 3600.0 > coalesce(vigencia_horas, 24.0) THEN 'vencido' ELSE '' END AS motivo FROM newest)
"""


@register("q09_seal_status", Q09_SQL + "SELECT suite, motivo = '' AS ok, motivo FROM st")
def q09_seal_status(spark, sf_dir):
    return Q.seal_status(_seals(spark, sf_dir), NOW).select("suite", "ok", "motivo")


@register("m08_gated_runs", Q09_SQL + """, n AS (SELECT 'suite-' || CAST(user_id % 7 AS VARCHAR) AS suite,
    count(*) AS p, count(CASE WHEN event_type = 'error' THEN 1 END) AS s FROM events GROUP BY 1)
SELECT st.suite AS corrida, CASE WHEN motivo <> '' THEN 'BLOQUEADA_POR_CALIDAD' WHEN st.suite = 'suite-1' THEN 'FALLIDA' ELSE 'COMPLETADA' END AS estado,
  CASE WHEN motivo = '' AND st.suite <> 'suite-1' THEN p ELSE 0 END AS predicciones,
  CASE WHEN motivo = '' AND st.suite <> 'suite-1' THEN s ELSE 0 END AS senales,
  CASE WHEN motivo <> '' THEN motivo WHEN st.suite = 'suite-1' THEN 'ValueError: sin datos' ELSE '' END AS detalle
FROM st JOIN n ON n.suite = st.suite""")
def m08_gated_runs(spark, sf_dir):
    """One run per suite: its events are the predictions, its errors the signals; suite-1's computation fails."""
    status = q09_seal_status(spark, sf_dir)
    e = T.table(spark, sf_dir, "events").withColumn("suite", F.concat(F.lit("suite-"), (F.col("user_id") % 7).cast("string")))

    def compute(suite):
        def go():
            if suite == "suite-1":
                raise ValueError("sin datos")
            mine = e.filter(F.col("suite") == suite)
            return mine, mine.filter("event_type = 'error'")
        return go
    names = [f"suite-{i}" for i in range(7)]
    return CT.union_all([CT.run_inference(spark, status.filter(F.col("suite") == n), compute(n), n) for n in names])


# ====================================================== T15 / F22: the newest consolidated day for every nation as a market
@register("t15_availability_rows", PE.A19_SQL + """, m AS (SELECT * FROM a19 ORDER BY fecha DESC LIMIT 1)
SELECT CAST(202402 * 1000 + n_nationkey AS BIGINT) AS id_disponibilidad, 202402 AS id_tiempo, CAST(n_nationkey AS BIGINT) AS id_mercado,
  m.uptime, m.latencia_ms, m.incidentes, 0 AS despliegues, CAST(0.0 AS DOUBLE) AS time_to_market_dias, CAST(0.0 AS DOUBLE) AS costo_cloud
FROM nation, m""")
def t15_availability_rows(spark, sf_dir):
    daily = PE.a19_probe_consolidation(spark, sf_dir)
    markets = T.table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("id_mercado"))
    return AL.availability_rows(daily.orderBy(F.desc("fecha")).limit(1), markets, 202402)


@register("f22_natural_keys", """SELECT 'ped:' || CAST(o_custkey AS VARCHAR) || ':' || CAST(o_orderkey AS VARCHAR) AS clave, o_orderkey FROM orders""")
def f22_natural_keys(spark, sf_dir):
    return T.table(spark, sf_dir, "orders").select(FN.natural_key(F.lit("ped"), "o_custkey", "o_orderkey").alias("clave"), "o_orderkey")


# ====================================================== T16: daily leads (sign-ups) and conversions (purchases) per user block
_DROP_SQL = f"""WITH ind AS (SELECT CAST(user_id // 10 AS INTEGER) AS id_tiempo, count(*) FILTER (WHERE event_type = 'signup') AS leads,
    count(*) FILTER (WHERE event_type = 'purchase' AND value > 180) AS conversiones FROM events GROUP BY 1),
r AS (SELECT *, {R('CASE WHEN leads > 0 THEN conversiones * 100.0 / leads ELSE 0.0 END', 2)} AS tasa FROM ind)
"""


@register("t16_conversion_drop", _DROP_SQL + """SELECT 'conversion:' || CAST(id_tiempo AS VARCHAR) AS clave, tasa AS valor, CAST(5.0 AS DOUBLE) AS umbral,
    id_tiempo, 'warning' AS severidad FROM r WHERE leads > 0 AND tasa < 5.0""")
def t16_conversion_drop(spark, sf_dir):
    e = T.table(spark, sf_dir, "events")
    ind = e.groupBy(F.floor(F.col("user_id") / 10).cast("int").alias("id_tiempo")).agg(
        F.count_if(F.col("event_type") == "signup").alias("leads"),
        F.count_if((F.col("event_type") == "purchase") & (F.col("value") > 180)).alias("conversiones"))
    rate = FN.round_half_up(F.when(F.col("leads") > 0, F.col("conversiones") * 100.0 / F.col("leads")).otherwise(F.lit(0.0)), 2)
    s = AL.conversion_drop(ind.withColumn("tasa_conversion", rate), "2024-02-01 00:00:00")
    return s.select("clave", "valor", "umbral", "id_tiempo", "severidad")


# ====================================================== P11
@register("p11_tenant_scope", "SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS cliente FROM orders WHERE o_custkey = 7")
def p11_tenant_scope(spark, sf_dir):
    o = T.table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("cliente"))
    return S.tenant_scope(o, "7", {"cliente": "7"})


# ====================================================== F13 / F14 / F18
@register("f13_minutes_between", f"""SELECT o_orderkey, {R("CASE WHEN o_orderkey % 9 <> 0 THEN date_diff('day', o_orderdate, DATE '1999-01-01') * 1440 + 30.5 END", 2)}
    AS minutos FROM orders""")
def f13_minutes_between(spark, sf_dir):
    o = T.table(spark, sf_dir, "orders")
    start = F.when(F.col("o_orderkey") % 9 != 0, F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T00:00:00Z")))
    rows = o.select("o_orderkey", start.alias("a"), F.lit("1999-01-01T00:30:30").alias("b"))
    return rows.select("o_orderkey", FN.minutes_between("a", "b").alias("minutos"))


@register("f14_nps_classes", """SELECT CASE WHEN o_orderkey % 11 >= 9 THEN 'promotor' WHEN o_orderkey % 11 >= 7 THEN 'pasivo' ELSE 'detractor' END AS clase,
    count(*) AS n FROM orders GROUP BY 1""")
def f14_nps_classes(spark, sf_dir):
    o = T.table(spark, sf_dir, "orders").select(FN.nps_class(F.col("o_orderkey") % 11).alias("clase"))
    return o.groupBy("clase").agg(F.count(F.lit(1)).alias("n"))


_DATE_TEXT = ["strftime(o_orderdate, '%Y-%m-%dT10:20:30')", "strftime(o_orderdate, '%Y-%m-%d 10:20:30')", "strftime(o_orderdate, '%Y-%m-%d')",
              "strftime(o_orderdate, '%d/%m/%Y')", "strftime(o_orderdate, '%d-%m-%Y')", "'mal'"]


@register("f18_any_date", """SELECT o_orderkey, CASE WHEN o_orderkey % 6 < 2 THEN CAST(o_orderdate AS TIMESTAMP) + INTERVAL 37230 SECOND
    WHEN o_orderkey % 6 < 5 THEN CAST(o_orderdate AS TIMESTAMP) END AS fecha FROM orders""")
def f18_any_date(spark, sf_dir):
    layouts = ["yyyy-MM-dd'T10:20:30'", "yyyy-MM-dd '10:20:30'", "yyyy-MM-dd", "dd/MM/yyyy", "dd-MM-yyyy"]
    text = F.lit("mal")
    for i, f in enumerate(layouts):
        text = F.when(F.col("o_orderkey") % 6 == i, F.date_format("o_orderdate", f)).otherwise(text)
    rows = T.table(spark, sf_dir, "orders").select("o_orderkey", text.alias("t"))
    return rows.select("o_orderkey", FN.parse_any_date("t").cast("timestamp_ntz").alias("fecha"))


# ====================================================== S07 / S09 / Q07
@register("s07_completed_schema", """SELECT CAST(c_custkey AS VARCHAR) AS title, c_name AS winery, CAST(NULL AS VARCHAR) AS country,
    CAST(NULL AS VARCHAR) AS points FROM customer""")
def s07_completed_schema(spark, sf_dir):
    """A header with blanks, capitals and an unnamed column; the missing columns come as NULL."""
    c = T.table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias(" Title "), F.col("c_name").alias("WINERY"),
                                                  F.col("c_nationkey").alias("Unnamed: 0"))
    out = RD.normalise_columns(c)
    assert set(out.columns) == set(RD.REQUIRED_REVIEW_COLUMNS)
    return out.select("title", "winery", "country", "points")


@register("s09_register_sources", """WITH old AS (SELECT min(s_suppkey) AS id, s_nationkey AS k FROM supplier GROUP BY 2)
SELECT c_custkey, o.id AS id_existente, CASE WHEN o.id IS NULL THEN 'REGISTRADA' ELSE 'DUPLICADA' END AS estado
FROM customer c LEFT JOIN old o ON c.c_nationkey * 2 = o.k""")
def s09_register_sources(spark, sf_dir):
    def source(df, key, k):
        return df.select(key, F.lit("precios").alias("tipo"), F.concat(F.lit("http://x/"), k.cast("string")).alias("endpoint"), F.lit("csv").alias("formato"))
    old = source(T.table(spark, sf_dir, "supplier"), F.col("s_suppkey").alias("id"), F.col("s_nationkey"))
    new = source(T.table(spark, sf_dir, "customer"), F.col("c_custkey"), F.col("c_nationkey") * 2)
    return RD.register_sources(old, new).select("c_custkey", "id_existente", "estado")


@register("q07_presence", """SELECT 'orders' AS dataset, 'rows' AS chequeo, count(*) >= 1 AS exito FROM orders
  UNION ALL SELECT 'orders', 'column:o_orderkey', TRUE UNION ALL SELECT 'orders', 'column:no_such', FALSE
  UNION ALL SELECT 'none', 'rows', count(*) >= 1 FROM orders WHERE o_orderkey < 0 UNION ALL SELECT 'missing', 'dataset', FALSE
  UNION ALL SELECT 'orders', 'dataset', TRUE""")
def q07_presence(spark, sf_dir):
    """Row counts, columns and whole datasets: present ones, an empty one and a missing one."""
    o = T.table(spark, sf_dir, "orders")
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/terroir/presence/{uuid.uuid4().hex}"
    o.limit(1).write.parquet(f"{path}/orders")
    suites = {"orders": (o, [Q.expect_rows(1), Q.expect_column("o_orderkey"), Q.expect_column("no_such")]),
              "none": (o.filter("o_orderkey < 0"), [Q.expect_rows(1)])}
    results = CT.union_all([Q.run_suite(n, df, checks) for n, (df, checks) in suites.items()])
    found = Q.datasets_present(spark, {n: f"{path}/{n}" for n in ("orders", "missing")})
    return results.unionByName(found).select("dataset", F.regexp_replace("expectativa", "^rows.*", "rows").alias("chequeo"), "exito")


# ====================================================== Q08: counts and samples of every kind of check, one job
_BAD_KEY = "CASE WHEN o_custkey % 50 = 0 THEN -o_custkey ELSE o_custkey END"


@register("q08_suite_samples", f"""WITH o AS (SELECT *, {_BAD_KEY} AS k FROM orders),
v AS (SELECT 'not_null:o_clerk' AS c, CAST(NULL AS VARCHAR) AS x, 0 AS n FROM o WHERE FALSE
  UNION ALL SELECT 'between:o_totalprice', CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR), count(*) FROM o
    WHERE floor(o_totalprice) NOT BETWEEN 2000 AND 400000 GROUP BY 2
  UNION ALL SELECT 'in_set:o_orderstatus', o_orderstatus, count(*) FROM o WHERE o_orderstatus NOT IN ('O', 'F') GROUP BY 2
  UNION ALL SELECT 'unique:o_custkey', CAST(o_custkey AS VARCHAR), count(*) FROM o GROUP BY 2 HAVING count(*) > 1
  UNION ALL SELECT 'fk:k', CAST(k AS VARCHAR), count(*) FROM o WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.k) GROUP BY 2),
g AS (SELECT c, sum(n) AS fallidas, (SELECT string_agg(y, ',' ORDER BY y) FROM (SELECT w.x AS y FROM v w WHERE w.c = v.c ORDER BY w.x LIMIT 3) t) AS muestra
      FROM v GROUP BY c),
names AS (SELECT unnest(['not_null:o_orderkey', 'between:o_totalprice', 'in_set:o_orderstatus', 'unique:o_custkey', 'fk:k']) AS c)
SELECT names.c AS chequeo, (SELECT count(*) FROM orders) AS evaluadas, CAST(coalesce(fallidas, 0) AS BIGINT) AS fallidas,
       coalesce(fallidas, 0) = 0 AS exito, coalesce(muestra, '') AS muestra FROM names LEFT JOIN g ON g.c = names.c""")
def q08_suite_samples(spark, sf_dir):
    o = T.table(spark, sf_dir, "orders").withColumns({"k": F.expr(_BAD_KEY), "o_totalprice": F.floor("o_totalprice").cast("long")})
    checks = [Q.expect_not_null("o_orderkey"), Q.expect_between("o_totalprice", 2000, 400000), Q.expect_in("o_orderstatus", ["O", "F"]),
              Q.expect_unique("o_custkey"), Q.expect_fk("k", T.table(spark, sf_dir, "customer"), "c_custkey")]
    return Q.run_suite("orders", o, checks).select(F.col("expectativa").alias("chequeo"), "evaluadas", "fallidas", "exito", "muestra")


# ====================================================== S02: customers as a review CSV with line breaks and quotes in fields
@register("s02_reviews_csv", """SELECT CAST(c_custkey AS VARCHAR) AS title, 'He said "no", line 1' || chr(10) || 'line 2 of ' || c_name || chr(10) || chr(10) || 'end' AS description,
    CASE WHEN c_custkey % 5 = 0 THEN 0 ELSE CAST(80 + c_nationkey AS INTEGER) END AS points,
    CASE WHEN c_custkey % 7 = 0 THEN 0.0 ELSE CAST(c_nationkey + 0.5 AS DOUBLE) END AS price, '' AS winery FROM customer""")
def s02_reviews_csv(spark, sf_dir):
    """Written as text in a few files, each read back by several tasks."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/terroir/reviews_csv/{uuid.uuid4().hex}"
    c = T.table(spark, sf_dir, "customer")
    text = F.concat(F.lit('He said "no", line 1\n'), F.lit("line 2 of "), F.col("c_name"), F.lit("\n\nend"))
    rows = c.select(F.col("c_custkey").cast("string").alias(" Title"), text.alias("Description"),
                    F.when(F.col("c_custkey") % 5 == 0, "n/a").otherwise((F.col("c_nationkey") + 80).cast("string")).alias("points"),
                    F.when(F.col("c_custkey") % 7 != 0, (F.col("c_nationkey") + 0.5).cast("string")).alias("price"), F.lit("x").alias("Unnamed: 0"))
    rows.coalesce(2).write.option("header", True).option("escape", '"').csv(path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")          # these files are small: force splits
    try:
        return RD.read_reviews_csv(spark, path).select("title", "description", "points", "price", "winery")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


# ====================================================== F17: payloads of every event, one in ten cut off
@register("f17_payloads", """SELECT event_id, CASE WHEN event_id % 10 <> 0 THEN event_type END AS tipo,
    CASE WHEN event_id % 10 <> 0 THEN user_id END AS usuario, CASE WHEN event_id % 10 = 0 THEN '{"tipo":"' || event_type || '","dat' END AS crudo
  FROM events""")
def f17_payloads(spark, sf_dir):
    """Encoded and decoded again; the field ``usuario`` is read from the variant."""
    e = T.table(spark, sf_dir, "events")
    whole = F.to_json(F.struct(F.col("event_type").alias("tipo"), F.struct(F.col("user_id").alias("usuario")).alias("datos")))
    cut = F.concat(F.lit('{"tipo":"'), F.col("event_type"), F.lit('","dat'))
    rows = e.select("event_id", F.when(F.col("event_id") % 10 != 0, whole).otherwise(cut).alias("payload"))
    d = FN.decode_kept("payload", "tipo string, datos struct<usuario: long>")
    return rows.select("event_id", d["valor"]["tipo"].alias("tipo"), FN.payload_field("payload", "$.datos.usuario", "long").alias("usuario"),
                       d["crudo"].alias("crudo"))
