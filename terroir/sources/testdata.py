"""Binding of the driver's TPC-H-like tables to the canonical inputs.

The operators take DataFrames with the reviews-star / business-star /
clickstream columns; this module derives those inputs from the test tables
by projection, joins and group-bys only, so the work grows with the tables.
Every Spark binding has a SQL twin (``*_SQL``) used by the DuckDB oracle.

Money columns are built from integer cents so both engines produce the same
decimal without a rounding tie.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terroir.functions import cents_to_decimal, period_id
from terroir.operators.star import MONTH_NAMES_ES

# Warehouse plan catalogue (id, name, monthly price).
PLANS = [(1, "Trial", 0.0), (2, "Básico", 99.0), (3, "Profesional", 499.0), (4, "Enterprise", 1990.0)]
# Acquisition channel catalogue.
CHANNELS = [(1, "organico", "Orgánico"), (2, "pago", "Pago"), (3, "referido", "Referido"),
            (4, "partner", "Partner"), (5, "evento", "Evento")]

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ======================================================================
# Raw reviews
# ======================================================================
# Input order of the review feed: the line-item key, then every other
# line-item column as tie-break, so ties are only between identical rows.
REVIEW_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity",
                "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
# Rows that tie on these give the same review, so the rest of the order cannot show in a numbered feed.
REVIEW_POSITION = REVIEW_ORDER[:7]


def raw_reviews(spark: SparkSession, sf_dir: str, ranged: bool = False) -> DataFrame:
    """One review per line item, with the F-R raw review columns.

    country=n_name, region_1=r_name, province=c_mktsegment, variety=p_brand,
    winery=s_name, taster=o_orderpriority, title=p_name + vintage year,
    points=75 + quantity % 30, price=0 on line 1 else extendedprice/100.
    The ordering columns l_orderkey, l_linenumber, l_partkey, l_suppkey are
    kept as the input order (first appearance) of the review feed.

    ``ranged=True`` range-partitions the joined rows by that order while they
    are still narrow (names, no derived texts) and adds (_pid, _local) (see
    ``operators.ids``) after the joins, so line items without an order or
    part, or with several, are numbered as they come out of the joins.
    """
    order = REVIEW_POSITION if ranged else REVIEW_ORDER
    li = table(spark, sf_dir, "lineitem").select(*order)
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    # nation (25 rows) and region (5 rows) are bounded by the TPC-H schema:
    # broadcast them.  orders/customer/part/supplier grow with the data and
    # are left to the planner / AQE.
    # customers meet the orders first: line items are not shuffled for them.
    geo = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey).drop("n_regionkey", "r_regionkey")
    buyers = o.join(c, o.o_custkey == c.c_custkey).drop("o_custkey", "c_custkey")
    df = (li.join(buyers, li.l_orderkey == buyers.o_orderkey)
          .join(p, li.l_partkey == p.p_partkey)
          .join(s, li.l_suppkey == s.s_suppkey)
          .join(F.broadcast(geo), F.col("c_nationkey") == geo.n_nationkey)
          .drop("o_orderkey", "p_partkey", "s_suppkey", "c_nationkey", "n_nationkey"))
    extra = []
    if ranged:
        from terroir.operators.ids import range_local_index
        df = range_local_index(df, [F.col(c).asc_nulls_last() for c in order])
        extra = ["_pid", "_local"]
    cents = F.when(F.col("l_linenumber") == 1, F.lit(0)).otherwise(
        F.floor(F.col("l_extendedprice") + F.lit(0.5)))
    return df.select(
        *order, *extra,
        F.col("n_name").alias("country"),
        F.concat(F.col("p_name"), F.lit(" / "), F.col("p_type")).alias("description"),
        F.col("p_type").alias("designation"),
        (F.lit(75) + F.floor(F.col("l_quantity")) % 30).cast("int").alias("points"),
        cents_to_decimal(cents, 10).alias("price"),
        F.col("c_mktsegment").alias("province"),
        F.col("r_name").alias("region_1"),
        F.lit("").alias("region_2"),
        F.col("o_orderpriority").alias("taster_name"),
        F.concat(F.lit("@"), F.lower(F.regexp_replace("o_orderpriority", "[^A-Za-z0-9]", ""))).alias(
            "taster_twitter_handle"),
        F.concat(F.col("p_name"), F.lit(" "), (F.year("l_shipdate") + 15).cast("string")).alias("title"),
        F.col("p_brand").alias("variety"),
        F.col("s_name").alias("winery"),
    )


RAW_REVIEWS_SQL = """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_shipdate, l.l_quantity, l.l_extendedprice,
       l.l_discount, l.l_tax, l.l_returnflag, l.l_linestatus,
       n.n_name AS country,
       p.p_name || ' / ' || p.p_type AS description,
       p.p_type AS designation,
       CAST(75 + CAST(floor(l.l_quantity) AS BIGINT) % 30 AS INTEGER) AS points,
       CAST(CAST(CASE WHEN l.l_linenumber = 1 THEN 0 ELSE floor(l.l_extendedprice + 0.5) END AS DOUBLE) / 100.0
            AS DECIMAL(10,2)) AS price,
       c.c_mktsegment AS province,
       r.r_name AS region_1,
       '' AS region_2,
       o.o_orderpriority AS taster_name,
       '@' || lower(regexp_replace(o.o_orderpriority, '[^A-Za-z0-9]', '', 'g')) AS taster_twitter_handle,
       p.p_name || ' ' || CAST(year(l.l_shipdate) + 15 AS VARCHAR) AS title,
       p.p_brand AS variety,
       s.s_name AS winery
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
JOIN part p ON l.l_partkey = p.p_partkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
"""


# ======================================================================
# Business star (month grain)
# ======================================================================
def _orders_p(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
        period_id("o_orderdate").alias("id_tiempo"))


def dim_tiempo(spark, sf_dir) -> DataFrame:
    """D14 month dimension over the periods present in ``orders``."""
    from terroir.operators.star import month_dim
    return month_dim(_orders_p(spark, sf_dir).select("id_tiempo").distinct())


def dim_mercado(spark, sf_dir) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey).select(
        F.col("n_nationkey").cast("int").alias("id_mercado"),
        F.col("n_name").alias("pais"), F.col("r_name").alias("region_geo"))


def dim_plan(spark, sf_dir=None) -> DataFrame:
    return spark.createDataFrame(PLANS, "id_plan int, nombre string, precio_mensual double").select(
        "id_plan", "nombre", F.col("precio_mensual").cast("decimal(10,2)").alias("precio_mensual"))


def dim_canal(spark, sf_dir=None) -> DataFrame:
    return spark.createDataFrame(CHANNELS, "id_canal int, codigo string, nombre string")


def dim_partner_api(spark, sf_dir) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    pid = (F.col("s_suppkey") % 6 + 1).cast("int")
    return (s.select(pid.alias("id_partner")).distinct()
            .select("id_partner",
                    F.concat(F.lit("Partner "), F.col("id_partner").cast("string")).alias("nombre"),
                    F.when(F.col("id_partner") % 2 == 0, "integrador").otherwise("marketplace").alias("tipo")))


def dim_cliente(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    first = (_orders_p(spark, sf_dir).groupBy("o_custkey")
             .agg(F.min("o_orderdate").cast("date").alias("fecha_alta")))
    return c.join(first, c.c_custkey == first.o_custkey, "left").select(
        F.col("c_custkey").cast("int").alias("id_cliente"),
        F.col("c_name").alias("nombre"),
        F.col("c_mktsegment").alias("tipo"),
        F.when(F.col("c_acctbal") < 3000, "Pequeño").when(F.col("c_acctbal") < 7000, "Mediano")
        .otherwise("Grande").alias("tamano"),
        F.col("c_mktsegment").alias("segmento"),
        F.col("c_nationkey").cast("int").alias("id_mercado"),
        (F.col("c_custkey") % 4 + 1).cast("int").alias("id_plan"),
        (F.col("c_custkey") % 5 + 1).cast("int").alias("id_canal"),
        "fecha_alta")


def _client_period(spark, sf_dir) -> DataFrame:
    """orders grouped by (period, client): the grain of the client facts."""
    o = _orders_p(spark, sf_dir)
    g = o.groupBy("id_tiempo", "o_custkey").agg(
        F.sum(F.floor(F.col("o_totalprice") + F.lit(0.5))).alias("mrr_cents"),
        F.min(F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)).alias("all_f"),
        F.count(F.lit(1)).alias("n_orders"),
        F.min("o_orderkey").alias("min_ok"),
        F.max("o_orderkey").alias("max_ok"),
        F.sum(F.col("o_orderkey") % 97).alias("ses_raw"),
        F.sum(F.col("o_orderkey") % 11).alias("dash_raw"))
    return g


def fact_suscripcion(spark, sf_dir, g: DataFrame | None = None) -> DataFrame:
    from pyspark.sql import Window
    g = g if g is not None else _client_period(spark, sf_dir)
    w = Window.partitionBy("o_custkey").orderBy("id_tiempo")
    first = F.min("id_tiempo").over(Window.partitionBy("o_custkey"))
    prev = F.lag("mrr_cents").over(w)
    return g.select(
        (F.col("o_custkey") * 1000000 + F.col("id_tiempo")).cast("long").alias("id_suscripcion"),
        F.col("id_tiempo").cast("int").alias("id_tiempo"),
        F.col("o_custkey").cast("int").alias("id_cliente"),
        (F.col("o_custkey") % 4 + 1).cast("int").alias("id_plan"),
        F.when(F.col("all_f") == 1, 3).otherwise(1).cast("int").alias("id_estado"),
        cents_to_decimal("mrr_cents", 10).alias("mrr"),
        F.when(F.col("id_tiempo") == first, 1).otherwise(0).cast("int").alias("es_nuevo"),
        F.when(prev.isNotNull() & (F.col("mrr_cents") > prev), 1).otherwise(0).cast("int").alias("es_upgrade"),
        F.when(prev.isNotNull() & (F.col("mrr_cents") < prev), 1).otherwise(0).cast("int").alias("es_downgrade"),
        F.col("all_f").cast("int").alias("es_churn"))


def fact_retencion(spark, sf_dir, g: DataFrame | None = None) -> DataFrame:
    from pyspark.sql import Window
    g = g if g is not None else _client_period(spark, sf_dir)
    w = (Window.partitionBy("o_custkey").orderBy("id_tiempo")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return g.select(
        (F.col("o_custkey") * 1000000 + F.col("id_tiempo")).cast("long").alias("id_retencion"),
        F.col("id_tiempo").cast("int").alias("id_tiempo"),
        F.col("o_custkey").cast("int").alias("id_cliente"),
        (1 - F.col("all_f")).cast("int").alias("activo"),
        F.col("all_f").cast("int").alias("cancelacion"),
        cents_to_decimal(F.sum("mrr_cents").over(w), 12).alias("ltv"),
        cents_to_decimal(F.col("min_ok") % 100, 5).alias("riesgo_churn"))


def fact_uso_plataforma(spark, sf_dir, g: DataFrame | None = None) -> DataFrame:
    g = g if g is not None else _client_period(spark, sf_dir)
    tot = F.lit(3) + F.col("min_ok") % 20
    return g.select(
        (F.col("o_custkey") * 1000000 + F.col("id_tiempo")).cast("long").alias("id_uso"),
        F.col("id_tiempo").cast("int").alias("id_tiempo"),
        F.col("o_custkey").cast("int").alias("id_cliente"),
        (F.col("ses_raw") + 5).cast("int").alias("sesiones"),
        F.col("dash_raw").cast("int").alias("dashboards_vistos"),
        (F.col("n_orders") + F.col("min_ok") % 9).cast("int").alias("funciones_usadas"),
        (F.col("max_ok") % (tot + 1)).cast("int").alias("usuarios_activos"),
        tot.cast("int").alias("usuarios_totales"),
        (F.col("min_ok") % 12 - 1).cast("int").alias("nps_score"))


def _api_grain(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_extendedprice", "l_discount")
    o = _orders_p(spark, sf_dir).select("o_orderkey", "id_tiempo")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return j.groupBy("id_tiempo", (F.col("l_suppkey") % 6 + 1).cast("int").alias("id_partner")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("l_linenumber").alias("ln_sum"),
        F.sum(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("n_r"),
        F.sum(F.floor(F.col("l_extendedprice") * F.col("l_discount") + F.lit(0.5))).alias("rev_cents"))


def fact_consumo_api(spark, sf_dir, g: DataFrame | None = None) -> DataFrame:
    g = g if g is not None else _api_grain(spark, sf_dir)
    return g.select(
        (F.col("id_tiempo").cast("long") * 10 + F.col("id_partner")).alias("id_consumo"),
        F.col("id_tiempo").cast("int").alias("id_tiempo"),
        "id_partner",
        (F.col("n") * 100).cast("long").alias("llamadas"),
        cents_to_decimal(F.lit(8000) + (F.col("ln_sum") * 37) % 20000, 8).alias("latencia_ms"),
        F.col("n_r").cast("int").alias("errores"),
        cents_to_decimal("rev_cents", 12).alias("ingreso_api"))


def fact_integracion_partner(spark, sf_dir, g: DataFrame | None = None) -> DataFrame:
    g = g if g is not None else _api_grain(spark, sf_dir)
    return g.select(
        (F.col("id_tiempo").cast("long") * 10 + F.col("id_partner")).alias("id_integracion"),
        F.col("id_tiempo").cast("int").alias("id_tiempo"),
        "id_partner",
        (F.col("n") % 50 + 1).cast("int").alias("conexiones_activas"),
        cents_to_decimal("rev_cents", 12).alias("ingreso_api"))


def _market_grain(spark, sf_dir, with_channel: bool) -> DataFrame:
    o = _orders_p(spark, sf_dir)
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    j = o.join(c, o.o_custkey == c.c_custkey)
    keys = ["id_tiempo", F.col("c_nationkey").cast("int").alias("id_mercado")]
    if with_channel:
        keys.append((F.col("c_custkey") % 5 + 1).cast("int").alias("id_canal"))
    return j.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("o_orderkey").alias("ok_sum"),
        F.sum(F.when(F.col("o_orderstatus") == "P", 1).otherwise(0)).alias("n_p"),
        F.sum(F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)).alias("n_f"),
        F.sum(F.floor(F.col("o_totalprice") / 10.0 + F.lit(0.5))).alias("cloud_cents"),
        F.sum(F.floor(F.col("o_totalprice") + F.lit(0.5))).alias("tp_cents"))


def fact_disponibilidad(spark, sf_dir, g: DataFrame | None = None) -> DataFrame:
    g = g if g is not None else _market_grain(spark, sf_dir, False)
    return g.select(
        (F.col("id_tiempo").cast("long") * 1000 + F.col("id_mercado")).alias("id_disponibilidad"),
        F.col("id_tiempo").cast("int").alias("id_tiempo"), "id_mercado",
        (( F.lit(99000) + F.col("ok_sum") % 1000).cast("double") / 1000.0).cast("decimal(6,3)").alias("uptime"),
        cents_to_decimal(F.lit(10000) + (F.col("n") * 613) % 20000, 8).alias("latencia_ms"),
        (F.col("n_p") % 5).cast("int").alias("incidentes"),
        (F.col("n") % 7 + 1).cast("int").alias("despliegues"),
        cents_to_decimal(F.lit(50) + F.col("ok_sum") % 200, 5).alias("time_to_market_dias"),
        cents_to_decimal("cloud_cents", 10).alias("costo_cloud"))


def fact_conversion(spark, sf_dir, g: DataFrame | None = None) -> DataFrame:
    g = g if g is not None else _market_grain(spark, sf_dir, True)
    return g.select(
        (F.col("id_tiempo").cast("long") * 100000 + F.col("id_mercado") * 10 + F.col("id_canal")).alias(
            "id_conversion"),
        F.col("id_tiempo").cast("int").alias("id_tiempo"), "id_mercado", "id_canal",
        (F.col("n") * 3).cast("int").alias("leads"),
        (F.col("n") * 2).cast("int").alias("oportunidades"),
        F.col("n_f").cast("int").alias("conversiones"),
        cents_to_decimal(F.col("tp_cents") % 150000, 10).alias("cac"))


def fact_aprendizaje(spark, sf_dir) -> DataFrame:
    o = _orders_p(spark, sf_dir)
    g = o.groupBy("id_tiempo").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("ok_sum"),
                                   F.sum("o_custkey").alias("ck_sum"))
    return g.select(
        F.col("id_tiempo").cast("long").alias("id_aprendizaje"),
        F.col("id_tiempo").cast("int").alias("id_tiempo"),
        cents_to_decimal(F.lit(1000) + F.col("n") % 3000, 6).alias("horas_capacitacion"),
        cents_to_decimal(F.lit(5000) + F.col("ok_sum") % 5000, 5).alias("decisiones_data_driven"),
        (F.col("n") % 6).cast("int").alias("tecnologias_adoptadas"),
        cents_to_decimal(F.lit(500) + F.col("ck_sum") % 1000, 5).alias("rotacion_personal"),
        (F.col("n") % 9).cast("int").alias("modelos_ml_produccion"))


def business_grains(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The shared group-by grains of the business facts (each one shuffle)."""
    return {"client_period": _client_period(spark, sf_dir), "api_grain": _api_grain(spark, sf_dir),
            "market_grain": _market_grain(spark, sf_dir, False), "channel_grain": _market_grain(spark, sf_dir, True)}


def business_star(spark: SparkSession, sf_dir: str, grains: dict[str, DataFrame] | None = None
                  ) -> dict[str, DataFrame]:
    """Dimensions and facts; facts are projections (and per-client windows)
    of ``grains`` — pass written grains so each is aggregated once."""
    g = grains or business_grains(spark, sf_dir)
    return {
        "dim_tiempo": dim_tiempo(spark, sf_dir),
        "dim_mercado": dim_mercado(spark, sf_dir),
        "dim_plan": dim_plan(spark),
        "dim_canal_adquisicion": dim_canal(spark),
        "dim_partner_api": dim_partner_api(spark, sf_dir),
        "dim_cliente": dim_cliente(spark, sf_dir),
        "fact_suscripcion": fact_suscripcion(spark, sf_dir, g["client_period"]),
        "fact_retencion": fact_retencion(spark, sf_dir, g["client_period"]),
        "fact_uso_plataforma": fact_uso_plataforma(spark, sf_dir, g["client_period"]),
        "fact_consumo_api": fact_consumo_api(spark, sf_dir, g["api_grain"]),
        "fact_integracion_partner": fact_integracion_partner(spark, sf_dir, g["api_grain"]),
        "fact_disponibilidad": fact_disponibilidad(spark, sf_dir, g["market_grain"]),
        "fact_conversion": fact_conversion(spark, sf_dir, g["channel_grain"]),
        "fact_aprendizaje": fact_aprendizaje(spark, sf_dir),
    }


def _c2d(expr: str, p: int) -> str:
    return f"CAST(CAST({expr} AS DOUBLE) / 100.0 AS DECIMAL({p},2))"


_MONTHS_SQL = "[" + ", ".join(f"'{m}'" for m in MONTH_NAMES_ES) + "]"
_PLANS_SQL = " UNION ALL ".join(
    f"SELECT {i} AS id_plan, '{n}' AS nombre, CAST({p} AS DECIMAL(10,2)) AS precio_mensual" for i, n, p in PLANS)

BUSINESS_SQL: dict[str, str] = {
    "orders_p": """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
                   CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS id_tiempo FROM orders""",
    "dim_tiempo": f"""SELECT id_tiempo, make_date(CAST(id_tiempo // 100 AS INTEGER), CAST(id_tiempo % 100 AS INTEGER), 1) AS fecha,
                   CAST(id_tiempo // 100 AS INTEGER) AS anio,
                   CAST((id_tiempo % 100 - 1) // 3 + 1 AS INTEGER) AS trimestre,
                   CAST(id_tiempo % 100 AS INTEGER) AS mes,
                   list_extract({_MONTHS_SQL}, CAST(id_tiempo % 100 AS INTEGER)) AS mes_nombre,
                   CAST(id_tiempo // 100 AS VARCHAR) || '-' || lpad(CAST(id_tiempo % 100 AS VARCHAR), 2, '0') AS periodo
                   FROM (SELECT DISTINCT id_tiempo FROM orders_p) t""",
    "dim_mercado": """SELECT CAST(n.n_nationkey AS INTEGER) AS id_mercado, n.n_name AS pais, r.r_name AS region_geo
                   FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "dim_plan": _PLANS_SQL,
    "dim_cliente": """SELECT CAST(c.c_custkey AS INTEGER) AS id_cliente, c.c_name AS nombre, c.c_mktsegment AS tipo,
                   CASE WHEN c.c_acctbal < 3000 THEN 'Pequeño' WHEN c.c_acctbal < 7000 THEN 'Mediano' ELSE 'Grande' END AS tamano,
                   c.c_mktsegment AS segmento, CAST(c.c_nationkey AS INTEGER) AS id_mercado,
                   CAST(c.c_custkey % 4 + 1 AS INTEGER) AS id_plan, CAST(c.c_custkey % 5 + 1 AS INTEGER) AS id_canal,
                   f.fecha_alta
                   FROM customer c LEFT JOIN (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS fecha_alta
                                              FROM orders_p GROUP BY o_custkey) f ON c.c_custkey = f.o_custkey""",
    "client_period": """SELECT id_tiempo, o_custkey,
                   CAST(sum(floor(o_totalprice + 0.5)) AS BIGINT) AS mrr_cents,
                   min(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS all_f,
                   count(*) AS n_orders, min(o_orderkey) AS min_ok, max(o_orderkey) AS max_ok,
                   CAST(sum(o_orderkey % 97) AS BIGINT) AS ses_raw, CAST(sum(o_orderkey % 11) AS BIGINT) AS dash_raw
                   FROM orders_p GROUP BY id_tiempo, o_custkey""",
    "fact_suscripcion": f"""SELECT CAST(o_custkey * 1000000 + id_tiempo AS BIGINT) AS id_suscripcion, id_tiempo,
                   CAST(o_custkey AS INTEGER) AS id_cliente, CAST(o_custkey % 4 + 1 AS INTEGER) AS id_plan,
                   CAST(CASE WHEN all_f = 1 THEN 3 ELSE 1 END AS INTEGER) AS id_estado,
                   {_c2d('mrr_cents', 10)} AS mrr,
                   CAST(CASE WHEN id_tiempo = min(id_tiempo) OVER (PARTITION BY o_custkey) THEN 1 ELSE 0 END AS INTEGER) AS es_nuevo,
                   CAST(CASE WHEN mrr_cents > lag(mrr_cents) OVER (PARTITION BY o_custkey ORDER BY id_tiempo) THEN 1 ELSE 0 END AS INTEGER) AS es_upgrade,
                   CAST(CASE WHEN mrr_cents < lag(mrr_cents) OVER (PARTITION BY o_custkey ORDER BY id_tiempo) THEN 1 ELSE 0 END AS INTEGER) AS es_downgrade,
                   CAST(all_f AS INTEGER) AS es_churn
                   FROM client_period""",
    "fact_retencion": f"""SELECT CAST(o_custkey * 1000000 + id_tiempo AS BIGINT) AS id_retencion, id_tiempo,
                   CAST(o_custkey AS INTEGER) AS id_cliente, CAST(1 - all_f AS INTEGER) AS activo,
                   CAST(all_f AS INTEGER) AS cancelacion,
                   {_c2d('sum(mrr_cents) OVER (PARTITION BY o_custkey ORDER BY id_tiempo ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)', 12)} AS ltv,
                   {_c2d('min_ok % 100', 5)} AS riesgo_churn
                   FROM client_period""",
    "fact_uso_plataforma": """SELECT CAST(o_custkey * 1000000 + id_tiempo AS BIGINT) AS id_uso, id_tiempo,
                   CAST(o_custkey AS INTEGER) AS id_cliente, CAST(ses_raw + 5 AS INTEGER) AS sesiones,
                   CAST(dash_raw AS INTEGER) AS dashboards_vistos,
                   CAST(n_orders + min_ok % 9 AS INTEGER) AS funciones_usadas,
                   CAST(max_ok % (3 + min_ok % 20 + 1) AS INTEGER) AS usuarios_activos,
                   CAST(3 + min_ok % 20 AS INTEGER) AS usuarios_totales,
                   CAST(min_ok % 12 - 1 AS INTEGER) AS nps_score
                   FROM client_period""",
    "api_grain": """SELECT o.id_tiempo, CAST(l.l_suppkey % 6 + 1 AS INTEGER) AS id_partner, count(*) AS n,
                   CAST(sum(l.l_linenumber) AS BIGINT) AS ln_sum,
                   CAST(sum(CASE WHEN l.l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS n_r,
                   CAST(sum(floor(l.l_extendedprice * l.l_discount + 0.5)) AS BIGINT) AS rev_cents
                   FROM lineitem l JOIN orders_p o ON l.l_orderkey = o.o_orderkey GROUP BY 1, 2""",
    "fact_consumo_api": f"""SELECT CAST(id_tiempo AS BIGINT) * 10 + id_partner AS id_consumo, id_tiempo, id_partner,
                   CAST(n * 100 AS BIGINT) AS llamadas, {_c2d('8000 + (ln_sum * 37) % 20000', 8)} AS latencia_ms,
                   CAST(n_r AS INTEGER) AS errores, {_c2d('rev_cents', 12)} AS ingreso_api FROM api_grain""",
    "fact_integracion_partner": f"""SELECT CAST(id_tiempo AS BIGINT) * 10 + id_partner AS id_integracion, id_tiempo, id_partner,
                   CAST(n % 50 + 1 AS INTEGER) AS conexiones_activas, {_c2d('rev_cents', 12)} AS ingreso_api FROM api_grain""",
    "market_grain": """SELECT o.id_tiempo, CAST(c.c_nationkey AS INTEGER) AS id_mercado, count(*) AS n,
                   CAST(sum(o.o_orderkey) AS BIGINT) AS ok_sum,
                   CAST(sum(CASE WHEN o.o_orderstatus = 'P' THEN 1 ELSE 0 END) AS BIGINT) AS n_p,
                   CAST(sum(floor(o.o_totalprice / 10.0 + 0.5)) AS BIGINT) AS cloud_cents
                   FROM orders_p o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1, 2""",
    "channel_grain": """SELECT o.id_tiempo, CAST(c.c_nationkey AS INTEGER) AS id_mercado,
                   CAST(c.c_custkey % 5 + 1 AS INTEGER) AS id_canal, count(*) AS n,
                   CAST(sum(CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS n_f,
                   CAST(sum(floor(o.o_totalprice + 0.5)) AS BIGINT) AS tp_cents
                   FROM orders_p o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1, 2, 3""",
    "fact_disponibilidad": f"""SELECT CAST(id_tiempo AS BIGINT) * 1000 + id_mercado AS id_disponibilidad, id_tiempo, id_mercado,
                   CAST(CAST(99000 + ok_sum % 1000 AS DOUBLE) / 1000.0 AS DECIMAL(6,3)) AS uptime,
                   {_c2d('10000 + (n * 613) % 20000', 8)} AS latencia_ms,
                   CAST(n_p % 5 AS INTEGER) AS incidentes, CAST(n % 7 + 1 AS INTEGER) AS despliegues,
                   {_c2d('50 + ok_sum % 200', 5)} AS time_to_market_dias,
                   {_c2d('cloud_cents', 10)} AS costo_cloud FROM market_grain""",
    "fact_conversion": f"""SELECT CAST(id_tiempo AS BIGINT) * 100000 + id_mercado * 10 + id_canal AS id_conversion,
                   id_tiempo, id_mercado, id_canal, CAST(n * 3 AS INTEGER) AS leads,
                   CAST(n * 2 AS INTEGER) AS oportunidades, CAST(n_f AS INTEGER) AS conversiones,
                   {_c2d('tp_cents % 150000', 10)} AS cac FROM channel_grain""",
    "fact_aprendizaje": f"""SELECT CAST(id_tiempo AS BIGINT) AS id_aprendizaje, id_tiempo,
                   {_c2d('1000 + n % 3000', 6)} AS horas_capacitacion,
                   {_c2d('5000 + ok_sum % 5000', 5)} AS decisiones_data_driven,
                   CAST(n % 6 AS INTEGER) AS tecnologias_adoptadas,
                   {_c2d('500 + ck_sum % 1000', 5)} AS rotacion_personal,
                   CAST(n % 9 AS INTEGER) AS modelos_ml_produccion
                   FROM (SELECT id_tiempo, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS ok_sum,
                                CAST(sum(o_custkey) AS BIGINT) AS ck_sum FROM orders_p GROUP BY id_tiempo) a""",
}


def business_with() -> str:
    """``WITH`` clause defining every business-star table for the oracle."""
    return "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in BUSINESS_SQL.items())


# ======================================================================
# Clickstream (legacy) from ``events``
# ======================================================================
# Clickstream category / channel / device / region / source names.
CATEGORIES = ["tinto", "blanco", "rosado", "espumoso", "dulce"]
CHANNELS_WEB = ["web", "app", "tienda"]
DEVICES = ["desktop", "mobile", "tablet"]
REGIONS = ["norte", "sur", "este", "oeste"]
SOURCES = ["organico", "pago", "referido", "email"]

CLICK_COLUMNS = ["session_id", "user_id", "timestamp_utc", "event_index", "user_action", "product_id", "category",
                 "brand", "price", "channel", "device_type", "region", "traffic_source", "time_spent_sec",
                 "session_length", "interaction_count", "is_conversion", "drop_off_flag"]


def clickstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-C typed clickstream rows (18 columns in contract order) from ``events``.

    session = (user, day).  event_index is the position inside the session
    from the two-pass numbering (a hot session is split across range
    partitions, never one task); session_length is a group count joined back.
    """
    from terroir.operators.ids import rank_within_groups
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").try_cast("long")
    sess = F.concat(F.lit("S"), F.col("user_id").cast("string"), F.lit("-"),
                    F.date_format("ts", "yyyyMMdd"))

    def pick(values, idx):
        return F.element_at(F.array(*[F.lit(v) for v in values]), (idx % len(values) + 1).cast("int"))
    df = e.select("event_id", "ts", "user_id", "event_type", "value", k.alias("k"), sess.alias("session_id"))
    df = rank_within_groups(df, "session_id", ["ts", "event_id"], "event_index")
    lengths = df.groupBy("session_id").agg(F.count(F.lit(1)).cast("int").alias("session_length"))
    df = df.join(lengths, "session_id")
    return df.select(
        "session_id",
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("user_id"),
        F.col("ts").alias("timestamp_utc"),
        F.col("event_index").cast("int").alias("event_index"),
        F.col("event_type").alias("user_action"),
        F.concat(F.lit("P"), (F.col("k") % 50).cast("string")).alias("product_id"),
        pick(CATEGORIES, F.col("k")).alias("category"),
        F.concat(F.lit("B"), (F.col("k") % 7).cast("string")).alias("brand"),
        F.col("value").alias("price"),
        pick(CHANNELS_WEB, F.col("user_id")).alias("channel"),
        pick(DEVICES, F.floor(F.col("user_id") / 3)).alias("device_type"),
        pick(REGIONS, F.col("user_id")).alias("region"),
        pick(SOURCES, F.col("event_id")).alias("traffic_source"),
        F.when(F.col("event_type") != "error", F.col("k")).cast("int").alias("time_spent_sec"),
        "session_length",
        F.when(F.col("event_type") != "error", F.col("k") % 10).cast("int").alias("interaction_count"),
        (F.col("event_type") == "purchase").alias("is_conversion"),
        (F.col("event_type") == "error").alias("drop_off_flag"))


def _pick_sql(values, idx):
    return "[" + ", ".join(f"'{v}'" for v in values) + f"][CAST(({idx}) % {len(values)} + 1 AS INTEGER)]"


CLICKSTREAM_SQL = f"""SELECT session_id, 'U' || CAST(user_id AS VARCHAR) AS user_id, ts AS timestamp_utc,
  CAST(row_number() OVER (PARTITION BY session_id ORDER BY ts, event_id) AS INTEGER) AS event_index,
  event_type AS user_action, 'P' || CAST(k % 50 AS VARCHAR) AS product_id,
  {_pick_sql(CATEGORIES, 'k')} AS category, 'B' || CAST(k % 7 AS VARCHAR) AS brand, value AS price,
  {_pick_sql(CHANNELS_WEB, 'user_id')} AS channel, {_pick_sql(DEVICES, 'user_id // 3')} AS device_type,
  {_pick_sql(REGIONS, 'user_id')} AS region, {_pick_sql(SOURCES, 'event_id')} AS traffic_source,
  CAST(CASE WHEN event_type <> 'error' THEN k END AS INTEGER) AS time_spent_sec,
  CAST(count(*) OVER (PARTITION BY session_id) AS INTEGER) AS session_length,
  CAST(CASE WHEN event_type <> 'error' THEN k % 10 END AS INTEGER) AS interaction_count,
  event_type = 'purchase' AS is_conversion, event_type = 'error' AS drop_off_flag
FROM (SELECT *, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
             'S' || CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d') AS session_id FROM events) e"""
