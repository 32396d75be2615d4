"""Query plans: quality suites and orphan / uniqueness checks (Q01-Q08),
batch ingest validation (Q06/A20), source-registry validation (S08),
typed publication (K07) and the report documents (A21, A25)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terroir.functions import sql_round_half_up as R
from terroir.operators import ingest as IG
from terroir.operators import quality as Q
from terroir.operators import scorecard as B
from terroir.plans import business as PB
from terroir.plans import reviews as PR
from terroir.plans.registry import register
from terroir.sinks import publish
from terroir.sources import readers as RD
from terroir.sources import testdata as T

# ====================================================== Q01 / Q04 / Q05 / Q08
FACT_CHECKS = [Q.expect_not_null("id_resena"), Q.expect_not_null("title"), Q.expect_between("points", 80, 100, 0.7),
               Q.expect_between("price", 0, 100000), Q.expect_in("region_2", [""])]


@register("q08_fact_suite", PR.q("""SELECT 'fact_resenas' AS dataset, e.* FROM (
  SELECT 'not_null:id_resena' AS expectativa, count(*) AS evaluadas, count(*) - count(id_resena) AS fallidas,
         count(*) - count(id_resena) = 0 AS exito FROM fact_resenas
  UNION ALL SELECT 'not_null:title', count(*), count(*) - count(title), count(*) - count(title) = 0 FROM fact_resenas
  UNION ALL SELECT 'between:points', count(points), count(CASE WHEN points NOT BETWEEN 80 AND 100 THEN 1 END),
         count(points) = 0 OR (count(points) - count(CASE WHEN points NOT BETWEEN 80 AND 100 THEN 1 END))
             / count(points) >= 0.7 FROM fact_resenas
  UNION ALL SELECT 'between:price', count(price), count(CASE WHEN price NOT BETWEEN 0 AND 100000 THEN 1 END),
         count(CASE WHEN price NOT BETWEEN 0 AND 100000 THEN 1 END) = 0 FROM fact_resenas
  UNION ALL SELECT 'in_set:region_2', count(region_2), count(CASE WHEN region_2 NOT IN ('') THEN 1 END),
         count(CASE WHEN region_2 NOT IN ('') THEN 1 END) = 0 FROM fact_resenas) e"""))
def q08_fact_suite(spark, sf_dir):
    """All row-local checks of the fact in one aggregate (one scan)."""
    return Q.suite_plan("fact_resenas", PR.star(spark, sf_dir)["fact_resenas"], FACT_CHECKS)


_FKS = [("dim_pais", "id_pais"), ("dim_variedad", "id_variedad"), ("dim_bodega", "id_bodega"),
        ("dim_provincia", "id_provincia"), ("dim_region", "id_region"), ("dim_catador", "id_catador")]


@register("q03_fk_orphans", PR.q(" UNION ALL ".join(
    f"SELECT '{k}' AS clave, count(*) AS huerfanos FROM fact_resenas f WHERE f.{k} IS NOT NULL AND NOT EXISTS "
    f"(SELECT 1 FROM {d} x WHERE x.{k} = f.{k})" for d, k in _FKS)))
def q03_fk_orphans(spark, sf_dir):
    """Non-null foreign keys without a parent, per relationship.

    One scan of the fact: its distinct (key, value) pairs are few, so they
    are counted first and only those counts meet the dimensions' keys."""
    s = PR.star(spark, sf_dir)
    pairs = F.array(*[F.struct(F.lit(k).alias("clave"), F.col(k).cast("long").alias("v")) for _, k in _FKS])
    counts = (s["fact_resenas"].select(F.explode(pairs).alias("e")).select("e.*").filter(F.col("v").isNotNull())
              .groupBy("clave", "v").agg(F.count(F.lit(1)).alias("n")))
    parents = reduce(DataFrame.unionByName, [s[d].select(F.lit(k).alias("clave"), F.col(k).cast("long").alias("v"))
                                             for d, k in _FKS]).distinct().withColumn("_ok", F.lit(True))
    keys = spark.createDataFrame([(k,) for _, k in _FKS], "clave string")
    found = (counts.join(parents, ["clave", "v"], "left").groupBy("clave")
             .agg(F.sum(F.when(F.col("_ok").isNull(), F.col("n")).otherwise(F.lit(0))).alias("huerfanos")))
    return keys.join(found, "clave", "left").select("clave", F.coalesce("huerfanos", F.lit(0)).alias("huerfanos"))


@register("q02_unique_keys", PR.q("""SELECT 'fact_resenas.id_resena' AS clave, CAST(coalesce(sum(n), 0) AS BIGINT)
  AS duplicadas FROM
  (SELECT id_resena, count(*) AS n FROM fact_resenas WHERE id_resena IS NOT NULL GROUP BY 1 HAVING count(*) > 1) d
  UNION ALL SELECT 'dim_bodega.nombre', CAST(coalesce(sum(n), 0) AS BIGINT) FROM
  (SELECT nombre, count(*) AS n FROM dim_bodega GROUP BY 1 HAVING count(*) > 1) d"""))
def q02_unique_keys(spark, sf_dir):
    s = PR.star(spark, sf_dir)

    def dup(df, c, label):
        return (df.filter(F.col(c).isNotNull()).groupBy(c).count().filter("count > 1")
                .agg(F.coalesce(F.sum("count"), F.lit(0)).alias("duplicadas"))
                .select(F.lit(label).alias("clave"), "duplicadas"))
    return dup(s["fact_resenas"], "id_resena", "fact_resenas.id_resena").unionByName(
        dup(s["dim_bodega"], "nombre", "dim_bodega.nombre"))


# ====================================================== Q06 / A20 / K02
INGEST_DATE = "2024-02-01"
_BATCH_SQL = """, batch AS (SELECT ordinal, title, CAST(points AS VARCHAR) AS points, taster_name, winery,
    CASE WHEN title IS NULL OR trim(title) = '' THEN 'campo_faltante:title'
         WHEN points IS NULL THEN 'campo_faltante:points'
         WHEN taster_name IS NULL OR trim(taster_name) = '' THEN 'campo_faltante:taster_name'
         WHEN winery IS NULL OR trim(winery) = '' THEN 'campo_faltante:winery'
         WHEN points NOT BETWEEN 80 AND 100 THEN 'dominio:puntaje_fuera_de_rango:' || CAST(points AS VARCHAR)
         ELSE '' END AS motivo_rechazo FROM clean)
"""


def _batch(spark, sf_dir):
    f = PR.feed(spark, sf_dir).select("ordinal", "title", F.col("points").cast("string").alias("points"),
                                      "taster_name", "winery")
    return IG.ingest_batch(f, "reseñas", "lineitem-feed", INGEST_DATE)


@register("q06_ingest_report", PR.q(_BATCH_SQL + f"""SELECT 'lineitem-feed' AS fuente, 'reseñas' AS tipo,
    '{INGEST_DATE}' AS fecha_ingesta, 'taster_name,title,winery' AS clave_natural, count(*) AS filas_leidas,
    count(CASE WHEN motivo_rechazo = '' THEN 1 END) AS filas_validas,
    count(CASE WHEN motivo_rechazo = '' THEN 1 END) - (SELECT count(*) FROM (SELECT DISTINCT taster_name, title, winery
       FROM batch WHERE motivo_rechazo = '') d) AS filas_duplicadas,
    count(CASE WHEN motivo_rechazo <> '' THEN 1 END) AS filas_rechazadas,
    CAST(CASE WHEN count(*) = 0 OR count(CASE WHEN motivo_rechazo <> '' THEN 1 END) / count(*) > 0.05 THEN 0
         ELSE (SELECT count(*) FROM (SELECT DISTINCT taster_name, title, winery FROM batch WHERE motivo_rechazo = '') d)
         END AS BIGINT) AS filas_cargadas,
    {R("CASE WHEN count(*) > 0 THEN count(CASE WHEN motivo_rechazo <> '' THEN 1 END) / count(*) ELSE 0.0 END * 100", 2)}
       AS pct_rechazo, CAST(5.0 AS DOUBLE) AS umbral_pct,
    CASE WHEN count(*) = 0 THEN 'FALLIDA' WHEN count(CASE WHEN motivo_rechazo <> '' THEN 1 END) / count(*) > 0.05
         THEN 'FALLIDA' WHEN count(CASE WHEN motivo_rechazo <> '' THEN 1 END) > 0 THEN 'PARCIAL'
         ELSE 'COMPLETADA' END AS estado FROM batch"""))
def q06_ingest_report(spark, sf_dir):
    return _batch(spark, sf_dir)[2]


@register("q06_rejects_by_reason", PR.q(_BATCH_SQL + """SELECT motivo_rechazo, count(*) AS filas FROM batch
    WHERE motivo_rechazo <> '' GROUP BY 1"""))
def q06_rejects_by_reason(spark, sf_dir):
    return _batch(spark, sf_dir)[1].groupBy("motivo_rechazo").agg(F.count(F.lit(1)).alias("filas"))


@register("q06_valid_deduplicated", PR.q(_BATCH_SQL + """SELECT taster_name, title, winery,
    arg_min(ordinal, ordinal) AS ordinal, arg_min(points, ordinal) AS points FROM batch WHERE motivo_rechazo = ''
    GROUP BY 1, 2, 3"""))
def q06_valid_deduplicated(spark, sf_dir):
    """First valid row (input order) per natural key."""
    return _batch(spark, sf_dir)[0].select("taster_name", "title", "winery", "ordinal", "points")


# ====================================================== S08 (registry from supplier)
_TYPES = ["reseñas", "precios", "puntuaciones", "clima"]
_FORMATS = ["csv", "json", "parquet", "api", "xml"]
_FREQ = ["0 3 * * *", "*/15 * * * *", "diaria", ""]


def _pick(values, idx):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx % len(values) + 1).cast("int"))


def _pick_sql(values, idx):
    return "[" + ", ".join(f"'{v}'" for v in values) + f"][CAST(({idx}) % {len(values)} + 1 AS INTEGER)]"


@register("s08_registry_validation", f"""SELECT s_suppkey AS id,
  CASE WHEN s_acctbal < 0 THEN '' ELSE s_name END AS nombre,
  {_pick_sql(_TYPES, 's_suppkey')} AS tipo, {_pick_sql(_FORMATS, 's_suppkey // 3')} AS formato,
  CASE WHEN s_nationkey % 7 = 0 THEN '' ELSE 'https://src.example/' || CAST(s_suppkey AS VARCHAR) END AS endpoint,
  {_pick_sql(_FREQ, 's_nationkey')} AS frecuencia,
  list_filter([CASE WHEN s_acctbal < 0 THEN 'nombre_requerido' END,
     CASE WHEN {_pick_sql(_TYPES, 's_suppkey')} NOT IN ('reseñas', 'precios', 'puntuaciones') THEN 'tipo_invalido' END,
     CASE WHEN {_pick_sql(_FORMATS, 's_suppkey // 3')} NOT IN ('csv', 'json', 'parquet', 'api') THEN 'formato_invalido' END,
     CASE WHEN s_nationkey % 7 = 0 THEN 'endpoint_requerido' END,
     CASE WHEN {_pick_sql(_FREQ, 's_nationkey')} = '' OR len(string_split_regex(trim({_pick_sql(_FREQ, 's_nationkey')}), '\\s+')) < 5
          THEN 'frecuencia_cron_invalida' END], lambda x: x IS NOT NULL)::VARCHAR AS errores
FROM supplier""")
def s08_registry_validation(spark, sf_dir):
    s = T.table(spark, sf_dir, "supplier")
    reg = s.select(F.col("s_suppkey").alias("id"),
                   F.when(F.col("s_acctbal") < 0, "").otherwise(F.col("s_name")).alias("nombre"),
                   _pick(_TYPES, F.col("s_suppkey")).alias("tipo"),
                   _pick(_FORMATS, F.floor(F.col("s_suppkey") / 3)).alias("formato"),
                   F.when(F.col("s_nationkey") % 7 == 0, "")
                   .otherwise(F.concat(F.lit("https://src.example/"), F.col("s_suppkey").cast("string"))).alias("endpoint"),
                   _pick(_FREQ, F.col("s_nationkey")).alias("frecuencia"))
    v = RD.validate_registry(reg)
    return v.withColumn("errores", F.concat(F.lit("["), F.array_join("errores", ", "), F.lit("]")))


# ====================================================== K07
_A02_SPEC = [("pais", "string"), ("total", "bigint"), ("puntuacion_promedio", "double"),
             ("precio_promedio", "double"), ("variedades", "bigint")]


@register("k07_publish_by_country", PR.q(f"""SELECT coalesce(pais, '') AS pais, coalesce(total, 0) AS total,
    coalesce(puntuacion_promedio, 0.0) AS puntuacion_promedio, coalesce(precio_promedio, 0.0) AS precio_promedio,
    coalesce(variedades, 0) AS variedades FROM ({PR.A02_SQL}) a"""))
def k07_publish_by_country(spark, sf_dir):
    from terroir.plans.reviews import a02_by_country
    return publish(a02_by_country(spark, sf_dir), _A02_SPEC)


# ====================================================== A21 / A25 (documents: rows-only)
@register("a21_daily_report", PB.qbr(PB.A08_SQL + f""", ult AS (SELECT * FROM ({PB.A11_SQL}) d ORDER BY id_tiempo DESC LIMIT 1)
SELECT '2024-02-01' AS fecha, 'PUBLICADO' AS estado, 4 AS secciones, ult.*, cat.*, a08.calidad, a08.periodo AS calidad_periodo,
       ult.periodo AS traza_periodo
FROM ult, a08, ({PR.A01_SQL}) cat"""))
def a21_daily_report(spark, sf_dir):
    """Latest A11 row + review KPIs (A01) + scorecard quality (A08) as one
    JSON document with 4 sections and traceability; FALLIDO when empty.  The
    document is opened into its fields for the check."""
    from terroir.operators.report import daily_report
    from terroir.plans.reviews import a01_kpis
    s = PB.biz(spark, sf_dir)
    a11, a01 = B.daily_consolidation(s), a01_kpis(spark, sf_dir)
    report = daily_report(a11, a01, PB.published_scorecard(spark, sf_dir), "2024-02-01")
    fields = lambda df: f"struct<{','.join(f'{f.name}:{f.dataType.simpleString()}' for f in df.schema.fields)}>"
    doc = F.from_json("documento", f"operacion {fields(a11)}, catalogo {fields(a01)}, calidad struct<periodo:string,calidad:double>, "
                                   "trazabilidad struct<periodo:string>")
    return report.select("fecha", "estado", "secciones", doc.alias("d")).select(
        "fecha", "estado", "secciones", "d.operacion.*", "d.catalogo.*", "d.calidad.calidad",
        F.col("d.calidad.periodo").alias("calidad_periodo"), F.col("d.trazabilidad.periodo").alias("traza_periodo"))


@register("a25_series_payload", PB.qb(f"""SELECT perspectiva, serie, orden, etiqueta, {R('valor', 2)} AS valor
    FROM ({PB.A09_SQL}) s"""))
def a25_series_payload(spark, sf_dir):
    """The payload per series, opened again into its ordered points."""
    doc = B.series_payload(PB.published_series(spark, sf_dir))
    return doc.select("perspectiva", "serie", F.inline("puntos")).select("perspectiva", "serie", "orden", "etiqueta", "valor")



# ====================================================== P10 / A26 / J15
def _theme_frames(spark, sf_dir):
    from terroir.plans.reviews import a01_kpis, a02_by_country
    return a01_kpis(spark, sf_dir), a02_by_country(spark, sf_dir), PB.published_scorecard(spark, sf_dir)


THEME_MARKET = "NATION_3"


@register("p10_theme_metrics", PB.qbr(PB.A08_SQL + f""", a01 AS (SELECT count(*) AS total_resenas,
    {PR.AVG_POINTS} AS puntuacion_promedio, {PR.AVG_PRICE} AS precio_promedio,
    CAST(max(CASE WHEN price > 0 THEN price END) AS DOUBLE) AS precio_maximo,
    CAST(min(CASE WHEN price > 0 THEN price END) AS DOUBLE) AS precio_minimo FROM fact_resenas),
  a02 AS ({PR.A02_SQL})
SELECT 'resenas' AS tema, CAST(NULL AS VARCHAR) AS mercado, 'total_resenas' AS clave, CAST(total_resenas AS DOUBLE) AS valor FROM a01
UNION ALL SELECT 'resenas', NULL, 'puntuacion_promedio', puntuacion_promedio FROM a01
UNION ALL SELECT 'resenas', '{THEME_MARKET}', 'total_resenas', CAST(total AS DOUBLE) FROM a02 WHERE pais = '{THEME_MARKET}'
UNION ALL SELECT 'resenas', '{THEME_MARKET}', 'puntuacion_promedio', puntuacion_promedio FROM a02 WHERE pais = '{THEME_MARKET}'
UNION ALL SELECT 'precios', NULL, 'precio_promedio', precio_promedio FROM a01
UNION ALL SELECT 'precios', NULL, 'precio_maximo', precio_maximo FROM a01
UNION ALL SELECT 'precios', NULL, 'precio_minimo', precio_minimo FROM a01
UNION ALL SELECT 'precios', '{THEME_MARKET}', 'precio_promedio', precio_promedio FROM a02 WHERE pais = '{THEME_MARKET}'
UNION ALL SELECT 'precios', '{THEME_MARKET}', 'precio_maximo', NULL FROM a02 WHERE pais = '{THEME_MARKET}'
UNION ALL SELECT 'precios', '{THEME_MARKET}', 'precio_minimo', NULL FROM a02 WHERE pais = '{THEME_MARKET}'
UNION ALL SELECT 'ingresos', NULL, 'mrr_actual', mrr_actual FROM a08
UNION ALL SELECT 'ingresos', NULL, 'churn', churn FROM a08
UNION ALL SELECT 'ingresos', NULL, 'clientes_activos', CAST(clientes_activos AS DOUBLE) FROM a08
UNION ALL SELECT 'uso', NULL, 'adopcion', adopcion FROM a08
UNION ALL SELECT 'uso', NULL, 'nps', nps FROM a08"""))
def p10_theme_metrics(spark, sf_dir):
    from terroir.operators.catalog import theme_metrics, union_all
    a01, a02, a08 = _theme_frames(spark, sf_dir)
    return union_all([theme_metrics("resenas", a01, a02, a08), theme_metrics("resenas", a01, a02, a08, THEME_MARKET),
                      theme_metrics("precios", a01, a02, a08),
                      theme_metrics("precios", a01, a02, a08, THEME_MARKET),
                      theme_metrics("ingresos", a01, a02, a08), theme_metrics("uso", a01, a02, a08)])


def _catalogue_sql() -> str:
    from terroir.operators.catalog import THEMES
    rows = [f"('{t}', '{title}', '{k}', '{lbl}', '{unit}', {i})" for t, (title, ms) in THEMES.items()
            for i, (k, lbl, unit) in enumerate(ms)]
    return f"(VALUES {', '.join(rows)}) c(tema, titulo, clave, etiqueta, unidad, orden)"


_THEME_VALUES_SQL = f""", a01 AS (SELECT count(*) AS total_resenas, {PR.AVG_POINTS} AS puntuacion_promedio,
    {PR.AVG_PRICE} AS precio_promedio, CAST(max(CASE WHEN price > 0 THEN price END) AS DOUBLE) AS precio_maximo,
    CAST(min(CASE WHEN price > 0 THEN price END) AS DOUBLE) AS precio_minimo FROM fact_resenas),
  vals AS (SELECT unnest(['total_resenas', 'puntuacion_promedio', 'precio_promedio', 'precio_maximo', 'precio_minimo']) AS clave,
                  unnest([CAST(total_resenas AS DOUBLE), puntuacion_promedio, precio_promedio, precio_maximo, precio_minimo]) AS valor FROM a01
           UNION ALL SELECT unnest(['mrr_actual', 'churn', 'clientes_activos', 'adopcion', 'nps']),
                  unnest([mrr_actual, churn, CAST(clientes_activos AS DOUBLE), adopcion, nps]) FROM a08)
"""


@register("a26_dashboard_definitions", PB.qbr(PB.A08_SQL + _THEME_VALUES_SQL + f"""SELECT u.id_cliente AS cliente, c.tema,
    'principal' AS nombre, 'BORRADOR' AS estado, c.titulo, c.orden, c.clave, c.etiqueta, c.unidad, v.valor
  FROM (SELECT DISTINCT id_cliente FROM fact_uso_plataforma) u
  JOIN {_catalogue_sql()} ON c.tema = ['ingresos', 'resenas', 'precios', 'uso'][CAST(u.id_cliente % 4 + 1 AS INTEGER)]
  JOIN vals v ON v.clave = c.clave"""))
def a26_dashboard_definitions(spark, sf_dir):
    """Drafts for every client with usage, each requesting the theme
    id_cliente % 4; the JSON documents are opened into their metrics."""
    from terroir.operators.catalog import THEMES, dashboard_definition, theme_metrics, union_all
    a01, a02, a08 = _theme_frames(spark, sf_dir)
    values = union_all([theme_metrics(t, a01, a02, a08) for t in THEMES])
    from terroir.plans.business import _a10
    themes = F.element_at(F.array(*[F.lit(t) for t in THEMES]), (F.col("id_cliente") % len(THEMES) + 1).cast("int"))
    req = _a10(spark, sf_dir).select(F.col("id_cliente").alias("cliente"), themes.alias("tema"))
    drafts = dashboard_definition(values, req, "principal", {"mercado": "todos"})
    doc = F.from_json("definicion", "titulo string, metricas array<struct<orden:int,clave:string,etiqueta:string,"
                                    "unidad:string,valor:double>>")
    return (drafts.select("cliente", "tema", "nombre", "estado", doc.alias("d"))
            .select("cliente", "tema", "nombre", "estado", "d.titulo", F.inline("d.metricas")))


@register("j15_channel_resolution", """WITH click AS (""" + T.CLICKSTREAM_SQL + """),
cat AS (SELECT CAST(row_number() OVER (ORDER BY nombre) AS INTEGER) AS id_canal, nombre AS codigo,
               upper(nombre) AS nombre FROM (SELECT DISTINCT channel AS nombre FROM click) c),
ref AS (SELECT session_id, event_index, CASE event_index % 3 WHEN 0 THEN channel WHEN 1 THEN upper(channel)
               ELSE CAST((SELECT id_canal FROM cat WHERE codigo = channel) AS VARCHAR) END AS canal_ref FROM click)
SELECT r.session_id, r.event_index, r.canal_ref,
       coalesce(c1.id_canal, c2.id_canal, c3.id_canal) AS id_canal,
       CASE WHEN coalesce(c1.id_canal, c2.id_canal, c3.id_canal) IS NULL THEN 'canal_inexistente' END AS error
FROM ref r
LEFT JOIN cat c1 ON lower(trim(r.canal_ref)) = lower(c1.codigo)
LEFT JOIN cat c2 ON lower(trim(r.canal_ref)) = lower(c2.nombre)
LEFT JOIN cat c3 ON lower(trim(r.canal_ref)) = CAST(c3.id_canal AS VARCHAR)""")
def j15_channel_resolution(spark, sf_dir):
    """J15 on the clickstream: each row names its channel by code, by name
    or by numeric id (event_index % 3); resolved in that priority."""
    from terroir.operators.catalog import resolve_catalog
    from terroir.operators.clickstream import distinct_values
    from pyspark.sql import Window
    from terroir.plans.events import click as written_click
    click = written_click(spark, sf_dir)
    cat = (distinct_values(click, "channel", "codigo")
           .select(F.row_number().over(Window.orderBy("codigo")).cast("int").alias("id_canal"), "codigo",
                   F.upper("codigo").alias("nombre")))
    ref = (click.join(F.broadcast(cat.select(F.col("codigo").alias("channel"), "id_canal")), "channel")
           .select("session_id", "event_index",
                   F.when(F.col("event_index") % 3 == 0, F.col("channel"))
                   .when(F.col("event_index") % 3 == 1, F.upper("channel"))
                   .otherwise(F.col("id_canal").cast("string")).alias("canal_ref")))
    return resolve_catalog(ref, "canal_ref", cat, "id_canal", ["codigo", "nombre", "id_canal"], "canal_inexistente")
