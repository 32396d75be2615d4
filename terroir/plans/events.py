"""Query plans over ``events``: legacy clickstream star and normalised model,
contract CSV round trip, audit search, rate limiting, lifecycle replay and
probe monitoring — with DuckDB oracle twins where SQL can express them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terroir.functions import sql_round_half_up as R
from terroir.operators import alerts as AL
from terroir.operators import clickstream as C
from terroir.operators import lifecycle as L
from terroir.operators import search as S
from terroir.plans.materialize import exists, fingerprint
from terroir.plans.registry import register
from terroir.session import ensure_checkpoint_dir
from terroir.sources import readers as RD
from terroir.sources import testdata as T

CLICK = f"WITH click AS ({T.CLICKSTREAM_SQL})\n"


def click(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The typed clickstream, written once per ``events`` snapshot (its
    session positions need a two-pass numbering; every clickstream query
    reads the written table)."""
    from terroir.plans.materialize import materialized
    key = fingerprint(spark, sf_dir, ["events"])
    return materialized(spark, "clickstream", key, lambda: T.clickstream(spark, sf_dir))


def staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.to_staging_text(click(spark, sf_dir))


def stacked_dims(dims: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [dims[n].select(F.lit(n).alias("dim"), F.col(i).alias("id"), "nombre")
                                          for n, i, _ in C.SIMPLE_DIMS])


def click_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The six name dimensions as (dim, id, nombre), written once per ``events`` snapshot."""
    from terroir.plans.materialize import materialized
    return materialized(spark, "click_dims", fingerprint(spark, sf_dir, ["events"]),
                        lambda: stacked_dims(C.clickstream_dims(staging(spark, sf_dir))))


# ====================================================== D10 / U04 / P07
_DIM_SRC = {"category": "category", "brand": "brand", "channel": "channel", "device": "device_type",
            "region": "region", "traffic_source": "traffic_source"}


def _dim_sql(dim: str, col: str) -> str:
    src = _DIM_SRC[col]
    return (f"SELECT '{dim}' AS dim, CAST(row_number() OVER (ORDER BY nombre) AS INTEGER) AS id, nombre FROM "
            f"(SELECT DISTINCT trim({src}) AS nombre FROM click WHERE {src} IS NOT NULL AND trim({src}) <> '') d")


DIMS_SQL = " UNION ALL ".join(_dim_sql(d, c) for d, _, c in C.SIMPLE_DIMS)


@register("d10_clickstream_dims", CLICK + DIMS_SQL)
def d10_clickstream_dims(spark, sf_dir):
    return click_dims(spark, sf_dir)


@register("u04_distinct_categories", CLICK + "SELECT DISTINCT trim(category) AS nombre FROM click "
          "WHERE category IS NOT NULL AND trim(category) <> ''")
def u04_distinct_categories(spark, sf_dir):
    return C.distinct_values(staging(spark, sf_dir), "category")


# ====================================================== D11 / D12 / J03 / J11
TIME_SQL = """, tdim AS (SELECT CAST(row_number() OVER (ORDER BY fecha, hora) AS INTEGER) AS id_tiempo, fecha,
       CAST(year(fecha) AS INTEGER) AS anio, CAST(month(fecha) AS INTEGER) AS mes,
       CAST(day(fecha) AS INTEGER) AS dia, hora, CAST(isodow(fecha) - 1 AS INTEGER) AS dia_semana
  FROM (SELECT DISTINCT CAST(timestamp_utc AS DATE) AS fecha, CAST(hour(timestamp_utc) AS INTEGER) AS hora
        FROM click) t)
"""


@register("d11_time_dim", CLICK + TIME_SQL + "SELECT * FROM tdim")
def d11_time_dim(spark, sf_dir):
    return C.time_dim(staging(spark, sf_dir))


_FACT_SQL = CLICK + TIME_SQL + ", dims AS (" + DIMS_SQL + ")\n" + f"""SELECT c.session_id, c.user_id, c.user_action,
  CAST(CAST(c.price AS DECIMAL(10,2)) AS DOUBLE) AS price, c.is_conversion, c.drop_off_flag,
  coalesce(c.session_length, 0) AS session_length, coalesce(c.interaction_count, 0) AS interaction_count,
  coalesce(c.time_spent_sec, 0) AS time_spent_sec,
  d1.id AS id_categoria, d2.id AS id_marca, d3.id AS id_canal, d4.id AS id_dispositivo, d5.id AS id_region,
  d6.id AS id_trafico, t.id_tiempo
FROM click c
JOIN dims d1 ON d1.dim = 'dim_categoria' AND d1.nombre = c.category
JOIN dims d2 ON d2.dim = 'dim_marca' AND d2.nombre = c.brand
JOIN dims d3 ON d3.dim = 'dim_canal' AND d3.nombre = c.channel
JOIN dims d4 ON d4.dim = 'dim_dispositivo' AND d4.nombre = c.device_type
JOIN dims d5 ON d5.dim = 'dim_region' AND d5.nombre = c.region
JOIN dims d6 ON d6.dim = 'dim_trafico' AND d6.nombre = c.traffic_source
JOIN tdim t ON t.fecha = CAST(c.timestamp_utc AS DATE) AND t.hora = hour(c.timestamp_utc)"""


@register("d12_clickstream_fact", _FACT_SQL)
def d12_clickstream_fact(spark, sf_dir):
    st = staging(spark, sf_dir)
    stacked = click_dims(spark, sf_dir)
    dims = {n: stacked.filter(F.col("dim") == n).select(F.col("id").alias(i), "nombre") for n, i, _ in C.SIMPLE_DIMS}
    f = C.clickstream_fact(st, dims, C.time_dim(st))
    return f.withColumn("price", F.col("price").cast("double"))


# ====================================================== J10 / J11 with existing members
# The dimensions of the first half of January, then everything: only unseen
# members are appended, with ids after the existing ones.
_EARLY = "timestamp_utc < TIMESTAMP '2024-01-16 00:00:00'"


def _early(spark, sf_dir) -> DataFrame:
    return C.to_staging_text(click(spark, sf_dir).filter(F.expr(_EARLY)))


def _incremental_sql(dim: str, col: str) -> str:
    names = f"SELECT trim({col}) AS nombre, bool_or({_EARLY}) AS early FROM click WHERE trim({col}) <> '' GROUP BY 1"
    return (f"SELECT '{dim}' AS dim, CAST(row_number() OVER (ORDER BY NOT early, nombre) AS INTEGER) AS id, nombre "
            f"FROM ({names}) n")


@register("j10_incremental_dims", CLICK + " UNION ALL ".join(_incremental_sql(d, _DIM_SRC[c]) for d, _, c in C.SIMPLE_DIMS))
def j10_incremental_dims(spark, sf_dir):
    return stacked_dims(C.clickstream_dims(staging(spark, sf_dir), C.clickstream_dims(_early(spark, sf_dir))))


@register("j11_incremental_time", CLICK + f"""SELECT CAST(row_number() OVER (ORDER BY NOT early, fecha, hora) AS INTEGER)
    AS id_tiempo, fecha, hora FROM (SELECT CAST(timestamp_utc AS DATE) AS fecha, CAST(hour(timestamp_utc) AS INTEGER) AS hora,
    bool_or({_EARLY}) AS early FROM click GROUP BY 1, 2) t""")
def j11_incremental_time(spark, sf_dir):
    return C.time_dim(staging(spark, sf_dir), C.time_dim(_early(spark, sf_dir))).select("id_tiempo", "fecha", "hora")


# ====================================================== D13
def _first_sql(keys: str, cols: str) -> str:
    return (CLICK + f"SELECT {keys}, {cols} FROM (SELECT *, row_number() OVER (PARTITION BY {keys} "
            f"ORDER BY timestamp_utc, session_id, event_index) AS rn FROM click) x WHERE rn = 1")


@register("d13_usuarios", _first_sql("user_id", "region, device_type"))
def d13_usuarios(spark, sf_dir):
    return C.normalise_clickstream(click(spark, sf_dir))["usuarios"]


@register("d13_productos", _first_sql("product_id", "category, brand, price"))
def d13_productos(spark, sf_dir):
    return C.normalise_clickstream(click(spark, sf_dir))["productos"]


@register("d13_sesiones", _first_sql("session_id", "user_id, channel, traffic_source, session_length"))
def d13_sesiones(spark, sf_dir):
    return C.normalise_clickstream(click(spark, sf_dir))["sesiones"]


@register("d13_transacciones", CLICK + "SELECT session_id, event_index, timestamp_utc, product_id, price "
          "FROM click WHERE is_conversion")
def d13_transacciones(spark, sf_dir):
    return C.normalise_clickstream(click(spark, sf_dir))["transacciones"]


@register("d13_interacciones", CLICK + "SELECT session_id, event_index, timestamp_utc, user_action, product_id, "
          "time_spent_sec, interaction_count, is_conversion, drop_off_flag FROM click")
def d13_interacciones(spark, sf_dir):
    return C.normalise_clickstream(click(spark, sf_dir))["interacciones"]


@register("d13_counts", CLICK + """SELECT 'usuarios' AS tabla, count(DISTINCT user_id) AS filas FROM click
  UNION ALL SELECT 'productos', count(DISTINCT product_id) FROM click
  UNION ALL SELECT 'sesiones', count(DISTINCT session_id) FROM click
  UNION ALL SELECT 'interacciones', count(*) FROM click
  UNION ALL SELECT 'transacciones', count(*) FROM click WHERE is_conversion""")
def d13_counts(spark, sf_dir):
    return C.counts(C.normalise_clickstream(click(spark, sf_dir)))


# ====================================================== S01 / K11 round trip
@register("s01_contract_csv", CLICK + "SELECT * FROM click")
def s01_contract_csv(spark, sf_dir):
    """Write the clickstream as the 18-column contract CSV (K11 reload
    input) under the shared checkpoint folder, then read it back through
    the strict contract reader (S01)."""
    key = fingerprint(spark, sf_dir, ["events"])
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/terroir/contract_csv-{key}"
    if not exists(spark, f"{path}/_SUCCESS"):
        RD.write_contract_csv(click(spark, sf_dir), path)   # K11 input from the written clickstream
    return RD.read_contract_csv(spark, path)


# ====================================================== P09
@register("p09_audit_search", """SELECT * FROM events WHERE CAST(user_id AS VARCHAR) LIKE '%7%'
  AND event_type LIKE '%c%' AND CAST(ts AS DATE) = DATE '2024-01-15' """)
def p09_audit_search(spark, sf_dir):
    e = T.table(spark, sf_dir, "events")
    return S.search_log(e, user="7", action="c", day="2024-01-15", user_col="user_id",
                        action_col="event_type", ts_col="ts", id_col="event_id")


# ====================================================== T05 / A22 (re-aimed: sliding counts)
def _limit_sql(n: int, window_s: int) -> str:
    return f"""WITH lim AS (SELECT event_id, user_id, ts, en_ventana, en_ventana > {n} AS excede FROM (
  SELECT event_id, user_id, ts, count(*) OVER (PARTITION BY user_id ORDER BY epoch_us(ts)
         RANGE BETWEEN {window_s * 1_000_000 - 1} PRECEDING AND CURRENT ROW) AS en_ventana FROM events) x)
"""


def _windows(spark, sf_dir, n: int, window_s: float) -> DataFrame:
    e = T.table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    return L.request_windows(e, "user_id", "ts", n, window_s)


@register("t05_rate_limit", _limit_sql(60, 60) + "SELECT * FROM lim")
def t05_rate_limit(spark, sf_dir):
    """Reference parameters: 60 requests per key per 60 s."""
    return _windows(spark, sf_dir, 60, 60.0)


@register("t05_rate_limit_3_per_hour", _limit_sql(3, 3600) + "SELECT * FROM lim")
def t05_rate_limit_3_per_hour(spark, sf_dir):
    return _windows(spark, sf_dir, 3, 3600.0)


@register("a22_api_usage", _limit_sql(3, 3600) + """SELECT user_id, count(*) AS llamadas,
    count(*) FILTER (WHERE excede) AS excedidas, CASE WHEN user_id IS NULL THEN 'total' ELSE 'clave' END AS ambito
    FROM lim GROUP BY ROLLUP (user_id)""")
def a22_api_usage(spark, sf_dir):
    return L.api_usage(_windows(spark, sf_dir, 3, 3600.0), "user_id")


# ====================================================== T00 / T10 (sequential: rows-only)
# requested ticket state per event type (a lifecycle over the event log)
EVENT_TARGET = {"signup": "EN_PROCESO", "view": "EN_PROCESO", "click": "RESUELTO", "purchase": "CERRADO",
                "error": "REABIERTO"}


def _ticket_requests(spark, sf_dir):
    e = T.table(spark, sf_dir, "events")
    m = F.create_map(*[x for k, v in EVENT_TARGET.items() for x in (F.lit(k), F.lit(v))])
    return e.select(F.col("user_id").alias("ticket"), F.col("ts").alias("fecha"), F.col("event_id").alias("seq"),
                    F.element_at(m, F.col("event_type")).alias("estado_solicitado"))


def _replay_sql() -> str:
    """Oracle twin of the ticket replay: a recursive CTE, one step per event."""
    allowed = ", ".join(f"('{a}', '{b}')" for a, bs in L.TICKET.items() for b in bs)
    perm = ", ".join(f"('{a}', '{','.join(sorted(bs))}')" for a, bs in L.TICKET.items())
    tgt = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in EVENT_TARGET.items())
    return f"""WITH RECURSIVE
ev AS (SELECT user_id AS ticket, ts AS fecha, event_id AS seq, CASE event_type {tgt} END AS estado_solicitado,
              row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS paso FROM events),
ok(a, b) AS (VALUES {allowed}),
perm(a, p) AS (VALUES {perm}),
r AS (SELECT e.ticket, e.paso, 'ABIERTO' AS estado_anterior,
             CASE WHEN EXISTS (SELECT 1 FROM ok WHERE ok.a = 'ABIERTO' AND ok.b = e.estado_solicitado)
                  THEN e.estado_solicitado ELSE 'ABIERTO' END AS estado
      FROM ev e WHERE e.paso = 1
      UNION ALL
      SELECT e.ticket, e.paso, r.estado,
             CASE WHEN EXISTS (SELECT 1 FROM ok WHERE ok.a = r.estado AND ok.b = e.estado_solicitado)
                  THEN e.estado_solicitado ELSE r.estado END
      FROM r JOIN ev e ON e.ticket = r.ticket AND e.paso = r.paso + 1)
"""


T00_SQL = _replay_sql() + """SELECT e.ticket, e.fecha, e.seq, e.estado_solicitado, r.estado_anterior, r.estado,
  CASE WHEN EXISTS (SELECT 1 FROM ok WHERE ok.a = r.estado_anterior AND ok.b = e.estado_solicitado)
       THEN 'aplicada' ELSE 'transicion_invalida' END AS veredicto, perm.p AS permitidos, e.paso
FROM ev e JOIN r ON r.ticket = e.ticket AND r.paso = e.paso JOIN perm ON perm.a = r.estado_anterior"""


@register("t00_ticket_replay", T00_SQL)
def t00_ticket_replay(spark, sf_dir):
    return L.replay(_ticket_requests(spark, sf_dir), "ticket", ["fecha", "seq"], "estado_solicitado",
                    L.TICKET, "ABIERTO")


T10_SQL = (_replay_sql() + """, rep AS (SELECT e.ticket, e.fecha, r.estado, r.estado_anterior,
    EXISTS (SELECT 1 FROM ok WHERE ok.a = r.estado_anterior AND ok.b = e.estado_solicitado) AS aplicada
    FROM ev e JOIN r ON r.ticket = e.ticket AND r.paso = e.paso),
agg AS (SELECT ticket, min(fecha) AS abierto, max(paso) AS eventos FROM ev GROUP BY 1),
fin AS (SELECT ticket, estado AS estado_final FROM r WHERE (ticket, paso) IN (SELECT ticket, max(paso) FROM ev GROUP BY 1)),
rej AS (SELECT ticket, count(CASE WHEN NOT aplicada THEN 1 END) AS rechazados,
               min(CASE WHEN aplicada AND estado IN ('EN_PROCESO', 'RESUELTO') THEN fecha END) AS pr,
               coalesce(max(CASE WHEN aplicada AND estado = 'RESUELTO' THEN fecha END),
                        min(CASE WHEN aplicada AND estado = 'CERRADO' THEN fecha END)) AS res FROM rep GROUP BY 1)
SELECT a.ticket, f.estado_final, a.eventos, j.rechazados,
  """ + R("(epoch_us(j.pr) - epoch_us(a.abierto)) / 60000000.0", 2) + """ AS minutos_primera_respuesta,
  """ + R("(epoch_us(j.res) - epoch_us(a.abierto)) / 60000000.0", 2) + """ AS minutos_resolucion
FROM agg a JOIN fin f ON f.ticket = a.ticket JOIN rej j ON j.ticket = a.ticket""")


@register("t10_ticket_sla", T10_SQL)
def t10_ticket_sla(spark, sf_dir):
    return L.ticket_sla(_ticket_requests(spark, sf_dir), "ticket")


# ====================================================== A19 / T13 / T14 (probe log from events)
def probe_log(spark, sf_dir) -> DataFrame:
    """One probe run per event: service svc-<user_id % 5>, a failed try for
    'error' events, else one success with latency floor(value*10) ms."""
    e = T.table(spark, sf_dir, "events")
    ok = F.col("event_type") != "error"
    return e.select(F.to_date("ts").alias("fecha"),
                    F.concat(F.lit("svc-"), (F.col("user_id") % 5).cast("string")).alias("servicio"),
                    F.lit(1).alias("intentos"), F.when(ok, 1).otherwise(0).alias("exitosos"),
                    F.when(ok, F.array(F.floor(F.col("value") * 10).cast("double")))
                    .otherwise(F.array().cast("array<double>")).alias("latencias"))


PROBE_SQL = """WITH probe AS (SELECT CAST(ts AS DATE) AS fecha, 'svc-' || CAST(user_id % 5 AS VARCHAR) AS servicio,
    1 AS intentos, CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END AS exitosos,
    CASE WHEN event_type <> 'error' THEN CAST(floor(value * 10) AS DOUBLE) END AS lat FROM events),
svc AS (SELECT fecha, servicio, sum(intentos) AS t, sum(exitosos) AS ok FROM probe GROUP BY 1, 2)
"""
A19_SQL = PROBE_SQL + f""", a19 AS (SELECT s.fecha,
    {R('CASE WHEN sum(t) > 0 THEN sum(ok) * 100.0 / sum(t) ELSE 100.0 END', 3)} AS uptime,
    {R('coalesce(max(l.ls) / nullif(max(l.ln), 0), 0.0)', 2)} AS latencia_ms,
    CAST(count(CASE WHEN ok < t THEN 1 END) AS INTEGER) AS incidentes,
    coalesce(string_agg(CASE WHEN ok < t THEN servicio END, ',' ORDER BY servicio), '') AS servicios_caidos
  FROM svc s LEFT JOIN (SELECT fecha, sum(lat) AS ls, count(lat) AS ln FROM probe GROUP BY fecha) l
       ON s.fecha = l.fecha GROUP BY s.fecha)
"""


def _a19(spark, sf_dir):
    return AL.consolidate_probes(probe_log(spark, sf_dir), ["fecha"])


@register("a19_probe_consolidation", A19_SQL + "SELECT * FROM a19")
def a19_probe_consolidation(spark, sf_dir):
    return _a19(spark, sf_dir)


@register("t14_incidents", PROBE_SQL + f"""SELECT fecha, servicio,
    CASE WHEN ok = 0 THEN 'critical' ELSE 'warning' END AS severidad,
    CASE WHEN ok = 0 THEN 'ABIERTO' ELSE 'RECUPERADO' END AS estado,
    {R('30.0 * (t - ok) / t', 1)} AS duracion_min FROM svc WHERE ok < t""")
def t14_incidents(spark, sf_dir):
    return AL.incidents(probe_log(spark, sf_dir), ["fecha"])


@register("t13_slo_signals", A19_SQL + f"""SELECT 'monitor' AS origen, tipo, severidad, entidad,
    tipo || ':' || entidad AS clave, valor, umbral, id_tiempo FROM (
  SELECT 'uptime' AS tipo, 'critical' AS severidad, CAST(fecha AS VARCHAR) AS entidad, uptime AS valor,
         CAST({AL.UPTIME_SLO} AS DOUBLE) AS umbral, CAST(year(fecha) * 100 + month(fecha) AS INTEGER) AS id_tiempo
  FROM a19 WHERE uptime < {AL.UPTIME_SLO}
  UNION ALL
  SELECT 'latencia', 'warning', CAST(fecha AS VARCHAR), latencia_ms, CAST({AL.LATENCY_SLO_MS} AS DOUBLE),
         CAST(year(fecha) * 100 + month(fecha) AS INTEGER) FROM a19 WHERE latencia_ms > {AL.LATENCY_SLO_MS}) s""")
def t13_slo_signals(spark, sf_dir):
    from terroir.functions import period_id
    m = _a19(spark, sf_dir).withColumn("id_tiempo", period_id("fecha"))
    s = AL.slo_signals(m, "2024-02-01 00:00:00", ["fecha"])
    return s.select("origen", "tipo", "severidad", "entidad", "clave", "valor", "umbral", "id_tiempo")


# ====================================================== leads / conversions from events
# signup/click events are lead touches, view → OPORTUNIDAD, purchase → CLIENTE,
# error → PERDIDO; the campaign of a touch is C<event_id % 4>
_STAGE = {"view": "OPORTUNIDAD", "purchase": "CLIENTE", "error": "PERDIDO"}


def _leads(spark, sf_dir):
    from terroir.functions import period_id
    e = T.table(spark, sf_dir, "events").filter(F.col("event_type").isin("signup", "click"))
    return e.select(F.concat(F.lit("L"), F.col("user_id").cast("string")).alias("clave"),
                    F.concat(F.lit("C"), (F.col("event_id") % 4).cast("string")).alias("campana"),
                    F.concat(F.lit("canal-"), (F.col("user_id") % 3).cast("string")).alias("canal"),
                    F.concat(F.lit("mercado-"), (F.col("user_id") % 4).cast("string")).alias("mercado"),
                    F.col("ts").alias("fecha"), F.col("event_id").alias("seq"), period_id("ts").alias("id_tiempo"))


def _conversions(spark, sf_dir):
    from terroir.functions import period_id
    m = F.create_map(*[x for k, v in _STAGE.items() for x in (F.lit(k), F.lit(v))])
    e = T.table(spark, sf_dir, "events").filter(F.col("event_type").isin(*_STAGE))
    return e.select(F.concat(F.lit("L"), F.col("user_id").cast("string")).alias("lead"),
                    F.element_at(m, F.col("event_type")).alias("etapa"), F.col("ts").alias("fecha"),
                    F.col("event_id").alias("seq"), period_id("ts").alias("id_tiempo"))


_LEADS_SQL = """WITH leads AS (SELECT 'L' || CAST(user_id AS VARCHAR) AS clave, 'C' || CAST(event_id % 4 AS VARCHAR) AS campana,
    ts AS fecha, event_id AS seq, CAST(year(ts) * 100 + month(ts) AS INTEGER) AS id_tiempo
  FROM events WHERE event_type IN ('signup', 'click')),
ft AS (SELECT *, row_number() OVER (PARTITION BY clave ORDER BY fecha, seq) > 1 AS duplicado FROM leads),
conv AS (SELECT 'L' || CAST(user_id AS VARCHAR) AS lead, CASE event_type WHEN 'view' THEN 'OPORTUNIDAD'
    WHEN 'purchase' THEN 'CLIENTE' ELSE 'PERDIDO' END AS etapa, ts AS fecha, event_id AS seq,
    CAST(year(ts) * 100 + month(ts) AS INTEGER) AS id_tiempo FROM events WHERE event_type IN ('view', 'purchase', 'error'))
"""


@register("t06_first_touch", _LEADS_SQL + """SELECT clave, campana,
    'canal-' || CAST(CAST(substr(clave, 2) AS BIGINT) % 3 AS VARCHAR) AS canal,
    'mercado-' || CAST(CAST(substr(clave, 2) AS BIGINT) % 4 AS VARCHAR) AS mercado, fecha, seq, duplicado FROM ft""")
def t06_first_touch(spark, sf_dir):
    return L.first_touch(_leads(spark, sf_dir)).select("clave", "campana", "canal", "mercado", "fecha", "seq", "duplicado")


# The first conversion per (lead, stage) of a captured lead
_ACCEPTED_SQL = _LEADS_SQL + """, acc AS (
  SELECT c.lead, c.etapa, c.fecha, c.seq, c.id_tiempo, l.campana AS campana_atribuida, l.canal AS canal_lead,
         l.mercado AS mercado_lead
  FROM (SELECT *, row_number() OVER (PARTITION BY lead, etapa ORDER BY fecha, seq) AS k FROM conv) c
  JOIN (SELECT f.*, 'canal-' || CAST(CAST(substr(clave, 2) AS BIGINT) % 3 AS VARCHAR) AS canal,
               'mercado-' || CAST(CAST(substr(clave, 2) AS BIGINT) % 4 AS VARCHAR) AS mercado
        FROM ft f WHERE NOT duplicado) l ON l.clave = c.lead
  WHERE c.k = 1 AND c.etapa IN ('LEAD', 'OPORTUNIDAD', 'CLIENTE', 'PERDIDO'))
"""


def _accepted(spark, sf_dir):
    return L.attribute_conversions(_conversions(spark, sf_dir), L.first_touch(_leads(spark, sf_dir)))


@register("t07_attribution", _ACCEPTED_SQL + "SELECT * FROM acc")
def t07_attribution(spark, sf_dir):
    return _accepted(spark, sf_dir)[0].select("lead", "etapa", "fecha", "seq", "id_tiempo", "campana_atribuida",
                                              "canal_lead", "mercado_lead")


@register("t07_rejected", _LEADS_SQL + """SELECT lead, etapa, fecha, seq, id_tiempo, 'lead_inexistente' AS motivo
    FROM conv c WHERE NOT EXISTS (SELECT 1 FROM leads l WHERE l.clave = c.lead)""")
def t07_rejected(spark, sf_dir):
    return _accepted(spark, sf_dir)[1]


# The stage fold, step by step over each lead's (at most four) accepted conversions.
@register("t08_lead_stage", _ACCEPTED_SQL.replace("WITH ", "WITH RECURSIVE ", 1) + """,
step AS (SELECT lead, etapa, row_number() OVER (PARTITION BY lead ORDER BY fecha, seq) AS k,
                CASE etapa WHEN 'PERDIDO' THEN -1 WHEN 'LEAD' THEN 0 WHEN 'OPORTUNIDAD' THEN 1 ELSE 2 END AS o FROM acc),
fold(lead, k, etapa, o) AS (
  SELECT DISTINCT lead, CAST(0 AS BIGINT), 'LEAD', 0 FROM acc
  UNION ALL
  SELECT f.lead, s.k, CASE WHEN s.etapa = 'PERDIDO' OR s.o > f.o THEN s.etapa ELSE f.etapa END,
         CASE WHEN s.etapa = 'PERDIDO' OR s.o > f.o THEN s.o ELSE f.o END
  FROM fold f JOIN step s ON s.lead = f.lead AND s.k = f.k + 1)
SELECT lead, arg_max(etapa, k) AS etapa FROM fold GROUP BY lead""")
def t08_lead_stage(spark, sf_dir):
    return L.lead_stage(_accepted(spark, sf_dir)[0])


def _spend(spark, sf_dir):
    from terroir.functions import cents_to_decimal, period_id
    e = T.table(spark, sf_dir, "events").filter(F.col("event_type") == "click")
    return (e.groupBy(period_id("ts").alias("id_tiempo"))
            .agg(cents_to_decimal(F.sum(F.floor(F.col("value") * 100 + F.lit(0.5))), 14).alias("gasto")))


@register("a18_acquisition_indicators", _ACCEPTED_SQL + f""", sp AS (SELECT CAST(year(ts) * 100 + month(ts) AS INTEGER) AS id_tiempo,
    CAST(CAST(sum(floor(value * 100 + 0.5)) AS DOUBLE) / 100.0 AS DECIMAL(14,2)) AS gasto FROM events
    WHERE event_type = 'click' GROUP BY 1),
ld AS (SELECT id_tiempo, count(DISTINCT clave) AS leads FROM ft WHERE NOT duplicado GROUP BY 1),
cv AS (SELECT id_tiempo, count(*) AS conversiones FROM acc WHERE etapa = 'CLIENTE' GROUP BY 1),
j AS (SELECT coalesce(sp.id_tiempo, ld.id_tiempo, cv.id_tiempo) AS id_tiempo, coalesce(CAST(sp.gasto AS DOUBLE), 0.0) AS gasto,
             coalesce(ld.leads, 0) AS leads, coalesce(cv.conversiones, 0) AS conversiones
      FROM sp FULL OUTER JOIN ld ON sp.id_tiempo = ld.id_tiempo
      FULL OUTER JOIN cv ON coalesce(sp.id_tiempo, ld.id_tiempo) = cv.id_tiempo)
SELECT id_tiempo, gasto, leads, conversiones,
  {R('CASE WHEN leads > 0 THEN conversiones * 100.0 / leads ELSE 0.0 END', 2)} AS tasa_conversion,
  {R('CASE WHEN conversiones > 0 THEN gasto / conversiones ELSE 0.0 END', 2)} AS cac FROM j""")
def a18_acquisition_indicators(spark, sf_dir):
    return AL.acquisition_indicators(_spend(spark, sf_dir), L.first_touch(_leads(spark, sf_dir)),
                                     _accepted(spark, sf_dir)[0])


# ====================================================== T09 / A17 (sequential)
# Two subscriptions per user: signup → alta, view / click / error → pause /
# activate / cancel, purchase → plan change; every fourth plan code is unknown,
# every fifth sign-up has no payment token, odd users pay yearly.
_SUB_ACTION = {"signup": "alta", "purchase": "plan"}
_SUB_STATE = {"view": "EN_PAUSA", "click": "ACTIVA", "error": "CANCELADA"}
_SUB_PLANS = ["Básico", "Profesional", "Enterprise", "Oro"]
_TRANS = " OR ".join(f"(cur = '{a}' AND quiere IN ({', '.join(repr(b) for b in bs)}))" for a, bs in L.SUBSCRIPTION.items() if bs)
_EV_TYPE = " ".join(f"WHEN cur = '{a}' AND quiere = '{b}' THEN '{v}'" for (a, b), v in L.SUBSCRIPTION_EVENTS.items())
_PRICE = "CASE {p} " + " ".join(f"WHEN '{n}' THEN {round(p * 100)}" for _, n, p in T.PLANS) + " END"

# One step per request of a user; the state is a pair per subscription: estado, plan, billing.
T09_SQL = f"""WITH RECURSIVE req AS (
  SELECT 'U' || CAST(user_id AS VARCHAR) AS cliente, 'S' || CAST(user_id * 2 + event_id % 2 AS VARCHAR) AS suscripcion,
         CASE event_type WHEN 'signup' THEN 'alta' WHEN 'purchase' THEN 'plan' ELSE 'estado' END AS accion,
         [{', '.join(repr(p) for p in _SUB_PLANS)}][CAST(event_id // 2 % 4 + 1 AS INTEGER)] AS plan,
         CASE WHEN user_id % 2 = 1 THEN 'anual' ELSE 'mensual' END AS periodo,
         CASE event_type {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in _SUB_STATE.items())} END AS quiere,
         event_id % 5 <> 0 AS bok, ts AS fecha, event_id AS seq, CAST(event_id % 2 AS INTEGER) + 1 AS i,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events),
fold AS (
  SELECT DISTINCT cliente, CAST(0 AS BIGINT) AS k, [CAST(NULL AS VARCHAR), NULL] AS st, [CAST(NULL AS VARCHAR), NULL] AS pl,
         [FALSE, FALSE] AS fb, CAST(NULL AS VARCHAR) AS veredicto, CAST(NULL AS VARCHAR) AS cur, CAST(NULL AS VARCHAR) AS tipo,
         CAST(0 AS BIGINT) AS delta, CAST(0 AS BIGINT) AS mrr FROM req
  UNION ALL
  SELECT cliente, k, CASE WHEN i = 1 THEN [nst, st[2]] ELSE [st[1], nst] END, CASE WHEN i = 1 THEN [npl, pl[2]] ELSE [pl[1], npl] END,
         CASE WHEN i = 1 THEN [nfb, fb[2]] ELSE [fb[1], nfb] END, ver, cur, tp, dl, mrr + dl
  FROM (SELECT *, CASE WHEN ver <> 'aplicada' THEN cur WHEN accion = 'alta' THEN (CASE WHEN bok THEN 'ACTIVA' ELSE 'PRUEBA' END)
                       WHEN accion = 'plan' THEN cur ELSE quiere END AS nst,
               CASE WHEN ver = 'aplicada' AND accion IN ('alta', 'plan') THEN plan ELSE cpl END AS npl,
               CASE WHEN ver = 'aplicada' AND accion = 'alta' THEN bok ELSE cfb END AS nfb,
               CASE WHEN ver <> 'aplicada' THEN NULL WHEN accion = 'alta' THEN (CASE WHEN bok THEN 'alta' ELSE 'alta_prueba' END)
                    WHEN accion = 'plan' THEN (CASE WHEN {_PRICE.format(p='plan')} >= {_PRICE.format(p='cpl')} THEN 'upgrade' ELSE 'downgrade' END)
                    ELSE CASE {_EV_TYPE} ELSE 'cambio_estado' END END AS tp,
               CASE WHEN ver <> 'aplicada' THEN 0 WHEN accion = 'alta' THEN (CASE WHEN bok THEN {_PRICE.format(p='plan')} ELSE 0 END)
                    WHEN accion = 'plan' THEN {_PRICE.format(p='plan')} - {_PRICE.format(p='cpl')}
                    WHEN quiere = 'ACTIVA' THEN {_PRICE.format(p='cpl')} ELSE -{_PRICE.format(p='cpl')} END AS dl
        FROM (SELECT *, CASE
                WHEN accion = 'alta' AND cur IS NOT NULL THEN 'suscripcion_existente'
                WHEN accion = 'alta' AND plan = 'Oro' THEN 'plan_inexistente'
                WHEN accion = 'alta' AND ost = 'ACTIVA' AND opl = plan THEN 'suscripcion_activa_duplicada'
                WHEN accion = 'alta' THEN 'aplicada' WHEN cur IS NULL THEN 'suscripcion_inexistente'
                WHEN accion = 'plan' AND cur = 'CANCELADA' THEN 'suscripcion_cancelada'
                WHEN accion = 'plan' AND plan = 'Oro' THEN 'plan_inexistente'
                WHEN accion = 'plan' AND plan <> cpl AND ost = 'ACTIVA' AND opl = plan THEN 'suscripcion_activa_duplicada'
                WHEN accion = 'plan' THEN 'aplicada' WHEN NOT coalesce({_TRANS}, FALSE) THEN 'transicion_invalida'
                WHEN quiere = 'ACTIVA' AND NOT cfb THEN 'facturacion_incompleta' ELSE 'aplicada' END AS ver
              FROM (SELECT f.st, f.pl, f.fb, f.mrr, r.*, f.st[r.i] AS cur, f.pl[r.i] AS cpl, f.fb[r.i] AS cfb,
                           f.st[3 - r.i] AS ost, f.pl[3 - r.i] AS opl
                    FROM fold f JOIN req r ON r.cliente = f.cliente AND r.k = f.k + 1) a) b) c)
SELECT r.cliente, r.suscripcion, r.accion, r.plan, r.periodo, r.quiere AS estado_solicitado, r.fecha, r.seq, r.bok AS facturacion_ok,
       f.pl[r.i] AS plan_vigente, f.cur AS estado_anterior, f.st[r.i] AS estado, f.veredicto, f.tipo AS tipo_evento,
       {_PRICE.format(p='f.pl[r.i]')} * (CASE WHEN r.periodo = 'anual' THEN 12 ELSE 1 END) / 100.0 AS monto,
       f.delta / 100.0 AS mrr_delta, f.mrr / 100.0 AS mrr_cliente
FROM req r JOIN fold f ON f.cliente = r.cliente AND f.k = r.k"""


@register("t09_subscription_ledger", T09_SQL)
def t09_subscription_ledger(spark, sf_dir):
    e = T.table(spark, sf_dir, "events")
    case = lambda m, other: reduce(lambda c, kv: c.when(F.col("event_type") == kv[0], kv[1]), m.items(), F).otherwise(other)
    req = e.select(F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("cliente"),
                   F.concat(F.lit("S"), (F.col("user_id") * 2 + F.col("event_id") % 2).cast("string")).alias("suscripcion"),
                   case(_SUB_ACTION, "estado").alias("accion"),
                   F.element_at(F.array(*[F.lit(p) for p in _SUB_PLANS]), (F.floor(F.col("event_id") / 2) % 4 + 1).cast("int")).alias("plan"),
                   F.when(F.col("user_id") % 2 == 1, "anual").otherwise("mensual").alias("periodo"),
                   F.lit("Titular").alias("titular"),
                   F.when(F.col("event_id") % 5 != 0, "tok_4242").alias("metodo_pago_token"),
                   case(_SUB_STATE, None).alias("estado_solicitado"), F.col("ts").alias("fecha"), F.col("event_id").alias("seq"))
    from terroir.operators.ledger import subscription_ledger
    out = subscription_ledger(req, T.dim_plan(spark).select("nombre", "precio_mensual"))
    return out.drop("titular", "metodo_pago_token", "metodo_pago")


# Every account's tickets (T10), its onboarding (T11, one advance per
# sign-up of its users) and the retention priority of a live churn alert
# (accounts whose users raised errors on the last day).
A17_SQL = T10_SQL.replace("WITH RECURSIVE", "WITH RECURSIVE", 1).replace(
    "SELECT a.ticket, f.estado_final", ", sla AS (SELECT a.ticket, f.estado_final", 1) + f"""),
tk AS (SELECT 'cuenta-' || CAST(s.ticket % 20 AS VARCHAR) AS cuenta, s.estado_final AS estado, s.minutos_resolucion AS mr,
              s.minutos_primera_respuesta AS mp,
              CASE WHEN CAST(floor(v.v) AS BIGINT) % 12 - 1 >= 0 THEN CAST(floor(v.v) AS BIGINT) % 12 - 1 END AS nps
       FROM sla s JOIN (SELECT user_id, arg_min(value, ts) AS v FROM events GROUP BY 1) v ON v.user_id = s.ticket),
onb AS (SELECT 'cuenta-' || CAST(user_id % 20 AS VARCHAR) AS cuenta, least(count(*), 5) AS n FROM events
        WHERE event_type = 'signup' GROUP BY 1),
ret AS (SELECT DISTINCT 'cuenta-' || CAST(user_id % 20 AS VARCHAR) AS cuenta FROM events
        WHERE event_type = 'error' AND CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events))
SELECT t.cuenta, count(*) AS tickets, count(*) FILTER (WHERE estado NOT IN ('RESUELTO', 'CERRADO')) AS abiertos,
  {R('avg(mr)', 2)} AS resolucion_media_min, {R('avg(mp)', 2)} AS primera_respuesta_media_min, count(nps) AS respuestas_nps,
  {R('avg(nps)', 2)} AS nps_medio,
  (SELECT string_agg(e || ':' || CAST(n AS VARCHAR), ',' ORDER BY e) FROM (SELECT u.estado AS e, count(*) AS n FROM tk u
    WHERE u.cuenta = t.cuenta GROUP BY 1) x) AS por_estado,
  max(CASE WHEN o.n >= 5 THEN 'COMPLETADO' WHEN o.n > 0 THEN 'EN_PROGRESO' END) AS onboarding_estado,
  max(o.n) AS onboarding_pasos, CASE WHEN max(r.cuenta) IS NOT NULL THEN 'alta' ELSE 'normal' END AS prioridad_retencion
FROM tk t LEFT JOIN onb o ON o.cuenta = t.cuenta LEFT JOIN ret r ON r.cuenta = t.cuenta GROUP BY t.cuenta"""


@register("a17_support_report", A17_SQL)
def a17_support_report(spark, sf_dir):
    """Tickets (one per user, T10) grouped into 20 accounts with an NPS answer
    derived from the ticket's first event value."""
    account = lambda c: F.concat(F.lit("cuenta-"), (F.col(c) % 20).cast("string")).alias("cuenta")
    sla = L.ticket_sla(_ticket_requests(spark, sf_dir), "ticket")
    events = T.table(spark, sf_dir, "events")
    e = events.groupBy("user_id").agg(F.min_by("value", "ts").alias("v"))
    t = sla.join(e, sla.ticket == e.user_id).select(
        account("ticket"), F.col("estado_final").alias("estado"), "minutos_resolucion", "minutos_primera_respuesta",
        (F.floor(F.col("v")) % 12 - 1).cast("string").alias("nps"))
    onboarding = L.onboarding_state(events.filter("event_type = 'signup'").select(account("user_id")))
    last = events.agg(F.max(F.to_date("ts"))).scalar()
    at_risk = events.filter((F.col("event_type") == "error") & (F.to_date("ts") == last)).select(account("user_id")).distinct()
    report = AL.support_report(t, onboarding=onboarding, at_risk=at_risk)
    states = F.array_sort(F.transform(F.map_entries("por_estado"), lambda s: F.concat(s["key"], F.lit(":"), s["value"].cast("string"))))
    return report.withColumn("por_estado", F.array_join(states, ","))


# ====================================================== T18 (publication requests from events)
# click/purchase → publicar, error → despublicar, signup → listo; 97 dashboards
# owned by 11 accounts; every 13th request comes from another account; one
# seal a day at 06:00 that fails every fifth day; account C3 has no plan.
_PUB_ACTION = {"click": "publicar", "purchase": "publicar", "error": "despublicar", "signup": "listo"}


def _publication_inputs(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    m = F.create_map(*[x for k, v in _PUB_ACTION.items() for x in (F.lit(k), F.lit(v))])
    e = T.table(spark, sf_dir, "events").filter(F.col("event_type").isin(*_PUB_ACTION))
    d = F.col("user_id") % 97
    owner = F.concat(F.lit("C"), (d % 11).cast("string"))
    req = e.select(F.concat(F.lit("D"), d.cast("string")).alias("dashboard"),
                   F.when(F.col("event_id") % 13 == 0, F.lit("C99")).otherwise(owner).alias("cuenta"),
                   owner.alias("propietario"), F.element_at(m, F.col("event_type")).alias("accion"),
                   F.col("ts").alias("fecha"), F.col("event_id").alias("seq"))
    days = T.table(spark, sf_dir, "events").select(F.to_date("ts").alias("d")).distinct()
    seals = days.select(F.lit("dw").alias("suite"), (F.dayofmonth("d") % 5 != 0).alias("exito"),
                        (F.col("d").cast("timestamp_ntz") + F.expr("INTERVAL 6 HOURS")).alias("fecha"),
                        F.lit(24.0).alias("vigencia_horas"))
    subs = req.filter(F.col("propietario") != "C3").select(
        F.col("propietario").alias("cuenta"), F.concat(F.lit("S"), F.col("propietario")).alias("suscripcion"),
        F.lit("ACTIVA").alias("estado"), F.lit("2024-01-01").alias("fecha")).distinct()
    return req, seals, subs


T18_SQL = """WITH RECURSIVE req AS (
  SELECT 'D' || CAST(user_id % 97 AS VARCHAR) AS dashboard,
         CASE WHEN event_id % 13 = 0 THEN 'C99' ELSE 'C' || CAST((user_id % 97) % 11 AS VARCHAR) END AS cuenta,
         'C' || CAST((user_id % 97) % 11 AS VARCHAR) AS propietario,
         CASE event_type WHEN 'error' THEN 'despublicar' WHEN 'signup' THEN 'listo' ELSE 'publicar' END AS accion,
         ts AS fecha, event_id AS seq
  FROM events WHERE event_type IN ('click', 'purchase', 'error', 'signup')),
seal AS (SELECT DISTINCT CAST(ts AS DATE) + INTERVAL 6 HOUR AS f, day(ts) % 5 <> 0 AS exito FROM events),
chk AS (SELECT r.*, coalesce(s.exito AND epoch_us(r.fecha) - epoch_us(s.f) <= 24 * 3600000000, FALSE) AS sello_ok,
               row_number() OVER (PARTITION BY dashboard ORDER BY fecha, seq) AS k
        FROM req r ASOF LEFT JOIN seal s ON r.fecha >= s.f),
g AS (SELECT *, CASE WHEN accion <> 'publicar' THEN NULL WHEN cuenta <> propietario THEN 'fuga_multitenant'
                     WHEN NOT sello_ok THEN 'sin_sello_calidad' WHEN cuenta = 'C3' THEN 'sin_plan_activo' END AS gate FROM chk),
fold(dashboard, k, before, st, version) AS (
  SELECT DISTINCT dashboard, CAST(0 AS BIGINT), 'LISTO', 'LISTO', CAST(1 AS BIGINT) FROM req
  UNION ALL
  SELECT f.dashboard, g.k, f.st,
         CASE WHEN g.accion = 'publicar' AND g.gate IS NULL AND f.st <> 'DESPUBLICADO' THEN 'PUBLICADO'
              WHEN g.accion = 'despublicar' AND f.st = 'PUBLICADO' THEN 'DESPUBLICADO'
              WHEN g.accion = 'listo' AND f.st = 'DESPUBLICADO' THEN 'LISTO' ELSE f.st END,
         f.version + CASE WHEN g.accion = 'publicar' AND g.gate IS NULL AND f.st = 'PUBLICADO' THEN 1 ELSE 0 END
  FROM fold f JOIN g ON g.dashboard = f.dashboard AND g.k = f.k + 1),
v AS (SELECT g.*, f.version AS vv,
  CASE WHEN accion = 'publicar' AND f.before = 'DESPUBLICADO' THEN 'estado_invalido' WHEN gate IS NOT NULL THEN gate
       WHEN accion = 'despublicar' AND f.before <> 'PUBLICADO' THEN 'publicacion_inexistente' ELSE 'aceptada' END AS veredicto
  FROM g JOIN fold f ON f.dashboard = g.dashboard AND f.k = g.k),
n AS (SELECT v.*, (SELECT arg_min(w.accion, w.k) FROM v w WHERE w.dashboard = v.dashboard AND w.k > v.k
                   AND w.veredicto = 'aceptada' AND w.accion <> 'listo') AS nxt FROM v)
SELECT dashboard, cuenta, propietario, accion, fecha, seq, sello_ok, veredicto,
       CASE WHEN accion = 'publicar' AND veredicto = 'aceptada' THEN vv END AS version,
       CASE WHEN accion = 'publicar' AND veredicto = 'aceptada' THEN
            CASE WHEN nxt IS NULL THEN 'ACTIVA' WHEN nxt = 'publicar' THEN 'REEMPLAZADA' ELSE 'DESPUBLICADO' END END AS estado_version
FROM n"""


@register("t18_publication_verdicts", T18_SQL)
def t18_publication_verdicts(spark, sf_dir):
    from terroir.operators.catalog import publication_verdicts
    return publication_verdicts(*_publication_inputs(spark, sf_dir))


# ====================================================== T12 (campaigns from supplier)
_CAMP_STATES = ["PROGRAMADA", "BORRADOR", "PROGRAMADA", "EN_EJECUCION", "PAUSADA", "FINALIZADA"]
_NOW = "2024-02-01 00:00:00"


def _campaigns(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    s = T.table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    camp = s.select(k.alias("campana"), F.element_at(F.array(*[F.lit(x) for x in _CAMP_STATES]), (k % 6 + 1).cast("int")).alias("estado"),
                    F.when(k % 7 != 0, F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast(s_suppkey % 60 as int))")).alias("programada"),
                    F.floor(F.abs("s_acctbal")).cast("double").alias("presupuesto"), (k % 3).cast("int").alias("ejecuciones"))
    done = s.filter(k % 4 == 0).select(F.concat(F.lit("camp:"), k.cast("string"), F.lit(":202402")).alias("clave"),
                                       (k % 5 + 1).cast("int").alias("corrida"))
    return camp, done


_CAMP_SQL = f"""WITH camp AS (SELECT s_suppkey AS campana, [{', '.join(repr(x) for x in _CAMP_STATES)}][CAST(s_suppkey % 6 + 1 AS INTEGER)] AS estado,
    CASE WHEN s_suppkey % 7 <> 0 THEN TIMESTAMP '2024-01-01' + INTERVAL (s_suppkey % 60) DAY END AS programada,
    CAST(floor(abs(s_acctbal)) AS DOUBLE) AS presupuesto, CAST(s_suppkey % 3 AS INTEGER) AS ejecuciones FROM supplier),
due AS (SELECT *, campana % 4 = 0 AS antes FROM camp WHERE estado = 'PROGRAMADA' AND (programada IS NULL OR programada <= TIMESTAMP '{_NOW}'))
"""


@register("t12_campaign_runs", _CAMP_SQL + f"""SELECT campana, 202402 AS id_tiempo, 'camp:' || CAST(campana AS VARCHAR) || ':202402' AS clave,
    CAST(CASE WHEN antes THEN campana % 5 + 2 ELSE 1 END AS INTEGER) AS corrida,
    CAST(floor(presupuesto * 100) AS BIGINT) AS impresiones, CAST(floor(floor(presupuesto * 100) * 0.02) AS BIGINT) AS clics,
    CAST(floor(floor(floor(presupuesto * 100) * 0.02) * 0.12) AS BIGINT) AS leads, presupuesto AS gasto FROM due""")
def t12_campaign_runs(spark, sf_dir):
    return L.run_due_campaigns(*_campaigns(spark, sf_dir), _NOW, 202402)[0].select(
        "campana", "id_tiempo", "clave", "corrida", "impresiones", "clics", "leads", "gasto")


@register("t12_campaign_states", _CAMP_SQL + """SELECT c.campana, CASE WHEN d.campana IS NULL THEN c.estado ELSE 'EN_EJECUCION' END AS estado,
    CAST(c.ejecuciones + CASE WHEN d.campana IS NOT NULL AND NOT d.antes THEN 1 ELSE 0 END AS INTEGER) AS ejecuciones
    FROM camp c LEFT JOIN due d ON d.campana = c.campana""")
def t12_campaign_states(spark, sf_dir):
    return L.run_due_campaigns(*_campaigns(spark, sf_dir), _NOW, 202402)[1].select("campana", "estado", "ejecuciones")
