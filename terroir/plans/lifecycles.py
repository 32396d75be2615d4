"""Registered queries over the lifecycles that follow the reference step by step: alert moves (T04),
onboarding with own step lists (T11), sources (T20) and account sign-ups (T21)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terroir.operators import lifecycle as L
from terroir.plans.registry import register
from terroir.sources import testdata as T


# ====================================================== T04 (alerts = users, moves = their events)
# Users below 100 000 whose number is no multiple of 6 have an alert; the others' moves meet none.
_MOVES = {"click": "RECONOCIDA", "purchase": "RESUELTA", "error": "SILENCIADA"}
T04_SQL = """WITH mv AS (SELECT user_id AS alerta, CASE event_type WHEN 'click' THEN 'RECONOCIDA' WHEN 'purchase' THEN 'RESUELTA'
    ELSE 'SILENCIADA' END AS estado_solicitado, ts AS fecha, event_id AS seq FROM events
  WHERE event_type IN ('click', 'purchase', 'error')),
al AS (SELECT DISTINCT user_id AS alerta FROM events WHERE user_id % 6 <> 0)
"""


def _alert_inputs(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    e = T.table(spark, sf_dir, "events")
    m = F.create_map(*[F.lit(x) for kv in _MOVES.items() for x in kv])
    moves = e.filter(F.col("event_type").isin(*_MOVES)).select(
        F.col("user_id").alias("alerta"), F.element_at(m, F.col("event_type")).alias("estado_solicitado"),
        F.col("ts").alias("fecha"), F.col("event_id").alias("seq"))
    alerts = e.filter(F.col("user_id") % 6 != 0).select(F.col("user_id").alias("alerta"), F.lit("ABIERTA").alias("estado"),
                                                       F.lit(None).cast("timestamp_ntz").alias("ultima_vez")).distinct()
    return alerts, moves


@register("t04_alert_moves", T04_SQL + """, o AS (SELECT *, row_number() OVER (PARTITION BY alerta ORDER BY fecha DESC, seq DESC) AS k,
    count(*) OVER (PARTITION BY alerta) AS n FROM mv)
SELECT al.alerta, CASE WHEN o.alerta IS NULL THEN 'ABIERTA' ELSE o.estado_solicitado END AS estado, o.fecha AS ultima_vez,
       coalesce(o.n, 0) AS movimientos FROM al LEFT JOIN o ON o.alerta = al.alerta AND o.k = 1""")
def t04_alert_moves(spark, sf_dir):
    return L.alert_moves(*_alert_inputs(spark, sf_dir))[0]


@register("t04_unknown_alerts", T04_SQL + "SELECT *, 'alerta_inexistente' AS motivo FROM mv WHERE alerta % 6 = 0")
def t04_unknown_alerts(spark, sf_dir):
    return L.alert_moves(*_alert_inputs(spark, sf_dir))[1]


# ====================================================== T11 (accounts = users, requests = their events)
# Sign-ups and even purchases are advances, the other events explicit moves; step lists have 4 to 16 steps.
def _onboarding_requests(spark, sf_dir) -> DataFrame:
    e = T.table(spark, sf_dir, "events")
    kind, even = F.col("event_type"), F.col("event_id") % 2 == 0
    advance = (kind == "signup") | ((kind == "purchase") & even)
    wanted = (F.when(kind == "error", "estancado").when(kind == "click", "EN_PROGRESO").when(kind == "view", "PAUSA").otherwise("COMPLETADO"))
    steps = F.transform(F.sequence(F.lit(1), (F.col("user_id") % 13 + 4).cast("int")), lambda i: F.concat(F.lit("paso-"), i.cast("string")))
    return e.select(F.col("user_id").alias("cuenta"), steps.alias("pasos"), F.when(advance, "avanzar").otherwise("estado").alias("accion"),
                    F.when(~advance, wanted).alias("estado_solicitado"), F.col("ts").alias("fecha"), F.col("event_id").alias("seq"))


# One step per request: status, steps done, present step.
T11_SQL = """WITH RECURSIVE rq AS (
  SELECT user_id AS cuenta, CAST(user_id % 13 + 4 AS INTEGER) AS total, event_type = 'signup' OR (event_type = 'purchase' AND event_id % 2 = 0) AS avanza,
         CASE event_type WHEN 'error' THEN 'ESTANCADO' WHEN 'click' THEN 'EN_PROGRESO' WHEN 'view' THEN 'PAUSA' ELSE 'COMPLETADO' END AS quiere,
         ts AS fecha, event_id AS seq, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events),
fold AS (
  SELECT DISTINCT cuenta, CAST(0 AS BIGINT) AS k, 'PENDIENTE' AS antes, 'PENDIENTE' AS st, CAST(0 AS INTEGER) AS done, 'paso-1' AS paso_actual,
         CAST(NULL AS VARCHAR) AS veredicto FROM rq
  UNION ALL
  SELECT f.cuenta, r.k, f.st,
    CASE WHEN f.st = 'COMPLETADO' THEN f.st WHEN r.avanza AND f.done + 1 >= r.total THEN 'COMPLETADO' WHEN r.avanza THEN 'EN_PROGRESO'
         WHEN f.st = 'PENDIENTE' AND r.quiere IN ('EN_PROGRESO', 'ESTANCADO') THEN r.quiere
         WHEN f.st = 'EN_PROGRESO' AND r.quiere IN ('COMPLETADO', 'ESTANCADO') THEN r.quiere
         WHEN f.st = 'ESTANCADO' AND r.quiere IN ('EN_PROGRESO', 'COMPLETADO') THEN r.quiere ELSE f.st END,
    CASE WHEN f.st = 'COMPLETADO' THEN f.done WHEN r.avanza THEN least(f.done + 1, r.total)
         WHEN r.quiere = 'COMPLETADO' AND f.st IN ('EN_PROGRESO', 'ESTANCADO') THEN r.total ELSE f.done END,
    CASE WHEN f.st <> 'COMPLETADO' AND r.avanza THEN 'paso-' || CAST(least(f.done + 2, r.total) AS VARCHAR) ELSE f.paso_actual END,
    CASE WHEN r.avanza THEN (CASE WHEN f.st = 'COMPLETADO' THEN 'sin_cambio' ELSE 'aplicada' END)
         WHEN (f.st = 'PENDIENTE' AND r.quiere IN ('EN_PROGRESO', 'ESTANCADO')) OR (f.st = 'EN_PROGRESO' AND r.quiere IN ('COMPLETADO', 'ESTANCADO'))
           OR (f.st = 'ESTANCADO' AND r.quiere IN ('EN_PROGRESO', 'COMPLETADO')) THEN 'aplicada' ELSE 'transicion_invalida' END
  FROM fold f JOIN rq r ON r.cuenta = f.cuenta AND r.k = f.k + 1)
SELECT f.cuenta, r.seq, f.antes AS estado_anterior, f.st AS estado, f.veredicto, f.done AS pasos_completados, f.paso_actual, f.k AS paso
FROM fold f JOIN rq r ON r.cuenta = f.cuenta AND r.k = f.k"""


@register("t11_onboarding_replay", T11_SQL)
def t11_onboarding_replay(spark, sf_dir):
    return L.onboarding_replay(_onboarding_requests(spark, sf_dir)).select(
        "cuenta", "seq", "estado_anterior", "estado", "veredicto", "pasos_completados", "paso_actual", "paso")


# ====================================================== T20 (sources = users mod 400)
@register("t20_source_states", """WITH rq AS (SELECT 'F' || CAST(user_id % 400 AS VARCHAR) AS fuente, event_type AS t, event_id % 3 <> 0 AS meta,
    event_id % 4 <> 0 AS conexion, ['COMPLETADA', 'PARCIAL', 'FALLIDA'][CAST(event_id % 3 + 1 AS INTEGER)] AS ing, ts, event_id FROM events),
mv AS (SELECT *, CASE WHEN t = 'error' THEN 'DESHABILITADA' WHEN conexion THEN 'HABILITADA' ELSE 'RECHAZADA' END AS a,
    row_number() OVER (PARTITION BY fuente ORDER BY ts DESC, event_id DESC) AS k FROM rq
  WHERE t = 'error' OR (t IN ('signup', 'click') AND meta)),
rs AS (SELECT *, row_number() OVER (PARTITION BY fuente ORDER BY ts DESC, event_id DESC) AS j FROM mv WHERE a <> 'DESHABILITADA'),
ru AS (SELECT *, row_number() OVER (PARTITION BY fuente ORDER BY ts DESC, event_id DESC) AS k FROM rq WHERE t IN ('view', 'purchase'))
SELECT f.fuente, coalesce(mv.a, 'REGISTRADA') AS estado, CASE WHEN rs.a = 'RECHAZADA' THEN 'conexion_fallida' ELSE '' END AS motivo_rechazo,
  ru.ing AS ultimo_estado_ingesta, (SELECT max(ts) FROM ru u WHERE u.fuente = f.fuente AND ing IN ('COMPLETADA', 'PARCIAL')) AS ultima_ingesta,
  (SELECT count(*) FROM rq q WHERE q.fuente = f.fuente AND t IN ('signup', 'click') AND NOT meta) AS rechazos_metadatos
FROM (SELECT DISTINCT fuente FROM rq) f LEFT JOIN mv ON mv.fuente = f.fuente AND mv.k = 1
LEFT JOIN rs ON rs.fuente = f.fuente AND rs.j = 1 LEFT JOIN ru ON ru.fuente = f.fuente AND ru.k = 1""")
def t20_source_states(spark, sf_dir):
    e, i = T.table(spark, sf_dir, "events"), F.col("event_id")
    action = F.when(F.col("event_type").isin("signup", "click"), "habilitar").when(F.col("event_type") == "error", "deshabilitar").otherwise("ingesta")
    runs = F.array(F.lit("COMPLETADA"), F.lit("PARCIAL"), F.lit("FALLIDA"))
    return L.source_state(e.select(
        F.concat(F.lit("F"), (F.col("user_id") % 400).cast("string")).alias("fuente"), action.alias("accion"), (i % 3 != 0).alias("metadatos_ok"),
        (i % 4 != 0).alias("conexion_ok"), F.element_at(runs, (i % 3 + 1).cast("int")).alias("estado_ingesta"), F.col("ts").alias("fecha"), i.alias("seq")))


# ====================================================== T21 (sign-ups = customers, accounts = suppliers)
# Fiscal ids and e-mails collide in different patterns, some are blank; suppliers hold accounts already.
_TAX = "CASE WHEN c_custkey % 11 <> 0 THEN 'F' || CAST(c_custkey * 7 % 991 AS STRING) ELSE ' ' END"
_MAIL = "CASE WHEN c_custkey % 5 <> 0 THEN 'Mail' || CAST(c_custkey * 13 % 769 AS STRING) || '@X.cl ' END"


@register("t21_account_signups", f"""WITH RECURSIVE inc AS (SELECT c_custkey AS seq, trim({_TAX}) AS tax, lower(trim(coalesce({_MAIL}, ''))) AS mail,
    row_number() OVER (ORDER BY c_custkey) AS k FROM customer),
ext AS (SELECT s_suppkey AS id, 'F' || CAST(s_suppkey * 17 AS VARCHAR) AS tax, 'mail' || CAST(s_suppkey * 11 AS VARCHAR) || '@x.cl' AS mail FROM supplier),
base AS (SELECT i.*, (SELECT min(id) FROM ext WHERE ext.tax = i.tax) AS et, (SELECT min(id) FROM ext WHERE ext.mail = i.mail) AS em FROM inc i),
fold AS (
  SELECT CAST(0 AS BIGINT) AS k, CAST([] AS VARCHAR[]) AS taxes, CAST([] AS VARCHAR[]) AS mails, CAST([] AS BIGINT[]) AS seqs,
         CAST(NULL AS VARCHAR) AS campo, CAST(NULL AS BIGINT) AS ide, CAST(NULL AS BIGINT) AS orden, CAST(NULL AS VARCHAR) AS res
  UNION ALL
  SELECT k, CASE WHEN res = 'nueva' THEN list_append(taxes, tax) ELSE taxes END, CASE WHEN res = 'nueva' THEN list_append(mails, mail) ELSE mails END,
         CASE WHEN res = 'nueva' THEN list_append(seqs, seq) ELSE seqs END, campo, CASE campo WHEN 'id_fiscal' THEN et WHEN 'email' THEN em END,
         CASE WHEN campo = 'id_fiscal' AND et IS NULL THEN seqs[pt] WHEN campo = 'email' AND em IS NULL THEN seqs[pm] END, res
  FROM (SELECT *, CASE WHEN tax = '' AND mail = '' THEN 'identificacion_requerida' WHEN campo IS NULL THEN 'nueva' ELSE 'duplicada' END AS res
        FROM (SELECT *, CASE WHEN et IS NOT NULL OR pt > 0 THEN 'id_fiscal' WHEN em IS NOT NULL OR pm > 0 THEN 'email' END AS campo
              FROM (SELECT b.*, f.taxes, f.mails, f.seqs, CASE WHEN b.tax <> '' THEN coalesce(list_position(f.taxes, b.tax), 0) ELSE 0 END AS pt,
                           CASE WHEN b.mail <> '' THEN coalesce(list_position(f.mails, b.mail), 0) ELSE 0 END AS pm
                    FROM fold f JOIN base b ON b.k = f.k + 1) x) y) z)
SELECT b.seq, f.ide AS id_existente, f.orden AS orden_existente, f.campo, f.res AS resultado FROM fold f JOIN base b ON b.k = f.k""")
def t21_account_signups(spark, sf_dir):
    inc = T.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("seq"), F.expr(_TAX).alias("id_fiscal"), F.expr(_MAIL).alias("email"))
    accounts = T.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"), F.expr("'F' || CAST(s_suppkey * 17 AS STRING)").alias("id_fiscal"),
        F.expr("'mail' || CAST(s_suppkey * 11 AS STRING) || '@x.cl'").alias("email"))
    return L.dedup_accounts(accounts, inc, ["seq"]).select("seq", "id_existente", F.col("orden_existente.seq").alias("orden_existente"), "campo", "resultado")
