"""Query plans: predictions → signals → routed, grouped alerts (M07, M09,
T01-T03, A16, T17) over the scoring outputs of the business and reviews
stars, with oracle twins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terroir.operators import alerts as AL
from terroir.operators import scorecard as B
from terroir.operators import scoring as M
from terroir.plans import business as PB
from terroir.plans import reviews as PR
from terroir.plans.registry import register

RUN_DATE = "2024-02-01"
DRAINED_AT = "2024-02-01 06:00:00"


def _period(spark, sf_dir) -> int:
    return B.latest_period(PB.biz(spark, sf_dir)["dim_tiempo"])


def _churn(spark, sf_dir):
    """Every scored account: each one beyond the threshold may raise a signal."""
    return PB._scored(spark, sf_dir)


def _price_recs(spark, sf_dir):
    s = PR.star(spark, sf_dir)
    from terroir.operators import aggregates as A
    return M.price_recommendations(A.pricing_base(s["fact_resenas"], s["dim_variedad"], 200, 12))


def signals(spark, sf_dir) -> DataFrame:
    """The signal bus of one run: churn (M07), price (M07) and anomaly
    signals, emitted (T01) into a written table once per input snapshot;
    the alert queries drain it."""
    from terroir.plans.materialize import fingerprint, materialized

    def emit():
        p = _period(spark, sf_dir)
        parts = [AL.churn_signals(_churn(spark, sf_dir), p, RUN_DATE),
                 AL.price_signals(_price_recs(spark, sf_dir), p, RUN_DATE),
                 AL.anomaly_signals(M.detect_anomalies(B.anomaly_series(PB.biz(spark, sf_dir))), RUN_DATE)]
        return AL.emit_signals(None, reduce(DataFrame.unionByName, parts))
    key = fingerprint(spark, sf_dir, sorted(set(PB.BIZ_INPUTS) | set(PR.STAR_INPUTS)))
    return materialized(spark, "signal_bus", key, emit)


# ---------------------------------------------------------------- SQL twins
CHURN_SIG_SQL = f"""SELECT 'ml' AS origen, 'churn' AS tipo, 'critical' AS severidad,
    CAST(id_cliente AS VARCHAR) AS entidad, 'churn:' || CAST(id_cliente AS VARCHAR) || ':' || CAST({PB.LATEST} AS VARCHAR) AS clave,
    score AS valor, {AL.CHURN_THRESHOLD} AS umbral, CAST({PB.LATEST} AS INTEGER) AS id_tiempo
  FROM m01 WHERE score >= {AL.CHURN_THRESHOLD} OR nivel = 'Alto'"""
PRICE_SIG_SQL = f"""SELECT 'ml' AS origen, 'precio' AS tipo, 'warning' AS severidad, variedad AS entidad,
    'precio:' || variedad || ':' || CAST({PB.LATEST} AS VARCHAR) AS clave, precio_recomendado AS valor,
    precio_actual AS umbral, CAST({PB.LATEST} AS INTEGER) AS id_tiempo FROM m03 WHERE abs(ajuste_pct) >= 15.0"""
ANOM_SIG_SQL = """SELECT 'alertas' AS origen, CASE serie WHEN 'Tasa de churn' THEN 'churn' WHEN 'Errores de API'
    THEN 'api' WHEN 'Latencia global' THEN 'latencia' ELSE 'ingresos' END AS tipo, CAST(NULL AS VARCHAR) AS severidad,
    serie AS entidad, 'anomalia:' || serie || ':' || periodo AS clave, valor, esperado AS umbral,
    CAST(id_tiempo AS INTEGER) AS id_tiempo FROM m05 WHERE anomalia"""


def _m03_sql() -> str:
    from terroir.functions import sql_round_half_up as R
    return f"""m03 AS (SELECT variedad, demanda, {R('precio_prom', 2)} AS precio_actual,
    {R('puntos_prom', 1)} AS puntos, {R('precio_prom * (1 + ajuste)', 2)} AS precio_recomendado,
    {R('ajuste * 100', 1)} AS ajuste_pct FROM (SELECT *, greatest(-0.18, least(0.22,
      (demanda / avg(demanda) OVER () - 1) * 0.06 + (puntos_prom - avg(puntos_prom) OVER ()) * 0.015)) AS ajuste
      FROM ({PR.A12_SQL}) b) x)"""


def _m05_sql() -> str:
    from terroir.functions import sql_round_half_up as R
    return f"""m05 AS (SELECT serie, id_tiempo, periodo, {R('valor', 2)} AS valor, {R('mu', 2)} AS esperado,
    abs(z) > 2.0 AS anomalia FROM (SELECT *, CASE WHEN sd > 1e-9 THEN (valor - mu) / sd ELSE 0.0 END AS z FROM
      (SELECT *, avg(valor) OVER (PARTITION BY serie) AS mu, stddev_pop(valor) OVER (PARTITION BY serie) AS sd,
              count(*) OVER (PARTITION BY serie) AS n FROM ({PB.A14_SQL}) s) a WHERE n >= 4) b)"""


def _all_sql() -> str:
    return (PR.STAR_WITH + ",\n" + PB.BIZ_CTES + PB.M01_SQL + ",\n" + _m03_sql() + ",\n" + _m05_sql()
            + f",\nsig AS ({CHURN_SIG_SQL} UNION ALL {PRICE_SIG_SQL} UNION ALL {ANOM_SIG_SQL})\n")


_SIG_COLS = ["origen", "tipo", "severidad", "entidad", "clave", "valor", "umbral", "id_tiempo"]


def _sev_sql(col="tipo") -> str:
    cases = " ".join(f"WHEN '{k}' THEN '{v[0]}'" for k, v in AL.CLASSIFICATION.items())
    return f"CASE {col} {cases} ELSE '{AL.DEFAULT_SEVERITY}' END"


def _owner_sql(col="tipo") -> str:
    cases = " ".join(f"WHEN '{k}' THEN '{v[1]}'" for k, v in AL.CLASSIFICATION.items())
    return f"CASE {col} {cases} ELSE '{AL.DEFAULT_OWNER}' END"


@register("m07_churn_predictions", "WITH " + PB.BIZ_CTES + PB.M01_SQL + f"""SELECT
    'churn-{AL.CHURN_MODEL}-' || CAST({PB.LATEST} AS VARCHAR) AS corrida, CAST(id_cliente AS VARCHAR) AS id_entidad, nombre, score,
    nivel, score >= {AL.CHURN_THRESHOLD} OR nivel = 'Alto' AS supera_umbral FROM m01""")
def m07_churn_predictions(spark, sf_dir):
    p = AL.churn_predictions(_churn(spark, sf_dir), _period(spark, sf_dir), RUN_DATE)
    return p.select("corrida", "id_entidad", "nombre", "score", "nivel", "supera_umbral")


@register("m07_price_predictions", PR.STAR_WITH + ",\n" + PB.BIZ_CTES + ",\n" + _m03_sql() + f"""
    SELECT variedad AS id_entidad, ajuste_pct AS score, abs(ajuste_pct) >= 15.0 AS supera_umbral FROM m03""")
def m07_price_predictions(spark, sf_dir):
    p = AL.price_predictions(_price_recs(spark, sf_dir), _period(spark, sf_dir), RUN_DATE)
    return p.select("id_entidad", "score", "supera_umbral")


@register("t03_routed_signals", _all_sql() + f"""SELECT origen, tipo,
    coalesce(nullif(trim(coalesce(severidad, '')), ''), {_sev_sql()}) AS severidad, {_owner_sql()} AS responsable,
    entidad, clave, valor, umbral, id_tiempo FROM sig""")
def t03_routed_signals(spark, sf_dir):
    return AL.classify(signals(spark, sf_dir)).select(
        "origen", "tipo", "severidad", "responsable", "entidad", "clave", "valor", "umbral", "id_tiempo")


def _alerts(spark, sf_dir):
    alerts, _ = AL.group_alerts(signals(spark, sf_dir), None, DRAINED_AT)
    return alerts


@register("t02_alerts", _all_sql() + f"""SELECT tipo, coalesce(nullif(trim(coalesce(severidad, '')), ''),
    {_sev_sql()}) AS severidad, {_owner_sql()} AS responsable, entidad, clave, 'ABIERTA' AS estado,
    CAST(count(*) OVER (PARTITION BY clave) AS BIGINT) AS ocurrencias, valor, umbral, id_tiempo FROM sig""")
def t02_alerts(spark, sf_dir):
    return _alerts(spark, sf_dir).select("tipo", "severidad", "responsable", "entidad", "clave", "estado",
                                         "ocurrencias", "valor", "umbral", "id_tiempo")


@register("a16_alert_totals", _all_sql() + f""", al AS (SELECT 'ABIERTA' AS estado,
    coalesce(nullif(trim(coalesce(severidad, '')), ''), {_sev_sql()}) AS severidad, tipo FROM sig)
    SELECT estado, severidad, tipo, count(*) AS total, count(*) AS abiertas FROM al
    GROUP BY GROUPING SETS ((estado), (severidad), (tipo), ())""")
def a16_alert_totals(spark, sf_dir):
    totals, _ = AL.alert_summary(_alerts(spark, sf_dir), 20)
    return totals


@register("a16_recent_alerts", _all_sql() + """SELECT clave FROM sig ORDER BY clave LIMIT 20""")
def a16_recent_alerts(spark, sf_dir):
    _, recent = AL.alert_summary(_alerts(spark, sf_dir), 20)
    return recent.select("clave")


@register("t17_retention_actions", _all_sql() + """SELECT DISTINCT entidad AS cuenta, clave AS alerta,
    'alta' AS prioridad, 'PENDIENTE' AS estado FROM sig WHERE tipo = 'churn'""")
def t17_retention_actions(spark, sf_dir):
    return AL.retention_actions(_alerts(spark, sf_dir))
