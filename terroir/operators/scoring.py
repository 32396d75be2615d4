"""Closed-form scoring operators.

All formulas are Catalyst expressions over joined/aggregated frames; none
uses a Python UDF.  Frame-wide statistics (means over the selected top-N,
series mean/std) are computed on already aggregated frames.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terroir.functions import calendar_months, round_half_up, safe_div
from terroir.operators.windows import quintiles, zscore

# ------------------------------------------------------------------ M03
# Dynamic price coefficients.
DEMAND_WEIGHT = 0.06
QUALITY_WEIGHT = 0.015
ADJ_MIN, ADJ_MAX = -0.18, 0.22
ACTION_BAND = 0.03


def price_recommendations(base: DataFrame) -> DataFrame:
    """M03 on A12 rows: means over the selected rows (≤ top-N, tiny frame)."""
    w = Window.partitionBy()
    adj = F.greatest(F.lit(ADJ_MIN), F.least(F.lit(ADJ_MAX),
          (F.col("demanda") / F.avg("demanda").over(w) - 1) * DEMAND_WEIGHT
          + (F.col("puntos_prom") - F.avg("puntos_prom").over(w)) * QUALITY_WEIGHT))
    b = base.withColumn("ajuste", adj)
    return b.select(
        "variedad", "demanda",
        round_half_up("precio_prom", 2).alias("precio_actual"),
        round_half_up("puntos_prom", 1).alias("puntos"),
        round_half_up(F.col("precio_prom") * (1 + F.col("ajuste")), 2).alias("precio_recomendado"),
        round_half_up(F.col("ajuste") * 100, 1).alias("ajuste_pct"),
        F.when(F.col("ajuste") > ACTION_BAND, "Subir precio").when(F.col("ajuste") < -ACTION_BAND, "Bajar precio")
        .otherwise("Mantener").alias("accion"))


# ------------------------------------------------------------------ M06
def price_projection(trend: DataFrame, lo: int | None = None, hi: int | None = None, steps: int = 2) -> DataFrame:
    """OLS per variety over all its years, next ``steps`` years (>= 0);
    ``lo`` / ``hi`` restrict the years where the caller gives them.

    The fit uses exact integer sums (prices in cents), so slope and
    projection do not depend on summation order.
    """
    t = (trend.withColumn("_x", F.col("anio").try_cast("long")).filter(F.col("_x").isNotNull())
         .withColumn("_y", F.round(F.col("precio_promedio") * 100).cast("long")))
    t = t if lo is None else t.filter(F.col("_x") >= lo)
    t = t if hi is None else t.filter(F.col("_x") <= hi)
    fit = (t.groupBy("variedad")
           .agg(F.count(F.lit(1)).alias("n"), F.sum("_x").alias("sx"), F.sum("_y").alias("sy"),
                F.sum(F.col("_x") * F.col("_y")).alias("sxy"), F.sum(F.col("_x") * F.col("_x")).alias("sxx"),
                F.max("_x").alias("ultimo"))
           .filter(F.col("n") >= 2))
    ratio = ((F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy")).cast("double")
             / (F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx")).cast("double"))
    proj = fit.withColumn("_b", ratio).withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(steps))))
    year = F.col("ultimo") + F.col("k")
    yhat = ((F.col("sy").cast("double") + F.col("_b") * (F.col("n") * year - F.col("sx")).cast("double"))
            / F.col("n").cast("double") / F.lit(100.0))
    return proj.select(
        "variedad", year.cast("int").alias("anio"),
        round_half_up(F.greatest(F.lit(0.0), yhat), 2).alias("precio_proyectado"),
        round_half_up(F.col("_b") / F.lit(100.0), 4).alias("pendiente"))


# ------------------------------------------------------------------ M01
# Churn model plan risks and weights.
PLAN_RISK = {"Trial": 0.85, "Básico": 0.45, "Profesional": 0.22, "Enterprise": 0.10}
PLAN_RISK_OTHER = 0.3
WEIGHTS = {"adopcion": 0.22, "sesiones": 0.15, "nps": 0.13, "plan": 0.15, "antiguedad": 0.10, "riesgo_base": 0.25}
# Main-factor labels in tie-break order.
FACTORS = [("adopcion", "baja adopción"), ("sesiones", "poco uso"), ("nps", "NPS bajo"),
           ("plan", "plan inicial"), ("antiguedad", "cuenta nueva"), ("riesgo_base", "señal histórica")]
# Level actions.
ACTIONS = {"Alto": "Contacto proactivo de Customer Success + oferta de retención",
           "Medio": "Onboarding guiado y revisión de adopción",
           "Bajo": "Seguimiento estándar · oportunidad de upsell"}
HIGH, MEDIUM = 0.42, 0.28


def churn_features(ret: DataFrame, usage: DataFrame, clients: DataFrame, markets: DataFrame,
                   plans: DataFrame, latest: int) -> DataFrame:
    """Active clients at ``latest`` with their usage of that period."""
    r = ret.filter((F.col("id_tiempo") == latest) & (F.col("activo") == 1)).select(
        "id_cliente", "riesgo_churn", "ltv")
    u = usage.filter(F.col("id_tiempo") == latest).select(
        "id_cliente", "usuarios_activos", "usuarios_totales", "sesiones", "nps_score")
    c = clients.select("id_cliente", "nombre", "tipo", "fecha_alta", "id_mercado", "id_plan")
    return (r.join(c, "id_cliente").join(markets.select("id_mercado", "pais"), "id_mercado")
            .join(plans.select("id_plan", F.col("nombre").alias("plan")), "id_plan")
            .join(u, "id_cliente", "left"))


def _risk_columns(latest: int) -> dict[str, Column]:
    ratio = F.when(F.coalesce(F.col("usuarios_totales"), F.lit(0)) == 0, F.lit(0.6)).otherwise(
        F.coalesce(safe_div("usuarios_activos", "usuarios_totales"), F.lit(0.6)))
    ses = F.coalesce(F.col("sesiones").cast("double"), F.lit(40.0))
    nps = F.col("nps_score")
    plan_risk = F.coalesce(F.element_at(F.create_map(*[x for k, v in PLAN_RISK.items()
                                                       for x in (F.lit(k), F.lit(v))]), F.col("plan")),
                           F.lit(PLAN_RISK_OTHER))
    ref = F.make_date(F.lit(latest // 100), F.lit(latest % 100), F.lit(1))
    months = F.when(F.col("fecha_alta").isNull(), F.lit(0)).otherwise(calendar_months("fecha_alta", ref))
    return {
        "_adop": ratio,
        "r_adopcion": 1 - F.least(F.lit(1.0), F.greatest(F.lit(0.0), ratio)),
        "r_sesiones": 1 - F.least(F.lit(1.0), ses / 150.0),
        "r_nps": (F.when(nps.isNull() | (nps < 0), 0.5).when(nps <= 6, 1.0).when(nps <= 8, 0.45).otherwise(0.0)),
        "r_plan": plan_risk,
        "r_antiguedad": F.greatest(F.lit(0.0), 1 - months / 12.0),
        "r_riesgo_base": F.coalesce(F.col("riesgo_churn").cast("double"), F.lit(0.2)),
    }


def score_churn(features: DataFrame, latest: int) -> DataFrame:
    """Weighted risk score per active client, level and main factor."""
    df = features.withColumns(_risk_columns(latest))
    weighted = [(F.col(f"r_{k}") * WEIGHTS[k]) for k, _ in FACTORS]
    total = weighted[0]
    for w in weighted[1:]:
        total = total + w
    # argmax, first listed factor on ties: max of (value, -position)
    best = F.array_max(F.array(*[F.struct(w.alias("v"), F.lit(-i).alias("p"), F.lit(lbl).alias("f"))
                                 for i, (w, (_, lbl)) in enumerate(zip(weighted, FACTORS))]))
    df = df.withColumn("score", round_half_up(F.least(F.lit(1.0), total), 3)).withColumn("factor", best["f"])
    level = F.when(F.col("score") >= HIGH, "Alto").when(F.col("score") >= MEDIUM, "Medio").otherwise("Bajo")
    acts = F.create_map(*[x for k, v in ACTIONS.items() for x in (F.lit(k), F.lit(v))])
    return df.select(
        "id_cliente", "nombre", "tipo", "pais", "plan", "score",
        round_half_up(F.col("score") * 100, 1).alias("probabilidad"),
        level.alias("nivel"), round_half_up(F.col("_adop") * 100, 1).alias("adopcion"), "factor",
        round_half_up(F.coalesce(F.col("ltv").cast("double"), F.lit(0.0)), 2).alias("ltv"),
        F.element_at(acts, level).alias("accion"))


def churn_summary(scored: DataFrame) -> DataFrame:
    """M01 summary: distribution, mean score·100 (1), Σ ltv of 'Alto' (one row)."""
    return scored.agg(
        F.count(F.lit(1)).alias("total_clientes"),
        F.count(F.when(F.col("nivel") == "Alto", 1)).alias("alto"),
        F.count(F.when(F.col("nivel") == "Medio", 1)).alias("medio"),
        F.count(F.when(F.col("nivel") == "Bajo", 1)).alias("bajo"),
        round_half_up(F.avg("score") * 100, 1).alias("riesgo_promedio"),
        round_half_up(F.coalesce(F.sum(F.when(F.col("nivel") == "Alto", F.col("ltv"))), F.lit(0.0)), 2)
        .alias("ingresos_en_riesgo"))


def top_risk(scored: DataFrame, k: int = 25) -> DataFrame:
    """Top-k accounts by score (id tie-break)."""
    return scored.orderBy(F.col("score").desc(), F.col("id_cliente").asc()).limit(k)


# ------------------------------------------------------------------ M02
# RFM segment names in report order and their strategies.
SEGMENTS = ["Campeones", "Clientes leales", "Potencial de crecimiento", "En riesgo (alto valor)", "Promedio",
            "Hibernando"]
STRATEGIES = {
    "Campeones": "Programa de embajadores y upsell premium",
    "Clientes leales": "Retención y venta cruzada de módulos",
    "Potencial de crecimiento": "Onboarding y expansión de uso",
    "En riesgo (alto valor)": "Plan de recuperación de Customer Success",
    "Promedio": "Automatización de nurturing",
    "Hibernando": "Campaña de reactivación o cierre",
}


def rfm_base(ret: DataFrame, usage: DataFrame, clients: DataFrame, markets: DataFrame, plans: DataFrame,
             latest: int) -> DataFrame:
    """A15 + J06: active clients at latest, with max LTV, Σ sessions and
    adoption at latest (NULL → 0)."""
    base = (ret.filter((F.col("id_tiempo") == latest) & (F.col("activo") == 1)).select("id_cliente")
            .join(clients.select("id_cliente", "nombre", "tipo", "id_mercado", "id_plan"), "id_cliente")
            .join(markets.select("id_mercado", "pais"), "id_mercado")
            .join(plans.select("id_plan", F.col("nombre").alias("plan")), "id_plan"))
    ltv = ret.groupBy("id_cliente").agg(F.max("ltv").cast("double").alias("ltv"))
    freq = usage.groupBy("id_cliente").agg(F.sum("sesiones").cast("double").alias("freq"))
    rec = (usage.filter(F.col("id_tiempo") == latest).groupBy("id_cliente")
           .agg(F.avg(safe_div("usuarios_activos", "usuarios_totales")).alias("rec")))
    return (base.join(ltv, "id_cliente", "left").join(freq, "id_cliente", "left").join(rec, "id_cliente", "left")
            .fillna(0.0, ["ltv", "freq", "rec"]))


def segment_rfm(base: DataFrame) -> DataFrame:
    """Quintiles (W05) of recency/frequency/monetary and first-match rules."""
    df = quintiles(base, {"R": "rec", "F": "freq", "M": "ltv"}, "id_cliente")
    R, Fq, M = F.col("R"), F.col("F"), F.col("M")
    seg = (F.when((R >= 4) & (Fq >= 4) & (M >= 4), SEGMENTS[0])
           .when((M >= 4) & (Fq >= 3), SEGMENTS[1])
           .when((R >= 4) & (M <= 3), SEGMENTS[2])
           .when((R <= 2) & (M >= 3), SEGMENTS[3])
           .when((R <= 2) & (Fq <= 2), SEGMENTS[5])
           .otherwise(SEGMENTS[4]))
    return df.withColumn("segmento", seg)


def rfm_segments(segmented: DataFrame, min_clients: int = 5) -> DataFrame:
    """M02 summary per segment (empty when fewer than ``min_clients``)."""
    n = segmented.agg(F.count(F.lit(1))).scalar()
    strat = F.create_map(*[x for k, v in STRATEGIES.items() for x in (F.lit(k), F.lit(v))])
    order = F.create_map(*[x for i, k in enumerate(SEGMENTS) for x in (F.lit(k), F.lit(i))])
    g = segmented.groupBy("segmento").agg(
        F.count(F.lit(1)).alias("clientes"),
        round_half_up(F.avg("ltv"), 2).alias("ltv_promedio"),
        round_half_up(F.sum("ltv"), 2).alias("ltv_total"))
    return (g.filter(n >= min_clients)
            .withColumn("estrategia", F.element_at(strat, F.col("segmento")))
            .withColumn("orden", F.element_at(order, F.col("segmento"))))


def segment_examples(segmented: DataFrame, k: int = 4) -> DataFrame:
    """Top-k clients by LTV per segment."""
    w = Window.partitionBy("segmento").orderBy(F.col("ltv").desc(), F.col("id_cliente").asc())
    return segmented.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k).drop("_rn")


# ------------------------------------------------------------------ M05
def detect_anomalies(series: DataFrame, min_points: int = 4, threshold: float = 2.0) -> DataFrame:
    """Z-score per series (population std); series with < min_points
    values are skipped; |z| > threshold is an anomaly, 'pico' or 'caída'."""
    cnt = F.count(F.lit(1)).over(Window.partitionBy("serie"))
    s = series.withColumn("_n", cnt).filter(F.col("_n") >= min_points).drop("_n")
    z = zscore(s, "serie", "valor")
    return z.select(
        "serie", "id_tiempo", "periodo",
        round_half_up("valor", 2).alias("valor"), round_half_up("media", 2).alias("esperado"),
        round_half_up("z", 2).alias("z"), (F.abs(F.col("z")) > threshold).alias("anomalia"),
        F.when(F.abs(F.col("z")) > threshold, F.when(F.col("z") > 0, "pico").otherwise("caída")).alias("tipo"))
