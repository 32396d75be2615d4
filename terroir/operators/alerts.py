"""Predictions, signals and alerts.

Signals are rows keyed by (origen, clave, id_tiempo).  A drain turns the
pending signals into alerts with one group-by per alert key (count, first
and last signal by time) and a full outer join with the *live* alerts — the
closed form of the reference's one-signal-at-a-time loop, exact because no
lifecycle action happens inside a drain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terroir.functions import one_row, round_half_up

# Alert type → (default severity, owner).
CLASSIFICATION = {
    "churn": ("critical", "Customer Success"),
    "precio": ("warning", "Ingeniería de datos"),
    "uso": ("warning", "Customer Success"),
    "uptime": ("critical", "DevOps"),
    "latencia": ("warning", "DevOps"),
    "ingesta": ("critical", "Ingeniería de datos"),
    "api": ("warning", "DevOps"),
    "ingresos": ("warning", "Growth & Marketing"),
    "conversion": ("warning", "Growth & Marketing"),
}
DEFAULT_SEVERITY, DEFAULT_OWNER = "warning", "DevOps"
LIVE = ("ABIERTA", "RECONOCIDA")
# Model versions and thresholds.
CHURN_MODEL, PRICE_MODEL = "churn-ponderado-v1.0", "precio-dinamico-v1.0"
CHURN_THRESHOLD, PRICE_THRESHOLD_PCT = 0.42, 15.0
# Anomaly series → alert type.
SERIES_TYPE = {"Tasa de churn": "churn", "Errores de API": "api", "Latencia global": "latencia",
               "Ingresos recurrentes (MRR)": "ingresos"}
# SLOs.
UPTIME_SLO, LATENCY_SLO_MS = 99.9, 200.0

SIGNAL_COLUMNS = ["origen", "tipo", "severidad", "causa", "entidad", "clave", "valor", "umbral", "id_tiempo",
                  "payload", "fecha"]


def _map(d: dict) -> F.Column:
    return F.create_map(*[x for k, v in d.items() for x in (F.lit(k), F.lit(v))])


def _signals(df: DataFrame, origen: str, tipo: str, sev, clave, entidad, valor, umbral, id_tiempo, causa,
             payload_cols: list[str], fecha: str) -> DataFrame:
    return df.select(
        F.lit(origen).alias("origen"), F.lit(tipo).alias("tipo"),
        (sev if isinstance(sev, F.Column) else F.lit(sev)).alias("severidad"),
        causa.alias("causa"), entidad.cast("string").alias("entidad"), clave.alias("clave"),
        valor.cast("double").alias("valor"), umbral.cast("double").alias("umbral"),
        id_tiempo.cast("int").alias("id_tiempo"),
        F.to_json(F.struct(*[F.col(c) for c in payload_cols])).alias("payload"),
        F.lit(fecha).cast("timestamp").alias("fecha"))


# ---------------------------------------------------------------- M07
def churn_predictions(top: DataFrame, id_tiempo: int, fecha: str, entity_key: str = "id_cliente") -> DataFrame:
    """Prediction rows of the listed churn accounts (run id
    ``modelo-version-id_tiempo``, features as JSON)."""
    supera = (F.col("score") >= CHURN_THRESHOLD) | (F.col("nivel") == "Alto")
    return top.select(
        F.lit(f"churn-{CHURN_MODEL}-{id_tiempo}").alias("corrida"), F.lit("churn").alias("modelo"),
        F.lit(CHURN_MODEL).alias("version_modelo"), F.lit("cliente").alias("entidad"),
        F.col(entity_key).cast("string").alias("id_entidad"), "nombre", "score", "nivel",
        F.lit(CHURN_THRESHOLD).alias("umbral"), supera.alias("supera_umbral"),
        F.to_json(F.struct("plan", "pais", "adopcion", "factor", "ltv")).alias("features"),
        F.lit(id_tiempo).alias("id_tiempo"), F.lit(fecha).cast("date").alias("fecha"))


def churn_signals(top: DataFrame, id_tiempo: int, fecha: str, entity_key: str = "id_cliente") -> DataFrame:
    """One 'churn' signal per listed account over the threshold."""
    hot = top.filter((F.col("score") >= CHURN_THRESHOLD) | (F.col("nivel") == "Alto"))
    causa = F.concat(F.lit("Churn alto ("), F.col("probabilidad").cast("string"), F.lit("%) en "), F.col("nombre"),
                     F.lit(" · "), F.col("factor"), F.lit(" · plan "), F.col("plan"))
    return _signals(hot, "ml", "churn", "critical",
                    F.concat_ws(":", F.lit("churn"), F.col(entity_key).cast("string"), F.lit(str(id_tiempo))),
                    F.col(entity_key), F.col("score"), F.lit(CHURN_THRESHOLD), F.lit(id_tiempo), causa,
                    ["nivel", "ltv", "accion"], fecha)


def price_predictions(recs: DataFrame, id_tiempo: int, fecha: str) -> DataFrame:
    return recs.select(
        F.lit(f"precio-{PRICE_MODEL}-{id_tiempo}").alias("corrida"), F.lit("precio").alias("modelo"),
        F.lit(PRICE_MODEL).alias("version_modelo"), F.lit("variedad").alias("entidad"),
        F.col("variedad").alias("id_entidad"), F.col("variedad").alias("nombre"),
        F.col("ajuste_pct").alias("score"), F.col("accion").alias("nivel"),
        F.lit(PRICE_THRESHOLD_PCT).alias("umbral"), (F.abs("ajuste_pct") >= PRICE_THRESHOLD_PCT).alias("supera_umbral"),
        F.to_json(F.struct("demanda", "precio_actual", "precio_recomendado", "puntos")).alias("features"),
        F.lit(id_tiempo).alias("id_tiempo"), F.lit(fecha).cast("date").alias("fecha"))


def price_signals(recs: DataFrame, id_tiempo: int, fecha: str) -> DataFrame:
    hot = recs.filter(F.abs("ajuste_pct") >= PRICE_THRESHOLD_PCT)
    causa = F.concat(F.lit("Precio recomendado "), F.col("precio_recomendado").cast("string"), F.lit(" para "),
                     F.col("variedad"), F.lit(" se desvía "), F.col("ajuste_pct").cast("string"), F.lit("%"))
    return _signals(hot, "ml", "precio", "warning",
                    F.concat_ws(":", F.lit("precio"), F.col("variedad"), F.lit(str(id_tiempo))), F.col("variedad"),
                    F.col("precio_recomendado"), F.col("precio_actual"), F.lit(id_tiempo), causa,
                    ["ajuste_pct", "accion"], fecha)


# ---------------------------------------------------------------- M09
def anomaly_signals(anomalies: DataFrame, fecha: str) -> DataFrame:
    """One signal per detected anomaly, key anomalia:<serie>:<periodo>."""
    a = anomalies.filter(F.col("anomalia"))
    tipo = F.coalesce(F.element_at(_map(SERIES_TYPE), F.col("serie")), F.lit("ingresos"))
    causa = F.concat(F.col("tipo"), F.lit(" en «"), F.col("serie"), F.lit("»: "), F.col("valor").cast("string"),
                     F.lit(" (esperado ~"), F.col("esperado").cast("string"), F.lit(", z="),
                     F.col("z").cast("string"), F.lit(")"))
    out = a.select(
        F.lit("alertas").alias("origen"), tipo.alias("tipo"), F.lit(None).cast("string").alias("severidad"),
        causa.alias("causa"), F.col("serie").alias("entidad"),
        F.concat_ws(":", F.lit("anomalia"), F.col("serie"), F.col("periodo")).alias("clave"),
        F.col("valor").cast("double").alias("valor"), F.col("esperado").cast("double").alias("umbral"),
        F.col("id_tiempo").cast("int").alias("id_tiempo"),
        F.to_json(F.struct("z", F.col("tipo").alias("direccion"))).alias("payload"),
        F.lit(fecha).cast("timestamp").alias("fecha"))
    return out


# ---------------------------------------------------------------- T03
def classify(signals: DataFrame) -> DataFrame:
    """Explicit severity wins; owner always by type; defaults warning/DevOps."""
    sev = F.element_at(_map({k: v[0] for k, v in CLASSIFICATION.items()}), F.col("tipo"))
    owner = F.element_at(_map({k: v[1] for k, v in CLASSIFICATION.items()}), F.col("tipo"))
    explicit = F.nullif(F.trim(F.coalesce(F.col("severidad"), F.lit(""))), F.lit(""))
    return signals.withColumns({"severidad": F.coalesce(explicit, sev, F.lit(DEFAULT_SEVERITY)),
                                "responsable": F.coalesce(owner, F.lit(DEFAULT_OWNER))})


# ---------------------------------------------------------------- T01
def emit_signals(existing: DataFrame | None, incoming: DataFrame) -> DataFrame:
    """Idempotent on (origen, clave, id_tiempo): re-emission refreshes the
    values but keeps ``procesada``; new signals start unprocessed."""
    from terroir.sinks import merge_frames
    inc = incoming.dropDuplicates(["origen", "clave", "id_tiempo"]).withColumn("procesada", F.lit(False))
    if existing is None:
        return inc
    return merge_frames(existing, inc.select(*existing.columns), ["origen", "clave", "id_tiempo"],
                        keep_from_target=["procesada"])


# ---------------------------------------------------------------- T02
ALERT_SCHEMA = ("tipo string, severidad string, causa string, origen string, responsable string, entidad string, "
                "clave string, estado string, ocurrencias long, valor double, umbral double, id_tiempo int, "
                "payload string, primera_vez timestamp, ultima_vez timestamp")


def group_alerts(signals: DataFrame, alerts: DataFrame | None, drained_at: str) -> tuple[DataFrame, DataFrame]:
    """Drain unprocessed signals into alerts → (alerts, processed signals).

    Per key: n signals, the first (by fecha) fixes type/severity/cause, the
    last non-NULL value wins.  A live alert with the key gets
    ocurrencias + n; otherwise a new ABIERTA alert with ocurrencias = n."""
    spark = signals.sparkSession
    pending = classify(signals.filter(~F.col("procesada")))
    o = F.struct("fecha", "clave")
    g = pending.groupBy("clave").agg(
        F.count(F.lit(1)).alias("_n"),
        F.min_by(F.struct("tipo", "severidad", "causa", "origen", "responsable", "entidad", "umbral", "id_tiempo",
                          "payload"), o).alias("_f"),
        F.max_by("valor", F.when(F.col("valor").isNotNull(), o)).alias("_v"))
    now = F.lit(drained_at).cast("timestamp")
    if alerts is None:
        alerts = spark.createDataFrame([], ALERT_SCHEMA)
    live = alerts.filter(F.col("estado").isin(*LIVE))
    closed = alerts.filter(~F.col("estado").isin(*LIVE))
    j = live.alias("a").join(g.alias("g"), "clave", "full_outer")
    has_g, has_a = F.col("_n").isNotNull(), F.col("a.estado").isNotNull()
    pick = lambda c: F.when(has_a, F.col(f"a.{c}")).otherwise(F.col(f"_f.{c}"))
    merged = j.select(
        pick("tipo").alias("tipo"), pick("severidad").alias("severidad"), pick("causa").alias("causa"),
        pick("origen").alias("origen"), pick("responsable").alias("responsable"), pick("entidad").alias("entidad"),
        "clave", F.when(has_a, F.col("a.estado")).otherwise(F.lit("ABIERTA")).alias("estado"),
        (F.coalesce(F.col("a.ocurrencias"), F.lit(0)) + F.coalesce(F.col("_n"), F.lit(0))).cast("long")
        .alias("ocurrencias"),
        F.coalesce(F.col("_v"), F.col("a.valor")).alias("valor"), pick("umbral").alias("umbral"),
        pick("id_tiempo").alias("id_tiempo"), pick("payload").alias("payload"),
        F.when(has_a, F.col("a.primera_vez")).otherwise(now).alias("primera_vez"),
        F.when(has_g, now).otherwise(F.col("a.ultima_vez")).alias("ultima_vez"))
    processed = signals.withColumn("procesada", F.lit(True))
    return closed.unionByName(merged), processed


def alert_summary(alerts: DataFrame, top: int = 20) -> tuple[DataFrame, DataFrame]:
    """Totals by state / severity / type (one GROUPING SETS pass) and the
    ``top`` most recent live alerts."""
    totals = (alerts.groupingSets([["estado"], ["severidad"], ["tipo"], []], "estado", "severidad", "tipo")
              .agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("estado").isin(*LIVE)).alias("abiertas")))
    recent = alerts.filter(F.col("estado").isin(*LIVE)).orderBy(F.col("ultima_vez").desc(), "clave").limit(top)
    return totals, recent


# ---------------------------------------------------------------- A19 / T13-T15
def consolidate_probes(log: DataFrame, group: list[str] | None = None) -> DataFrame:
    """uptime = Σok/Σtries·100 (3), latency = mean of successful probes
    (2; 0 if none), incidents = services with any failure (and their list).
    ``log``: servicio, intentos, exitosos, latencias array<double> (one row
    per probe run) — optionally per ``group`` (e.g. period)."""
    group = group or []
    lat = log.select(*group, "servicio", "intentos", "exitosos", F.explode_outer("latencias").alias("_l"))
    per_run = log.groupBy(*group, "servicio").agg(F.sum("intentos").alias("t"), F.sum("exitosos").alias("ok"))
    lats = lat.groupBy(*group).agg(F.sum("_l").alias("_ls"), F.count("_l").alias("_ln"))
    svc = per_run.groupBy(*group).agg(
        F.sum("t").alias("t"), F.sum("ok").alias("ok"), F.count_if(F.col("ok") < F.col("t")).alias("incidentes"),
        F.array_join(F.sort_array(F.collect_set(F.when(F.col("ok") < F.col("t"), F.col("servicio")))), ",")
        .alias("servicios_caidos"))
    if group:
        j = svc.join(lats, group, "left")
    else:
        j = svc.select("*", one_row(lats).alias("_l")).select(*svc.columns, "_l._ls", "_l._ln")
    return j.select(*group,
                    round_half_up(F.when(F.col("t") > 0, F.col("ok") * 100.0 / F.col("t")).otherwise(F.lit(100.0)), 3)
                    .alias("uptime"),
                    round_half_up(F.coalesce(F.col("_ls") / F.nullif(F.col("_ln"), F.lit(0)), F.lit(0.0)), 2)
                    .alias("latencia_ms"),
                    F.col("incidentes").cast("int").alias("incidentes"), "servicios_caidos")


def slo_signals(metrics: DataFrame, fecha: str, key_cols: list[str]) -> DataFrame:
    """Per row an 'uptime' signal (critical) when uptime < 99.9 and a
    'latencia' signal (warning) when latency > 200 ms (strict)."""
    key = F.concat_ws(":", *[F.col(c).cast("string") for c in key_cols])
    cand = F.array(
        F.when(F.col("uptime") < UPTIME_SLO, F.struct(F.lit("uptime").alias("tipo"), F.lit("critical").alias("sev"),
                                                    F.col("uptime").cast("double").alias("v"),
                                                    F.lit(UPTIME_SLO).alias("u"))),
        F.when(F.col("latencia_ms") > LATENCY_SLO_MS, F.struct(F.lit("latencia").alias("tipo"),
                                                              F.lit("warning").alias("sev"),
                                                              F.col("latencia_ms").cast("double").alias("v"),
                                                              F.lit(LATENCY_SLO_MS).alias("u"))))
    x = metrics.select(*metrics.columns, key.alias("_k"), F.explode(F.array_compact(cand)).alias("_s"))
    return x.select(F.lit("monitor").alias("origen"), F.col("_s.tipo").alias("tipo"), F.col("_s.sev").alias("severidad"),
                    F.concat(F.col("_s.tipo"), F.lit(" fuera de SLO en "), F.col("_k")).alias("causa"),
                    F.col("_k").alias("entidad"), F.concat_ws(":", F.col("_s.tipo"), F.col("_k")).alias("clave"),
                    F.col("_s.v").alias("valor"), F.col("_s.u").alias("umbral"),
                    (F.col("id_tiempo") if "id_tiempo" in metrics.columns else F.lit(None)).cast("int").alias("id_tiempo"),
                    F.lit("{}").alias("payload"), F.lit(fecha).cast("timestamp").alias("fecha"))


def incidents(log: DataFrame, group: list[str] | None = None) -> DataFrame:
    """Per failing service: critical/ABIERTO when every probe failed,
    else warning/RECUPERADO; duration = 30·failed/tries minutes (1)."""
    group = group or []
    g = log.groupBy(*group, "servicio").agg(F.sum("intentos").alias("t"), F.sum("exitosos").alias("ok"))
    f = g.filter(F.col("ok") < F.col("t"))
    return f.select(*group, "servicio",
                    F.when(F.col("ok") == 0, "critical").otherwise("warning").alias("severidad"),
                    F.when(F.col("ok") == 0, "ABIERTO").otherwise("RECUPERADO").alias("estado"),
                    round_half_up(30.0 * (F.col("t") - F.col("ok")) / F.col("t"), 1).alias("duracion_min"))


def availability_rows(metric: DataFrame, regions: DataFrame, id_tiempo: int) -> DataFrame:
    """The consolidated metric for every market (a broadcast join with
    the bounded market dimension), key id_tiempo*1000+id_mercado, zeros for
    unmeasured columns."""
    m = one_row(metric.select("uptime", "latencia_ms", "incidentes"))
    return (regions.select("id_mercado", m.alias("_m")).select("id_mercado", "_m.*")
            .select((F.lit(id_tiempo) * 1000 + F.col("id_mercado")).cast("long").alias("id_disponibilidad"),
                    F.lit(id_tiempo).alias("id_tiempo"), "id_mercado", "uptime", "latencia_ms", "incidentes",
                    F.lit(0).alias("despliegues"), F.lit(0.0).alias("time_to_market_dias"),
                    F.lit(0.0).alias("costo_cloud")))


# ---------------------------------------------------------------- T16 / T17 / A18
def acquisition_indicators(events: DataFrame, leads: DataFrame, conversions: DataFrame) -> DataFrame:
    """A18 per period: spend, deduplicated leads, T07's accepted conversions at CLIENTE;
    rate = conv/leads·100 (2), CAC = spend/conv (2), 0 when the divisor is 0."""
    sp = events.groupBy("id_tiempo").agg(F.sum("gasto").alias("gasto"))
    ld = leads.filter(~F.col("duplicado")).groupBy("id_tiempo").agg(F.countDistinct("clave").alias("leads"))
    cv = (conversions.filter(F.col("etapa") == "CLIENTE").groupBy("id_tiempo")
          .agg(F.countDistinct("lead").alias("conversiones")))
    j = sp.join(ld, "id_tiempo", "full_outer").join(cv, "id_tiempo", "full_outer").fillna(0)
    return j.select("id_tiempo", F.col("gasto").cast("double").alias("gasto"), "leads", "conversiones",
                    round_half_up(F.when(F.col("leads") > 0, F.col("conversiones") * 100.0 / F.col("leads"))
                                  .otherwise(F.lit(0.0)), 2).alias("tasa_conversion"),
                    round_half_up(F.when(F.col("conversiones") > 0, F.col("gasto") / F.col("conversiones"))
                                  .otherwise(F.lit(0.0)), 2).alias("cac"))


def conversion_drop(indicators: DataFrame, fecha: str, floor: float = 5.0) -> DataFrame:
    """A 'conversion' signal when leads > 0 and the rate is below floor."""
    low = indicators.filter((F.col("leads") > 0) & (F.col("tasa_conversion") < floor))
    return _signals(low, "captacion", "conversion", "warning",
                    F.concat_ws(":", F.lit("conversion"), F.col("id_tiempo").cast("string")),
                    F.col("id_tiempo"), F.col("tasa_conversion"), F.lit(floor), F.col("id_tiempo"),
                    F.concat(F.lit("Conversión "), F.col("tasa_conversion").cast("string"), F.lit("% bajo el piso")),
                    ["leads", "conversiones"], fecha)


def retention_actions(alerts: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """One high-priority retention action per (account, live churn alert),
    inserted only when absent (K10)."""
    live = alerts.filter((F.col("tipo") == "churn") & F.col("estado").isin(*LIVE))
    acts = live.select(F.col("entidad").alias("cuenta"), F.col("clave").alias("alerta"),
                       F.lit("alta").alias("prioridad"), F.lit("PENDIENTE").alias("estado"))
    if existing is not None:
        acts = acts.join(existing.select("cuenta", "alerta"), ["cuenta", "alerta"], "left_anti")
    return acts.dropDuplicates(["cuenta", "alerta"])


def support_report(tickets: DataFrame, key: str = "cuenta", onboarding: DataFrame | None = None,
                   at_risk: DataFrame | None = None) -> DataFrame:
    """A17 per account: tickets, open, per-state counts (map), mean
    resolution / first-response minutes, NPS answers and mean (NULL/''/-1
    ignored); with ``onboarding`` (T11) its state and completed steps, with
    ``at_risk`` (accounts with a live churn alert) the retention priority."""
    nps = F.col("nps").try_cast("int")
    valid = nps.isNotNull() & (nps >= 0)
    per_state = tickets.groupBy(key, "estado").agg(F.count(F.lit(1)).alias("n"))
    states = per_state.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("estado", "n"))).alias("por_estado"))
    g = tickets.groupBy(key).agg(
        F.count(F.lit(1)).alias("tickets"),
        F.count_if(~F.col("estado").isin("RESUELTO", "CERRADO")).alias("abiertos"),
        round_half_up(F.avg("minutos_resolucion"), 2).alias("resolucion_media_min"),
        round_half_up(F.avg("minutos_primera_respuesta"), 2).alias("primera_respuesta_media_min"),
        F.count_if(valid).alias("respuestas_nps"),
        round_half_up(F.avg(F.when(valid, nps)), 2).alias("nps_medio"))
    out = g.join(states, key, "left")
    if onboarding is not None:
        out = out.join(onboarding.select(key, F.col("estado").alias("onboarding_estado"),
                                         F.col("pasos_completados").alias("onboarding_pasos")), key, "left")
    if at_risk is not None:
        out = out.join(at_risk.select(key).distinct().withColumn("_risk", F.lit(True)), key, "left").withColumn(
            "prioridad_retencion", F.when(F.col("_risk"), "alta").otherwise("normal")).drop("_risk")
    return out


def empty_signals(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], T.StructType([
        T.StructField("origen", T.StringType()), T.StructField("tipo", T.StringType()),
        T.StructField("severidad", T.StringType()), T.StructField("causa", T.StringType()),
        T.StructField("entidad", T.StringType()), T.StructField("clave", T.StringType()),
        T.StructField("valor", T.DoubleType()), T.StructField("umbral", T.DoubleType()),
        T.StructField("id_tiempo", T.IntegerType()), T.StructField("payload", T.StringType()),
        T.StructField("fecha", T.TimestampType()), T.StructField("procesada", T.BooleanType())]))
