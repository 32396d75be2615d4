"""Business scorecard aggregates (A08-A11, A14, A24, A25) over the month-grain
business star.

``latest`` (max period of the time dimension) is resolved once as a scalar
and then used as a literal, so every fact scan gets a pushed-down
``id_tiempo`` predicate instead of the reference's cross join with a
one-row CTE.  Series windows run on aggregated frames (one row per period
or per member), never on fact rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terroir.functions import exact_avg, one_row, round_half_up, traffic_light

Facts = dict[str, DataFrame]


def latest_period(dim_tiempo: DataFrame) -> int:
    """max(id_tiempo) of the time dimension (one scalar)."""
    return int(dim_tiempo.agg(F.max("id_tiempo")).first()[0])


def at_latest(fact: DataFrame, dim_tiempo: DataFrame, latest: int | None = None) -> DataFrame:
    """Rows of the latest period.  The reference cross-joins a one-row
    CTE and filters; here the scalar is resolved once and becomes a literal
    predicate pushed to the scan."""
    latest = latest or latest_period(dim_tiempo)
    return fact.filter(F.col("id_tiempo") == latest)


def clients_by_market(fact: DataFrame, clients: DataFrame, markets: DataFrame) -> DataFrame:
    """2-hop inner join fact → client → market (the market dimension is
    bounded and broadcast at runtime by AQE; clients may be large)."""
    return (fact.join(clients.select("id_cliente", "id_mercado"), "id_cliente")
            .join(markets.select("id_mercado", "pais", "region_geo"), "id_mercado"))


def last_periods(dim_tiempo: DataFrame, n: int = 3) -> DataFrame:
    """The n newest periods of the time dimension (semi-join input)."""
    return dim_tiempo.select("id_tiempo").orderBy(F.col("id_tiempo").desc()).limit(n)


def _r4(c: Column) -> Column:
    return round_half_up(c, 4)


def _measures(fact: DataFrame, **aggregates: Column) -> DataFrame:
    """The named aggregates of ``fact`` as one row of doubles."""
    return fact.agg(*[a.cast("double").alias(k) for k, a in aggregates.items()])


def _mean_of(value: str, cond: Column) -> dict[str, Column]:
    """The two exact sums behind a mean of ``value`` over the rows of ``cond``."""
    return {f"{value}_suma": F.sum(F.when(cond, F.col(value))), f"{value}_filas": F.count_if(cond)}


def scorecard_measures(s: Facts, reviews_fact: DataFrame, latest: int) -> list[DataFrame]:
    """The base sums and counts of A08, a one-row frame per fact (J08): every fact
    is scanned once at a literal period, and the KPIs are formulas over them."""
    now = F.col("id_tiempo") == latest
    billed = s["fact_suscripcion"].filter(F.col("id_tiempo").isin(latest, latest - 100) & (F.col("es_churn") == 0))
    recent = s["fact_suscripcion"].join(last_periods(s["dim_tiempo"], 3), "id_tiempo", "left_semi")
    at = {n: s[f"fact_{n}"].filter(now) for n in ("consumo_api", "conversion", "retencion", "disponibilidad",
                                                  "uso_plataforma", "aprendizaje")}
    nps = F.col("nps_score")
    return [
        _measures(billed, ingreso=F.sum(F.when(now, F.col("mrr"))), ingreso_hace_un_ano=F.sum(F.when(~now, F.col("mrr")))),
        _measures(recent, altas=F.sum("es_nuevo")),
        _measures(at["consumo_api"], ingreso_api=F.sum("ingreso_api")),
        _measures(at["conversion"], ganados=F.sum("conversiones"), captados=F.sum("leads"),
                  **_mean_of("cac", F.col("conversiones") > 0)),
        _measures(at["retencion"], vigentes=F.sum("activo"), bajas=F.sum("cancelacion"), **_mean_of("ltv", F.col("activo") == 1)),
        _measures(at["disponibilidad"], nube=F.sum("costo_cloud"),
                  **{k: v for c in ("uptime", "time_to_market_dias", "latencia_ms")
                     for k, v in _mean_of(c, F.col(c).isNotNull()).items()}),
        _measures(at["uso_plataforma"], promotores=F.count_if(nps >= 9), detractores=F.count_if(nps.between(0, 6)),
                  encuestados=F.count_if(nps >= 0), asientos_usados=F.sum("usuarios_activos"), asientos=F.sum("usuarios_totales")),
        _measures(reviews_fact, resenas=F.count(F.lit(1)), resenas_en_rango=F.count_if(F.col("points").between(80, 100))),
        _measures(at["aprendizaje"], **{c: F.max(c) for c in ("horas_capacitacion", "decisiones_data_driven",
                                                              "tecnologias_adoptadas", "rotacion_personal",
                                                              "modelos_ml_produccion")}),
    ]


def scorecard_kpis(s: Facts, reviews_fact: DataFrame, latest: int | None = None) -> DataFrame:
    """One-row KPI vector at ``latest`` (formulas of §2.5.1).  Each fact's measures are one struct-valued
    scalar subquery, so a reader of a few KPIs scans only the facts behind them."""
    t = s["dim_tiempo"]
    latest = latest or latest_period(t)
    parts = scorecard_measures(s, reviews_fact, latest)
    part_of = {c: f"_{i}" for i, p in enumerate(parts) for c in p.columns}
    row = (t.filter(F.col("id_tiempo") == latest).agg(F.max("periodo").alias("periodo")).filter(F.col("periodo").isNotNull())
           .select("periodo", *[one_row(p).alias(f"_{i}") for i, p in enumerate(parts)]))

    def v(name: str) -> Column:
        return F.coalesce(F.col(part_of[name])[name], F.lit(0.0))

    def share(part: Column, whole: Column, scale: float = 100.0, empty: float = 0.0) -> Column:
        return F.when(whole == 0, F.lit(empty)).otherwise(part * scale / whole)

    def mean(name: str) -> Column:
        return share(v(f"{name}_suma"), v(f"{name}_filas"), 1.0)
    clients = F.greatest(v("vigentes"), F.lit(1.0))
    growth = F.when(v("ingreso_hace_un_ano") == 0, F.lit(0.0)).otherwise((v("ingreso") / v("ingreso_hace_un_ano") - 1) * 100)
    both = v("ingreso") + v("ingreso_api")
    api = F.when(both == 0, F.lit(0.0)).otherwise(v("ingreso_api") / both * 100)
    kpis = {
        "mrr_growth": growth, "api_share": api, "ltv_cac": share(mean("ltv"), mean("cac"), 1.0),
        "cloud_cli": v("nube") / clients, "conversion": share(v("ganados"), v("captados")),
        "churn": share(v("bajas"), v("vigentes") + v("bajas")),
        "nps": share(v("promotores") - v("detractores"), v("encuestados")),
        "adopcion": share(v("asientos_usados"), v("asientos")),
        "uptime": mean("uptime"), "ttm": mean("time_to_market_dias"), "latencia": mean("latencia_ms"),
        "calidad": share(v("resenas_en_rango"), v("resenas"), empty=100.0),
        "horas": v("horas_capacitacion"), "ddd": v("decisiones_data_driven"), "mlmod": v("modelos_ml_produccion"),
        "rotacion": v("rotacion_personal"), "tecno": v("tecnologias_adoptadas"),
    }
    money = {"mrr_actual": v("ingreso"), "cac": mean("cac"), "nuevos_trim": v("altas")}
    order = ["mrr_actual", "mrr_growth", "api_share", "cac", "ltv_cac", "cloud_cli", "conversion", "churn", "nps", "adopcion",
             "nuevos_trim", "uptime", "ttm", "latencia", "calidad", "horas", "ddd", "mlmod", "rotacion", "tecno"]
    return row.select("periodo", clients.cast("int").alias("clientes_activos"),
                      *[(round_half_up(money[k], 2) if k in money else _r4(kpis[k])).alias(k) for k in order])


# ------------------------------------------------------------------ A09
def _series(per: DataFrame, persp: str, serie: str, value: Column, present: Column | None = None) -> DataFrame:
    """One period series from a per-period aggregate ``per`` (one row per
    period, already joined to its label).  ``present`` keeps only periods
    that had qualifying rows (the reference's WHERE before GROUP BY)."""
    g = per if present is None else per.filter(present)
    w = Window.orderBy("id_tiempo")  # one row per period: a bounded, aggregated frame
    return g.select(F.lit(persp).alias("perspectiva"), F.lit(serie).alias("serie"),
                    F.col("periodo").alias("etiqueta"), (F.row_number().over(w) - 1).cast("int").alias("orden"),
                    _r4(F.coalesce(value.cast("double"), F.lit(0.0))).alias("valor"))


def _rank_branch(g: DataFrame, persp: str, serie: str, label: str, limit: int | None = None) -> DataFrame:
    w = Window.orderBy(F.col("_v").desc(), F.col(label).asc())  # one row per member
    out = g.select(F.lit(persp).alias("perspectiva"), F.lit(serie).alias("serie"),
                   F.col(label).alias("etiqueta"), (F.row_number().over(w) - 1).cast("int").alias("orden"),
                   _r4(F.coalesce(F.col("_v").cast("double"), F.lit(0.0))).alias("valor"))
    return out if limit is None else out.filter(F.col("orden") < limit)


def period_aggregates(s: Facts) -> dict[str, DataFrame]:
    """Each fact aggregated ONCE per period with every figure the period
    series need (conditional sums/counts); the series are projections of
    these small frames, so each fact is scanned and shuffled a single time."""
    t = s["dim_tiempo"].select("id_tiempo", "periodo")

    def per(fact, *aggs):
        return fact.groupBy("id_tiempo").agg(*aggs).join(t, "id_tiempo")
    nc = F.col("es_churn") == 0
    pos = F.col("conversiones") > 0
    return {
        "sus": per(s["fact_suscripcion"], F.sum(F.when(nc, F.col("mrr"))).alias("mrr"),
                   F.count_if(nc).alias("n_mrr")),
        "api": per(s["fact_consumo_api"], F.sum("ingreso_api").alias("ingreso_api"), F.sum("llamadas").alias("llamadas"),
                   F.sum("errores").alias("errores"), F.sum("latencia_ms").alias("lat_sum"),
                   F.count("latencia_ms").alias("lat_n")),
        "conv": per(s["fact_conversion"], F.sum(F.when(pos, F.col("cac"))).alias("cac_sum"),
                    F.count_if(pos).alias("cac_n"), F.sum("conversiones").alias("conversiones"),
                    F.sum("leads").alias("leads")),
        "ret": per(s["fact_retencion"], F.sum("cancelacion").alias("cancel"), F.sum("activo").alias("activo")),
        "uso": per(s["fact_uso_plataforma"], F.count_if(F.col("nps_score") >= 9).alias("prom"),
                   F.count_if(F.col("nps_score").between(0, 6)).alias("det"),
                   F.count_if(F.col("nps_score") >= 0).alias("tot")),
        "disp": per(s["fact_disponibilidad"], F.sum("uptime").alias("up_sum"), F.count("uptime").alias("up_n"),
                    F.sum("time_to_market_dias").alias("ttm_sum"), F.count("time_to_market_dias").alias("ttm_n"),
                    F.sum("incidentes").alias("incidentes"), F.sum("latencia_ms").alias("lat_sum"),
                    F.count("latencia_ms").alias("lat_n")),
    }


def scorecard_series(s: Facts, latest: int | None = None) -> DataFrame:
    """The 18 series branches in long format (perspectiva, serie,
    etiqueta, orden, valor), stacked with unionByName (U03)."""
    t = s["dim_tiempo"]
    latest = latest or latest_period(t)
    at = F.col("id_tiempo") == latest
    sus, api, conv = s["fact_suscripcion"], s["fact_consumo_api"], s["fact_conversion"]
    disp = s["fact_disponibilidad"]
    avg = lambda c: exact_avg(F.sum(c), F.count(c))
    P = period_aggregates(s)
    c = F.col
    parts = [
        _series(P["sus"], "financiera", "mrr", c("mrr"), c("n_mrr") > 0),
        _series(P["api"], "financiera", "api", c("ingreso_api")),
        _series(P["conv"], "financiera", "cac", exact_avg(c("cac_sum"), c("cac_n")), c("cac_n") > 0),
        _rank_branch(sus.filter(at & (F.col("es_churn") == 0))
                     .join(s["dim_plan"].select("id_plan", F.col("nombre").alias("plan")), "id_plan")
                     .groupBy("plan").agg(F.sum("mrr").alias("_v")), "financiera", "por_plan", "plan"),
        _rank_branch(clients_by_market(sus, s["dim_cliente"], s["dim_mercado"])
                     .groupBy("pais").agg(F.sum("es_nuevo").alias("_v")), "cliente", "nuevos_mercado", "pais", 12),
        _series(P["conv"], "cliente", "conversion", c("conversiones") * 100.0 / F.nullif(c("leads"), F.lit(0))),
        _series(P["ret"], "cliente", "churn", c("cancel") * 100.0 / F.nullif(c("activo") + c("cancel"), F.lit(0))),
        _series(P["uso"], "cliente", "nps", (c("prom") - c("det")) * 100.0 / F.nullif(c("tot"), F.lit(0))),
    ]
    emb = conv.filter(at).agg(F.coalesce(F.sum("leads"), F.lit(0)).alias("leads"), F.coalesce(F.sum("oportunidades"), F.lit(0)).alias("oportunidades"),
                              F.coalesce(F.sum("conversiones"), F.lit(0)).alias("conversiones"))
    stacked = F.expr("stack(3, 'leads', 0, leads, 'oportunidades', 1, oportunidades, "
                     "'conversiones', 2, conversiones) as (etiqueta, orden, v)")
    parts.append(emb.select(stacked).select(
        F.lit("cliente").alias("perspectiva"), F.lit("embudo").alias("serie"), "etiqueta",
        F.col("orden").cast("int").alias("orden"), _r4(F.col("v").cast("double")).alias("valor")))
    parts += [
        _series(P["disp"], "procesos", "uptime", exact_avg(c("up_sum"), c("up_n"))),
        _series(P["disp"], "procesos", "ttm", exact_avg(c("ttm_sum"), c("ttm_n"))),
        _rank_branch(disp.filter(at).join(s["dim_mercado"].select("id_mercado", "region_geo"), "id_mercado")
                     .groupBy("region_geo").agg(avg("latencia_ms").alias("_v")),
                     "procesos", "latencia_region", "region_geo"),
        _series(P["disp"], "procesos", "incidentes", c("incidentes")),
        _rank_branch(api.join(s["dim_partner_api"].select("id_partner", "nombre"), "id_partner")
                     .groupBy("nombre").agg(F.sum("ingreso_api").alias("_v")), "ecosistema", "ingresos_partner",
                     "nombre"),
        _series(P["api"], "ecosistema", "llamadas", c("llamadas")),
        _rank_branch(s["fact_integracion_partner"].filter(at)
                     .join(s["dim_partner_api"].select("id_partner", "nombre"), "id_partner")
                     .groupBy("nombre").agg(F.max("conexiones_activas").alias("_v")),
                     "ecosistema", "conexiones_partner", "nombre"),
    ]
    return reduce(DataFrame.unionByName, parts)


# ------------------------------------------------------------------ A10
def usage_by_client(uso: DataFrame, clients: DataFrame) -> DataFrame:
    """A10: usage per client; adoption from the already rounded averages."""
    n = F.count(F.lit(1))
    g = uso.groupBy("id_cliente").agg(
        F.countDistinct("id_tiempo").alias("periodos"), F.sum("sesiones").alias("sesiones"),
        F.sum("dashboards_vistos").alias("dashboards_vistos"), F.sum("funciones_usadas").alias("funciones_total"),
        round_half_up(exact_avg(F.sum("funciones_usadas"), n), 1).alias("funciones_promedio"),
        round_half_up(exact_avg(F.sum("usuarios_activos"), n), 0).alias("ua"),
        round_half_up(exact_avg(F.sum("usuarios_totales"), n), 0).alias("ut"),
        exact_avg(F.sum(F.when(F.col("nps_score") >= 0, F.col("nps_score"))),
                  F.count(F.when(F.col("nps_score") >= 0, 1))).alias("nps"),
        F.max("id_tiempo").alias("ultimo_periodo"))
    c = clients.select("id_cliente", "nombre", "id_plan")
    return g.join(c, "id_cliente", "left").select(
        "id_cliente", F.coalesce(F.col("nombre"), F.lit("")).alias("nombre"),
        F.coalesce(F.col("id_plan"), F.lit(0)).cast("int").alias("id_plan"),
        F.col("periodos").cast("int").alias("periodos"), F.col("sesiones").cast("long").alias("sesiones"),
        F.col("dashboards_vistos").cast("long").alias("dashboards_vistos"),
        F.col("funciones_total").cast("long").alias("funciones_total"),
        F.coalesce(F.col("funciones_promedio"), F.lit(0.0)).alias("funciones_promedio"),
        F.col("ua").cast("int").alias("usuarios_activos"), F.col("ut").cast("int").alias("usuarios_totales"),
        round_half_up(F.col("sesiones").cast("double") / F.nullif(F.col("periodos"), F.lit(0)).cast("double"), 2)
        .alias("frecuencia_sesiones"),
        round_half_up(F.when(F.col("ut") > 0, F.col("ua") / F.col("ut") * 100).otherwise(F.lit(0.0)), 1)
        .alias("adopcion_pct"),
        round_half_up(F.coalesce(F.col("nps"), F.lit(0.0)), 2).alias("nps_promedio"),
        F.col("ultimo_periodo").cast("int").alias("ultimo_periodo"))


def top_clients(a10: DataFrame, k: int = 200) -> DataFrame:
    """Top k clients by sessions (id tie-break)."""
    return a10.orderBy(F.col("sesiones").desc(), F.col("id_cliente").asc()).limit(k)


# ------------------------------------------------------------------ A11
def daily_consolidation(s: Facts) -> DataFrame:
    """Per period (U01 spine of three facts ⋈ time dim), each fact
    pre-aggregated to one row per period before the left joins (J07)."""
    api, uso, disp = s["fact_consumo_api"], s["fact_uso_plataforma"], s["fact_disponibilidad"]
    spine = (api.select("id_tiempo").unionByName(uso.select("id_tiempo")).unionByName(disp.select("id_tiempo"))
             .distinct().join(s["dim_tiempo"].select("id_tiempo", "periodo"), "id_tiempo"))
    a = api.groupBy("id_tiempo").agg(
        F.sum("llamadas").alias("api_llamadas"), F.sum("errores").alias("api_errores"),
        exact_avg(F.sum("latencia_ms"), F.count("latencia_ms")).alias("api_latencia_ms"),
        F.sum("ingreso_api").cast("double").alias("api_ingreso"))
    u = uso.groupBy("id_tiempo").agg(
        F.sum("sesiones").alias("uso_sesiones"), F.sum("funciones_usadas").alias("uso_funciones"),
        F.sum("usuarios_activos").alias("uso_usuarios_activos"), F.sum("dashboards_vistos").alias("uso_dashboards"))
    d = disp.groupBy("id_tiempo").agg(
        F.sum("incidentes").alias("incidentes"), exact_avg(F.sum("uptime"), F.count("uptime")).alias("uptime"),
        F.sum("despliegues").alias("despliegues"))
    j = spine.join(a, "id_tiempo", "left").join(u, "id_tiempo", "left").join(d, "id_tiempo", "left")
    z = lambda c, t: F.coalesce(F.col(c), F.lit(0)).cast(t).alias(c)
    return j.select(
        "id_tiempo", "periodo", z("api_llamadas", "long"), z("api_errores", "int"),
        round_half_up(F.coalesce(F.col("api_latencia_ms"), F.lit(0.0)), 2).alias("api_latencia_ms"),
        round_half_up(F.coalesce(F.col("api_ingreso"), F.lit(0.0)), 2).alias("api_ingreso"),
        z("uso_sesiones", "long"), z("uso_funciones", "long"), z("uso_usuarios_activos", "int"),
        z("uso_dashboards", "long"), z("incidentes", "int"),
        round_half_up(F.coalesce(F.col("uptime"), F.lit(0.0)), 3).alias("uptime"), z("despliegues", "int"))


# ------------------------------------------------------------------ A14
# Anomaly series names.
SERIES = {"mrr": "Ingresos recurrentes (MRR)", "churn": "Tasa de churn", "errores": "Errores de API",
          "latencia": "Latencia global"}


def anomaly_series(s: Facts) -> DataFrame:
    """The four monthly series (serie, id_tiempo, periodo, valor), read
    from the shared per-period aggregates; churn keeps the reference's
    unguarded division as try_divide (NULL on 0)."""
    P = period_aggregates(s)
    c = F.col

    def branch(per, name, value, present=None):
        g = per if present is None else per.filter(present)
        return g.select(F.lit(SERIES[name]).alias("serie"), "id_tiempo", "periodo", value.alias("valor"))
    return reduce(DataFrame.unionByName, [
        branch(P["sus"], "mrr", c("mrr").cast("double"), c("n_mrr") > 0),
        branch(P["ret"], "churn", F.try_divide(c("cancel") * 100.0, (c("activo") + c("cancel")).cast("double"))),
        branch(P["api"], "errores", c("errores").cast("double")),
        branch(P["disp"], "latencia", exact_avg(c("lat_sum"), c("lat_n"))),
    ])


# ------------------------------------------------------------------ A24
# Scorecard cards (perspective, key, label, KPI column, target, unit, better).
CARDS = [
    ("financiera", "mrr_growth", "Crecimiento de MRR", "mrr_growth", 30.0, "%", "mayor"),
    ("financiera", "api_share", "Ingresos vía API", "api_share", 35.0, "%", "mayor"),
    ("financiera", "cac", "CAC internacional", "cac", 1200.0, "$", "menor"),
    ("financiera", "ltv_cac", "Ratio LTV / CAC", "ltv_cac", 3.0, "x", "mayor"),
    ("financiera", "cloud", "Costo cloud / cliente", "cloud_cli", 50.0, "$", "menor"),
    ("cliente", "conversion", "Conversión del embudo", "conversion", 8.0, "%", "mayor"),
    ("cliente", "churn", "Tasa de churn", "churn", 4.0, "%", "menor"),
    ("cliente", "nps", "Net Promoter Score", "nps", 50.0, "", "mayor"),
    ("cliente", "adopcion", "Adopción plataforma", "adopcion", 70.0, "%", "mayor"),
    ("cliente", "nuevos", "Nuevos clientes (trim)", "nuevos_trim", 15.0, "", "mayor"),
    ("procesos", "uptime", "Disponibilidad (Uptime)", "uptime", 99.9, "%", "mayor"),
    ("procesos", "ttm", "Time-to-market", "ttm", 1.0, "d", "menor"),
    ("procesos", "latencia", "Latencia global", "latencia", 200.0, "ms", "menor"),
    ("procesos", "apis", "APIs documentadas (SDD)", None, 100.0, "%", "mayor"),
    ("procesos", "calidad", "Calidad del Data Warehouse", "calidad", 98.0, "%", "mayor"),
    ("aprendizaje", "horas", "Horas de capacitación", "horas", 32.0, "h", "mayor"),
    ("aprendizaje", "ddd", "Decisiones data-driven", "ddd", 80.0, "%", "mayor"),
    ("aprendizaje", "mlmod", "Modelos ML en producción", "mlmod", 6.0, "", "mayor"),
    ("aprendizaje", "rotacion", "Rotación de personal", "rotacion", 10.0, "%", "menor"),
    ("aprendizaje", "tecno", "Tecnologías adoptadas", "tecno", 4.0, "", "mayor"),
]


def scorecard_cards(a08: DataFrame) -> DataFrame:
    """KPI vector unpivoted to 4×5 cards with target and traffic light."""
    n = len(CARDS)
    args = ", ".join(
        f"{i}, '{p}', '{k}', CAST({c if c else '100.0'} AS DOUBLE)" for i, (p, k, _l, c, *_r) in enumerate(CARDS))
    long = a08.select("periodo", F.expr(f"stack({n}, {args}) as (pos, perspectiva, clave, v)"))
    targets = a08.sparkSession.createDataFrame(
        [(i, lbl, float(t), u, b) for i, (_p, _k, lbl, _c, t, u, b) in enumerate(CARDS)],
        "pos int, etiqueta string, meta double, unidad string, mejor string")
    j = long.join(F.broadcast(targets), "pos")  # 20-row catalogue
    v = round_half_up(F.coalesce(F.col("v"), F.lit(0.0)), 2)
    return j.select("periodo", "perspectiva", "clave", "etiqueta", v.alias("valor"), "meta", "unidad", "mejor",
                    traffic_light(v, F.col("meta"), F.col("mejor")).alias("estado"), "pos")


def series_payload(a09: DataFrame) -> DataFrame:
    """Long series regrouped per (perspective, series) as an ordered list."""
    return (a09.groupBy("perspectiva", "serie")
            .agg(F.sort_array(F.collect_list(F.struct("orden", "etiqueta", round_half_up("valor", 2).alias("valor"))))
                 .alias("puntos")))
