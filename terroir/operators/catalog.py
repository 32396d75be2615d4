"""Theme metrics and dashboard definitions (P10, A26), key resolution (J04,
J15), ordered output (O09), the gated inference run (M08), the dashboard
publication gate with versioning (T18) and the validated reload (K11)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Theme catalogue — theme → (title, metric keys with label and unit).
THEMES = {
    "ingresos": ("Ingresos y suscripciones", [("mrr_actual", "MRR", "$"), ("churn", "Churn", "%"),
                                              ("clientes_activos", "Clientes activos", "")]),
    "resenas": ("Reseñas y puntuaciones", [("total_resenas", "Reseñas", ""),
                                           ("puntuacion_promedio", "Puntuación media", "pts")]),
    "precios": ("Precios de mercado", [("precio_promedio", "Precio medio", "$"), ("precio_maximo", "Precio máx.", "$"),
                                       ("precio_minimo", "Precio mín.", "$")]),
    "uso": ("Uso y adopción", [("adopcion", "Adopción", "%"), ("nps", "NPS", "")]),
}
FILTER_DIMENSIONS = ("tiempo", "mercado", "cliente", "plan")


def _long(row: DataFrame, tema: str, mercado: str | None, cols: list[str]) -> DataFrame:
    args = ", ".join(f"'{c}', CAST({c} AS DOUBLE)" for c in cols)
    return row.select(F.lit(tema).alias("tema"), F.lit(mercado).cast("string").alias("mercado"),
                      F.expr(f"stack({len(cols)}, {args}) as (clave, valor)"))


def theme_metrics(theme: str, a01: DataFrame, a02: DataFrame, a08: DataFrame, market: str | None = None) -> DataFrame:
    """P10: the metric values of one theme as (tema, mercado, clave, valor).
    A market filter applies to the review/price themes (prices then have no
    max/min: NULL)."""
    theme = theme.lower().replace("ñ", "n")
    if theme == "resenas":
        if market:
            r = a02.filter(F.col("pais") == market).select(F.col("total").alias("total_resenas"),
                                                            "puntuacion_promedio")
            return _long(r, theme, market, ["total_resenas", "puntuacion_promedio"])
        return _long(a01, theme, None, ["total_resenas", "puntuacion_promedio"])
    if theme == "precios":
        if market:
            r = a02.filter(F.col("pais") == market).select(
                "precio_promedio", F.lit(None).cast("double").alias("precio_maximo"),
                F.lit(None).cast("double").alias("precio_minimo"))
            return _long(r, theme, market, ["precio_promedio", "precio_maximo", "precio_minimo"])
        return _long(a01, theme, None, ["precio_promedio", "precio_maximo", "precio_minimo"])
    if theme == "ingresos":
        return _long(a08, theme, None, ["mrr_actual", "churn", "clientes_activos"])
    if theme == "uso":
        return _long(a08, theme, None, ["adopcion", "nps"])
    raise ValueError(f"tema_inexistente:{theme}")


def catalogue(spark: SparkSession) -> DataFrame:
    rows = [(t, title, k, lbl, unit, i) for t, (title, ms) in THEMES.items() for i, (k, lbl, unit) in enumerate(ms)]
    return spark.createDataFrame(rows, "tema string, titulo string, clave string, etiqueta string, unidad string, "
                                       "orden int")


def dashboard_definition(values: DataFrame, requests: DataFrame, nombre: str, filters: dict | None = None) -> DataFrame:
    """One draft definition per requested (client, theme) and name: the
    theme's metric catalogue joined to its values, filters and source, as
    JSON; duplicate requests collapse to one draft (K09 key)."""
    spark = values.sparkSession
    cat = F.broadcast(catalogue(spark))       # bounded catalogue (a dozen rows)
    m = values.join(cat, ["tema", "clave"])
    per_theme = m.groupBy("tema", "titulo").agg(
        F.sort_array(F.collect_list(F.struct("orden", "clave", "etiqueta", "unidad", "valor"))).alias("metricas"))
    filt = F.to_json(F.create_map(*[x for k, v in (filters or {}).items() for x in (F.lit(k), F.lit(str(v)))])) \
        if filters else F.lit("{}")
    # themes are bounded (4 rows): broadcast equi-join on the theme
    j = requests.select("cliente", "tema").dropDuplicates().join(F.broadcast(per_theme), "tema")
    return j.select("cliente", "tema", F.lit(nombre).alias("nombre"), F.lit("BORRADOR").alias("estado"),
                    F.to_json(F.struct("titulo", "metricas", filt.alias("filtros"),
                                       F.lit("serving").alias("fuente"))).alias("definicion"))


# ---------------------------------------------------------------- J04
def resolve_fk(df: DataFrame, dim: DataFrame, col: str, id_col: str, on_missing: str = "drop",
               unknown: str = "Desconocido") -> DataFrame:
    """Dictionary lookup of ``col`` against ``dim(nombre, id)``.
    on_missing: 'drop' (row leaves), 'null' (id NULL) or 'member' (the
    unknown member's id)."""
    d = dim.select(F.col(id_col), F.col("nombre").alias(col))
    if on_missing == "drop":
        return df.join(d, col, "inner")
    j = df.join(d, col, "left")
    if on_missing == "member":
        unk = dim.filter(F.col("nombre") == unknown).agg(F.min(id_col)).scalar()
        j = j.withColumn(id_col, F.coalesce(F.col(id_col), unk))
    return j


# ---------------------------------------------------------------- J15
def resolve_catalog(df: DataFrame, ref_col: str, catalog: DataFrame, id_col: str, keys: list[str],
                    error: str) -> DataFrame:
    """Resolve a reference by alternative keys in priority (e.g. code,
    then name, then numeric id): one left join per key on the normalised
    value, coalesced; unresolved rows carry ``error``."""
    norm = F.lower(F.trim(F.col(ref_col).cast("string")))
    out = df.withColumn("_ref", norm)
    found = []
    for i, k in enumerate(keys):
        c = catalog.select(F.lower(F.trim(F.col(k).cast("string"))).alias("_ref"), F.col(id_col).alias(f"_id{i}"))
        out = out.join(c.dropDuplicates(["_ref"]), "_ref", "left")
        found.append(F.col(f"_id{i}"))
    return (out.withColumn(id_col, F.coalesce(*found))
            .withColumn("error", F.when(F.col(id_col).isNull(), F.lit(error)))
            .drop("_ref", *[f"_id{i}" for i in range(len(keys))]))


# ---------------------------------------------------------------- O09
def ordered(df: DataFrame, *cols: str | Column) -> DataFrame:
    """Deterministic output order (histogram by value, series by
    perspective/series/order)."""
    return df.orderBy(*cols)


# ---------------------------------------------------------------- M08
def run_inference(spark: SparkSession, seal: DataFrame, compute, run_id: str) -> DataFrame:
    """Gate on the quality seal (Q09 row with ``ok``); blocked runs write
    nothing; failures are reported, not raised.  ``compute()`` returns the
    (predictions, signals) DataFrames and performs their writes."""
    s = seal.first()
    if s is None or not s["ok"]:
        state, preds, sigs, detail = "BLOQUEADA_POR_CALIDAD", 0, 0, (s["motivo"] if s else "sin_sello")
    else:
        try:
            p, g = compute()
            state, preds, sigs, detail = "COMPLETADA", p.count(), g.count(), ""
        except Exception as e:  # noqa: BLE001 — the run record carries the failure
            state, preds, sigs, detail = "FALLIDA", 0, 0, f"{type(e).__name__}: {e}"[:500]
    return spark.createDataFrame([(run_id, state, preds, sigs, detail)],
                                 "corrida string, estado string, predicciones long, senales long, detalle string")


# ---------------------------------------------------------------- T18
def _asof_seal_ok(requests: DataFrame, seals: DataFrame, suite: str) -> DataFrame:
    """Whether the newest seal at or before each request is a fresh success.

    A successful seal holds from its date until it expires or the next seal
    replaces it: these spans are disjoint.  Each is listed under the days it
    touches (as many as its validity has), so the as-of lookup is an equi
    join by day; no window runs over the requests."""
    s = seals.filter(F.col("suite") == suite).select(
        F.col("fecha").cast("timestamp").alias("_from"), "exito",
        F.coalesce("vigencia_horas", F.lit(24.0)).alias("_vig"))
    nxt = F.lead("_from").over(Window.orderBy("_from", "exito"))            # seals of one suite: one a day
    s = (s.withColumns({"_next": nxt, "_until": (F.unix_micros("_from") + F.col("_vig") * 3.6e9).cast("long")})
         .filter("exito").select("_from", "_next", "_until"))
    days = F.sequence(F.to_date("_from"), F.to_date(F.timestamp_micros("_until")))
    spans = s.withColumn("_day", F.explode(days))
    r = requests.withColumn("_day", F.to_date("fecha"))
    inside = ((r["_day"] == spans["_day"]) & (F.col("fecha") >= F.col("_from"))
              & (F.unix_micros(F.col("fecha").cast("timestamp")) <= F.col("_until"))
              & (F.col("_next").isNull() | (F.col("fecha") < F.col("_next"))))
    return (r.join(spans, inside, "left").withColumn("sello_ok", F.col("_from").isNotNull())
            .select(*requests.columns, "sello_ok"))


# States of a dashboard's publication, and the requests' targets (publicar,
# despublicar, listo): a publication may replace an active one; after an
# unpublish the dashboard must be marked ready again.
PUBLICATION = {"LISTO": ["PUBLICADO"], "PUBLICADO": ["PUBLICADO", "DESPUBLICADO"], "DESPUBLICADO": ["LISTO"]}
PUBLICATION_TARGET = {"publicar": "PUBLICADO", "despublicar": "DESPUBLICADO", "listo": "LISTO"}


def publication_verdicts(requests: DataFrame, seals: DataFrame, subs: DataFrame, suite: str = "dw") -> DataFrame:
    """Per request (dashboard, cuenta, propietario, accion, fecha, seq) a
    verdict.  A publication is checked in this order: the dashboard is ready,
    published or blocked (else estado_invalido); owner (fuga_multitenant);
    fresh seal (sin_sello_calidad); active plan (sin_plan_activo).  An
    unpublish needs an active publication (publicacion_inexistente).

    The states are a finite machine, replayed by T00 with hot dashboards
    split; blocked publications take part without moving it.  The version
    starts at 1 and rises only when an active publication is replaced.  Each
    accepted publication is ACTIVA until the next accepted one (REEMPLAZADA)
    or an unpublish (DESPUBLICADO).  The count of replacements before a
    request and the next accepted move behind it are running aggregates over
    the replay's range partitions, forward and backward."""
    from terroir.operators.lifecycle import APPLIED, entitlement, replay
    from terroir.operators.scans import cut_keys, running, stored
    plan = entitlement(subs, "cuenta").select("cuenta", F.col("acceso").alias("_plan"))
    r = _asof_seal_ok(requests, seals, suite).join(plan, "cuenta", "left")
    gate = (F.when(F.col("cuenta") != F.col("propietario"), "fuga_multitenant")
            .when(~F.col("sello_ok"), "sin_sello_calidad").when(F.col("_plan").isNull(), "sin_plan_activo"))
    target = F.element_at(F.create_map(*[F.lit(x) for kv in PUBLICATION_TARGET.items() for x in kv]), F.col("accion"))
    r = r.withColumn("_gate", F.when(F.col("accion") == "publicar", gate))
    r = r.withColumn("_target", F.when(F.col("_gate").isNull(), target)).drop("_plan")
    f = replay(r, "dashboard", ["fecha", "seq"], "_target", PUBLICATION, "LISTO", keep_pid=True)
    before, pub = F.col("estado_anterior"), F.col("accion") == "publicar"
    applied = F.col("veredicto") == APPLIED
    verdict = (F.when(pub & (before == "DESPUBLICADO"), "estado_invalido").when(F.col("_gate").isNotNull(), F.col("_gate"))
               .when(applied | (F.col("accion") == "listo"), "aceptada")
               .when(F.col("accion") == "despublicar", "publicacion_inexistente").otherwise("accion_invalida"))
    f = f.withColumns({"veredicto": verdict, "_pub": pub & applied,
                       "_replaces": (pub & applied & (before == "PUBLICADO")).cast("long"),
                       "_moves": applied & F.col("accion").isin("publicar", "despublicar")})
    f = stored(f)
    key = ["dashboard"]
    cut = cut_keys(f, key)
    f = running(f, key, ["paso"], {"_replaced": ("sum", F.col("_replaces"))}, cut=cut)
    move = F.when(F.col("_moves"), F.col("paso") * 2 + (F.col("accion") == "publicar").cast("long"))     # nearest first
    f = running(f, key, ["paso"], {"_next": ("min", move)}, reverse=True, cut=cut)
    state = (F.when(~F.col("_pub"), F.lit(None)).when(F.col("_next").isNull(), "ACTIVA")
             .when(F.col("_next") % 2 == 1, "REEMPLAZADA").otherwise("DESPUBLICADO"))
    version = F.when(F.col("_pub"), F.lit(1) + F.col("_replaced") + F.col("_replaces"))
    return f.select(*requests.columns, "sello_ok", "veredicto", version.alias("version"), state.alias("estado_version"))


# ---------------------------------------------------------------- K11
def reload(spark: SparkSession, csv_path: str, target: str) -> DataFrame:
    """Validate the whole contract CSV first (S01 raises on the first
    violation, nothing is touched), then truncate-and-load the target."""
    from terroir.sources.readers import read_contract_csv
    df = read_contract_csv(spark, csv_path)
    df.write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
