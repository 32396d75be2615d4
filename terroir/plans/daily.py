"""The daily batch job (the reference's 12-step run) as one Spark application.

Steps hand over through written tables.  A batch that is FALLIDA stops the
run: nothing is landed and nothing is promoted.  Otherwise the warehouse is
built from the landed reviews only, and the quality gates stop promotion
(``QualityGateError``).  Every write is idempotent (partition
overwrite, versioned upsert or overwrite by date), so re-running a day
yields the same tables.  Returns one row per step (name, state, rows).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terroir import sinks as K
from terroir.operators import aggregates as A
from terroir.operators import alerts as AL
from terroir.operators import catalog as CT
from terroir.operators import ingest as IG
from terroir.operators import quality as Q
from terroir.operators import report as RP
from terroir.operators import scorecard as B
from terroir.operators import scoring as M
from terroir.plans import business as PB
from terroir.plans import reviews as PR


def run_daily(spark: SparkSession, sf_dir: str, out: str, day: str, now: str,
              max_rejected: float = IG.REJECT_THRESHOLD) -> DataFrame:
    out = out.rstrip("/")
    steps: list[tuple[str, str, int]] = []

    # 1. ingest: validate the review feed, land valid rows and rejects, write the batch report
    feed = PR.feed(spark, sf_dir).select("ordinal", "title", F.col("points").cast("string").alias("points"),
                                         "taster_name", "winery", "country", "variety", "price")
    valid, rejects, report = IG.ingest_batch(feed, "reseñas", "feed", day, threshold=max_rejected)
    rep = report.first()
    if rep.estado != "FALLIDA":
        K.land(valid, f"{out}/landing", "feed", day)
    K.land_rejects(rejects.drop("ordinal"), f"{out}/landing", "feed", day)
    K.write_report(report.withColumn("fecha", F.lit(day)), f"{out}/landing/_reportes")
    steps.append(("ingesta", rep.estado, int(rep.filas_cargadas)))
    schema = "paso string, estado string, filas long"
    if rep.estado == "FALLIDA":
        steps.append(("reporte", "DETENIDO", 0))
        return spark.createDataFrame(steps, schema)
    landed = spark.read.parquet(f"{out}/landing/resenas").filter((F.col("fuente") == "feed") & (F.col("fecha_ingesta") == day))

    # 2. gate 1 (staging suite over the validated batch)
    staging_res = Q.run_suite("staging", landed, [Q.expect_rows(1), Q.expect_not_null("title"),
                                                 Q.expect_between("points", 0, 100, 0.99)])
    Q.gate(staging_res)
    steps.append(("calidad_staging", "OK", staging_res.count()))

    # 3. transform + load: the warehouse stars, ordered refresh (dimensions first, then the fact)
    star = dict(PR.star(spark, sf_dir))
    rows = landed.select(F.col("ordinal").cast("long").alias("id_resena"))
    star["fact_resenas"] = star["fact_resenas"].join(rows, "id_resena", "left_semi")
    tables = K.refresh(star, f"{out}/warehouse")
    star = {n: spark.read.parquet(f"{out}/warehouse/{n}") for n in tables}
    biz = PB.biz(spark, sf_dir)
    steps.append(("carga", "OK", len(tables) + len(biz)))

    # 4. gate 2 (warehouse suites) and the quality seal
    wh = Q.union([Q.run_suite(name, df, checks) for name, df, checks in Q.warehouse_suites(spark, star)])
    per = Q.gate(wh)
    seal = spark.createDataFrame([("dw", True, now, 24.0)], "suite string, exito boolean, fecha string, "
                                                            "vigencia_horas double")
    K.append(seal, f"{out}/sellos")
    steps.append(("calidad_dw", "OK", per.count()))

    # 5. publish the serving aggregates (typed transport)
    a01 = A.review_kpis(star["fact_resenas"], star)
    a11 = B.daily_consolidation(biz)
    a08 = B.scorecard_kpis(biz, star["fact_resenas"])
    for name, df in (("kpis", a01), ("por_pais", A.by_country(star["fact_resenas"], star["dim_pais"])), ("reporte_diario", a11),
                     ("scorecard", a08)):
        K.publish(df, [(f.name, f.dataType.simpleString()) for f in df.schema.fields]) \
            .write.mode("overwrite").parquet(f"{out}/serving/{name}")
    steps.append(("publicacion", "OK", 4))

    # 6. gated inference: predictions (upsert by run and entity) and signals onto the bus
    status = Q.seal_status(spark.read.parquet(f"{out}/sellos"), now, "dw")
    latest = B.latest_period(biz["dim_tiempo"])

    def infer():
        feats = M.churn_features(biz["fact_retencion"], biz["fact_uso_plataforma"], biz["dim_cliente"],
                                 biz["dim_mercado"], biz["dim_plan"], latest)
        scored = M.score_churn(feats, latest)
        prices = M.price_recommendations(A.pricing_base(star["fact_resenas"], star["dim_variedad"], 200, 12))
        anomalies = M.detect_anomalies(B.anomaly_series(biz))
        preds = AL.churn_predictions(scored, latest, day).unionByName(AL.price_predictions(prices, latest, day), allowMissingColumns=True)
        sigs = (AL.churn_signals(scored, latest, day).unionByName(AL.price_signals(prices, latest, day))
                .unionByName(AL.anomaly_signals(anomalies, day)))
        preds = K.upsert(spark, f"{out}/predicciones", preds, ["corrida", "id_entidad"])
        bus = K.read_versioned(spark, f"{out}/senales")
        K.write_version(spark, f"{out}/senales", AL.emit_signals(bus, sigs))
        return preds, sigs
    run = CT.run_inference(spark, status, infer, f"ml-{day}").first()
    steps.append(("inferencia", run.estado, int(run.predicciones)))

    # 7. alerts: drain the unprocessed signals into the alert table, mark them processed
    bus = K.read_versioned(spark, f"{out}/senales")
    if bus is not None:
        alerts, processed = AL.group_alerts(bus, K.read_versioned(spark, f"{out}/alertas"), f"{day} 06:00:00")
        alerts = K.write_version(spark, f"{out}/alertas", alerts)
        K.write_version(spark, f"{out}/senales", processed)
        steps.append(("alertas", "OK", alerts.count()))

    # 8. daily report, archived by date
    doc = RP.daily_report(a11, a01, a08, day, seal_ok=status.first().ok)
    K.write_report(doc, f"{out}/reportes")
    steps.append(("reporte", doc.first().estado, 1))
    return spark.createDataFrame(steps, schema)
