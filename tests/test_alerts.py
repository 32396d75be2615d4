from datetime import datetime

from pyspark.sql import functions as F

from terroir.operators import alerts as AL
from terroir.operators import lifecycle as L


def sig(spark, rows):
    return spark.createDataFrame(
        [(o, t, s, "c", e, k, v, u, p, "{}", datetime(2026, 6, 1, 10, i), False)
         for i, (o, t, s, e, k, v, u, p) in enumerate(rows)],
        "origen string, tipo string, severidad string, causa string, entidad string, clave string, valor double, "
        "umbral double, id_tiempo int, payload string, fecha timestamp, procesada boolean")


def test_classify_case15_16(spark):
    s = sig(spark, [("ml", "churn", None, "acme", "churn:acme:202606", 0.71, 0.42, 202606),
                    ("ml", "precio", "", "Malbec", "precio:Malbec:202606", 20.0, 10.0, 202606),
                    ("x", "otro", None, "e", "o:1", 1.0, 1.0, 202606)])
    out = {r.tipo: (r.severidad, r.responsable) for r in AL.classify(s).collect()}
    assert out["churn"] == ("critical", "Customer Success")
    assert out["precio"] == ("warning", "Ingeniería de datos")
    assert out["otro"] == ("warning", "DevOps")


def test_grouping_case17_and_repeat(spark):
    s = sig(spark, [("ml", "churn", None, "acme", "k1", 0.71, 0.42, 202606),
                    ("ml", "churn", None, "acme", "k1", 0.75, 0.42, 202606)])
    alerts, processed = AL.group_alerts(s, None, "2026-06-01 12:00:00")
    rows = alerts.collect()
    assert len(rows) == 1 and rows[0].ocurrencias == 2 and rows[0].estado == "ABIERTA" and rows[0].valor == 0.75
    assert processed.filter("procesada").count() == 2
    # a second drain of the same key groups into the live alert
    again, _ = AL.group_alerts(sig(spark, [("ml", "churn", None, "acme", "k1", None, 0.42, 202606)]), alerts,
                               "2026-06-02 12:00:00")
    r = again.collect()
    assert len(r) == 1 and r[0].ocurrencias == 3 and r[0].valor == 0.75


def test_closed_alert_then_new_case18(spark):
    s = sig(spark, [("ml", "churn", None, "acme", "k1", 0.71, 0.42, 202606)])
    alerts, _ = AL.group_alerts(s, None, "2026-06-01 12:00:00")
    closed = alerts.withColumn("estado", F.lit("RESUELTA"))
    again, _ = AL.group_alerts(s, closed, "2026-06-03 12:00:00")
    states = sorted(r.estado for r in again.collect())
    assert states == ["ABIERTA", "RESUELTA"]


def test_any_alert_move_is_accepted(spark):
    d = lambda i: datetime(2026, 6, 1, 10, i)
    alerts = spark.createDataFrame([("a1", "ABIERTA", None), ("a2", "ABIERTA", None)], "alerta string, estado string, ultima_vez timestamp")
    moves = spark.createDataFrame([("a1", "RESUELTA", d(1), 1), ("a1", "RECONOCIDA", d(2), 2), ("zz", "RESUELTA", d(1), 3)],
                                  "alerta string, estado_solicitado string, fecha timestamp, seq int")
    after, unknown = L.alert_moves(alerts, moves)
    assert {r.alerta: (r.estado, r.ultima_vez, r.movimientos) for r in after.collect()} == {"a1": ("RECONOCIDA", d(2), 2), "a2": ("ABIERTA", None, 0)}
    assert [(r.alerta, r.motivo) for r in unknown.collect()] == [("zz", "alerta_inexistente")]


def test_emit_signals_keeps_processed(spark):
    s = sig(spark, [("ml", "churn", None, "acme", "k1", 0.71, 0.42, 202606)]).withColumn("procesada", F.lit(True))
    again = AL.emit_signals(s, sig(spark, [("ml", "churn", None, "acme", "k1", 0.80, 0.42, 202606)]).drop("procesada"))
    r = again.collect()
    assert len(r) == 1 and r[0].procesada is True and r[0].valor == 0.80


def probes(spark, rows):
    return spark.createDataFrame(rows, "servicio string, intentos int, exitosos int, latencias array<double>")


def test_probe_consolidation_case11(spark):
    m = AL.consolidate_probes(probes(spark, [("a", 3, 3, [10.0, 12.0, 14.0]), ("b", 3, 3, [20.0, 20.0, 20.0])])).first()
    assert (m.uptime, m.latencia_ms, m.incidentes) == (100.0, 16.0, 0)


def test_slo_signals_case12_13(spark):
    ok = spark.createDataFrame([("CL", 100.0, 30.0, 202606), ("AR", 100.0, 30.0, 202606)],
                               "region string, uptime double, latencia_ms double, id_tiempo int")
    assert AL.slo_signals(ok, "2026-06-01 00:00:00", ["region"]).count() == 0
    bad = spark.createDataFrame([("CL", 33.333, 350.0, 202606), ("AR", 33.333, 350.0, 202606)],
                                "region string, uptime double, latencia_ms double, id_tiempo int")
    out = AL.slo_signals(bad, "2026-06-01 00:00:00", ["region"]).collect()
    assert sorted((r.tipo, r.entidad) for r in out) == [("latencia", "AR"), ("latencia", "CL"), ("uptime", "AR"),
                                                         ("uptime", "CL")]


def test_incidents_case14(spark):
    r = AL.incidents(probes(spark, [("Chile", 4, 0, [])])).first()
    assert (r.severidad, r.estado, r.duracion_min) == ("critical", "ABIERTO", 30.0)


def test_availability_rows_replace_period(spark):
    metric = spark.createDataFrame([(99.5, 120.0, 1)], "uptime double, latencia_ms double, incidentes int")
    regions = spark.createDataFrame([(1,), (2,)], "id_mercado int")
    rows = AL.availability_rows(metric, regions, 202606).collect()
    assert sorted(r.id_disponibilidad for r in rows) == [202606001, 202606002]


def test_acquisition_and_conversion_drop_case39_40(spark):
    ev = spark.createDataFrame([(202606, 1000.0)], "id_tiempo int, gasto double")
    leads = spark.createDataFrame([(202606, "L1", False), (202606, "L2", False)], "id_tiempo int, clave string, duplicado boolean")
    conv = spark.createDataFrame([(202606, "L1", "CLIENTE")], "id_tiempo int, lead string, etapa string")
    ind = AL.acquisition_indicators(ev, leads, conv)
    r = ind.first()
    assert (r.tasa_conversion, r.cac) == (50.0, 1000.0)
    leads3 = spark.createDataFrame([(202606, f"L{i}", False) for i in range(3)], "id_tiempo int, clave string, duplicado boolean")
    none = spark.createDataFrame([], "id_tiempo int, lead string, etapa string")
    drop = AL.conversion_drop(AL.acquisition_indicators(ev, leads3, none), "2026-06-30 00:00:00").collect()
    assert len(drop) == 1 and AL.CLASSIFICATION[drop[0].tipo][1] == "Growth & Marketing"


def test_retention_case32_and_support_case33(spark):
    alerts = spark.createDataFrame([("churn", "acme", "churn:acme:1", "ABIERTA")], "tipo string, entidad string, clave string, estado string")
    first = AL.retention_actions(alerts)
    assert first.count() == 1 and first.first().prioridad == "alta"
    assert AL.retention_actions(alerts, first).count() == 0
    t = spark.createDataFrame([("acme", "CERRADO", 60.0, 5.0, "8")],
                              "cuenta string, estado string, minutos_resolucion double, "
                              "minutos_primera_respuesta double, nps string")
    r = AL.support_report(t).first()
    assert (r.tickets, r.resolucion_media_min, r.nps_medio, r.respuestas_nps) == (1, 60.0, 8.0, 1)


def test_predictions_and_signals_case19(spark):
    top = spark.createDataFrame([(1, "acme", 0.71, "Alto", 71.0, "Trial", "CL", 10.0, "NPS bajo", 100.0, "x"),
                                 (2, "beta", 0.12, "Bajo", 12.0, "Enterprise", "AR", 80.0, "poco uso", 50.0, "y")],
                                "id_cliente int, nombre string, score double, nivel string, probabilidad double, "
                                "plan string, pais string, adopcion double, factor string, ltv double, accion string")
    recs = spark.createDataFrame([("Malbec", 300, 20.0, 90.0, 24.4, 22.0, "Subir precio"),
                                  ("Syrah", 250, 20.0, 88.0, 20.4, 2.0, "Mantener")],
                                 "variedad string, demanda long, precio_actual double, puntos double, "
                                 "precio_recomendado double, ajuste_pct double, accion string")
    preds = AL.churn_predictions(top, 202606, "2026-06-30").unionByName(
        AL.price_predictions(recs, 202606, "2026-06-30"), allowMissingColumns=True)
    sigs = AL.churn_signals(top, 202606, "2026-06-30").unionByName(AL.price_signals(recs, 202606, "2026-06-30"))
    assert preds.count() == 4
    assert sorted(r.tipo for r in sigs.collect()) == ["churn", "precio"]
