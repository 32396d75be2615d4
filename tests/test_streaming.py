from datetime import datetime, timedelta

from pyspark.sql import functions as F

from terroir import streaming as ST


def test_ingest_stream(spark, tmp):
    recs = spark.createDataFrame([("V1", "90", "Ana", "B1"), ("V1", "91", "Ana", "B1"), ("V2", "95", "Beto", "B2"),
                                  ("V3", "50", "Caro", "B3")] + [(f"W{i}", "90", "Ana", "B") for i in range(40)],
                                 "title string, points string, taster_name string, winery string")
    recs.coalesce(1).write.json(f"{tmp}/landing")
    q = ST.ingest_stream(spark, f"{tmp}/landing", recs.schema, "reseñas", "src1", f"{tmp}/out", name=f"ing-{id(tmp)}")
    q.awaitTermination()
    rep = spark.read.json(f"{tmp}/out/_reportes").first()
    assert (rep.filas_leidas, rep.filas_rechazadas, rep.filas_duplicadas, rep.estado) == (44, 1, 1, "PARCIAL")
    assert spark.read.parquet(f"{tmp}/out/reseñas").count() == 42
    assert spark.read.parquet(f"{tmp}/out/rejects").count() == 1


def test_event_facts_stream(spark, tmp):
    ev = spark.createDataFrame([(datetime(2026, 6, d, 10), "Pro", 10.0) for d in range(1, 10)],
                               "fecha timestamp, plan string, mrr_delta double")
    ev.write.parquet(f"{tmp}/ev")
    stream = spark.readStream.schema(ev.schema).parquet(f"{tmp}/ev")
    q = ST.write_daily_facts(spark, ST.event_facts_stream(stream, "fecha", ["plan"]), f"{tmp}/daily", f"d15-{id(tmp)}")
    q.awaitTermination()
    m = ST.month_facts(spark, f"{tmp}/daily").collect()
    # days older than the watermark (max - 2 days) are final and emitted
    assert m and m[0].id_tiempo == 202606 and m[0].eventos >= 6


def test_alert_stream_drains_into_versioned_table(spark, tmp):
    from terroir.operators.alerts import empty_signals
    from terroir.sinks import read_versioned
    schema = empty_signals(spark).drop("procesada").schema
    rows = [("ml", "churn", None, "c", "acme", "k1", 0.7, 0.42, 202606, "{}", datetime(2026, 6, 1, 10)),
            ("ml", "churn", None, "c", "acme", "k1", 0.8, 0.42, 202606, "{}", datetime(2026, 6, 1, 11)),
            ("ml", "precio", "", "c", "Malbec", "p1", 20.0, 10.0, 202606, "{}", datetime(2026, 6, 1, 10))]
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp}/bus")
    q = ST.alert_stream(spark, f"{tmp}/bus", schema, f"{tmp}/alerts", "2026-06-01 12:00:00", name=f"al-{id(tmp)}")
    q.awaitTermination()
    alerts = {r.clave: r for r in read_versioned(spark, f"{tmp}/alerts").collect()}
    # (origen, clave, id_tiempo) is the signal key: the repeat refreshes the signal, one occurrence
    assert set(alerts) == {"k1", "p1"} and alerts["k1"].severidad == "critical"
    assert alerts["p1"].responsable == "Ingeniería de datos"


def test_signal_keys_are_bounded_and_late_signals_counted(spark, tmp):
    from terroir.operators.alerts import empty_signals
    from terroir.sinks import read_versioned
    schema = empty_signals(spark).drop("procesada").schema

    def emit(key, day, period=202606):
        return ("ml", "churn", None, "c", "acme-" + key, key, 0.7, 0.42, period, "{}", datetime(2026, 6, 1, 10) + timedelta(days=day))
    files = [[emit("k1", 0), emit("k1", 1), emit("k2", 1)], [emit("k1", 2), emit("k3", 30)], [emit("late", 1), emit("k4", 60)], [emit("k5", 90)]]
    seen = []
    for rows in files:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp}/bus")
        q = ST.alert_stream(spark, f"{tmp}/bus", schema, f"{tmp}/alerts", "2026-06-01 12:00:00", name=f"keys-{id(tmp)}", repeats_within="10 days")
        q.awaitTermination()
        seen.append((ST.kept_keys(q), ST.late_rows(q)))
    got = {r.clave: r.ocurrencias for r in read_versioned(spark, f"{tmp}/alerts").collect()}
    assert got == {"k1": 1, "k2": 1, "k3": 1, "k4": 1, "k5": 1}
    assert max(k for k, _ in seen) <= 3 and seen[-1][0] <= 2   # keys behind the watermark are gone
    assert sum(n for _, n in seen) == 1                       # the late one
