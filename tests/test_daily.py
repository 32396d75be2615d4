"""End-to-end daily batch job at sf0.001, run twice (idempotence)."""
from terroir import sinks as K
from terroir.plans.daily import run_daily

SF = "/root/testdata/sf0.001"


def test_daily_job_twice(spark, tmp):
    stopped = {r.paso: r.estado for r in run_daily(spark, SF, f"{tmp}/x", "2024-02-01", "2024-02-01 05:00:00").collect()}
    assert stopped == {"ingesta": "FALLIDA", "reporte": "DETENIDO"}                 # about a quarter is out of range
    run = lambda: run_daily(spark, SF, tmp, "2024-02-01", "2024-02-01 05:00:00", max_rejected=0.5)
    first = {r.paso: (r.estado, r.filas) for r in run().collect()}
    assert first["ingesta"][0] == "PARCIAL"
    assert spark.read.parquet(f"{tmp}/warehouse/fact_resenas").count() == first["ingesta"][1]
    assert first["inferencia"][0] == "COMPLETADA" and first["reporte"][0] == "PUBLICADO"
    preds = K.read_bucketed(spark, f"{tmp}/predicciones").count()
    alerts1 = sorted((r.clave, r.ocurrencias) for r in K.read_versioned(spark, f"{tmp}/alertas").collect())
    second = {r.paso: (r.estado, r.filas) for r in run().collect()}
    assert second["inferencia"] == first["inferencia"]
    assert K.read_bucketed(spark, f"{tmp}/predicciones").count() == preds          # upsert, not append
    alerts2 = sorted((r.clave, r.ocurrencias) for r in K.read_versioned(spark, f"{tmp}/alertas").collect())
    # signals re-emitted for the same key refresh the bus and group into the live alerts
    assert [c for c, _ in alerts2] == [c for c, _ in alerts1]
    assert spark.read.json(f"{tmp}/reportes").count() == 1                          # overwrite by date
