from datetime import datetime

import pytest
from pyspark.sql import functions as F

from terroir.operators import catalog as CT
from terroir.operators import search as S
from terroir.operators.quality import seal_status
from terroir.operators.report import daily_report


def seals(spark, rows):
    return spark.createDataFrame(rows, "suite string, exito boolean, fecha string, vigencia_horas double")


def subs(spark):
    return spark.createDataFrame([("acme", "s1", "ACTIVA", datetime(2026, 1, 1))],
                                 "cuenta string, suscripcion string, estado string, fecha timestamp")


def test_publication_versions_case23(spark):
    d = lambda h: datetime(2026, 6, 1, h)
    req = spark.createDataFrame([("d1", "acme", "acme", "publicar", d(10), 1), ("d1", "acme", "acme", "publicar", d(11), 2)],
                                "dashboard string, cuenta string, propietario string, accion string, fecha timestamp, seq int")
    s = seals(spark, [("dw", True, "2026-06-01 09:00:00", 24.0)])
    out = {r.seq: (r.veredicto, r.version, r.estado_version) for r in CT.publication_verdicts(req, s, subs(spark)).collect()}
    assert out[1] == ("aceptada", 1, "REEMPLAZADA") and out[2] == ("aceptada", 2, "ACTIVA")
    req2 = req.unionByName(spark.createDataFrame([("d1", "acme", "acme", "despublicar", d(12), 3)], req.schema))
    out2 = {r.seq: r.estado_version for r in CT.publication_verdicts(req2, s, subs(spark)).collect()}
    assert out2[2] == "DESPUBLICADO"


def test_publication_version_after_unpublish(spark):
    d = lambda h: datetime(2026, 6, 1, h)
    acts = ["publicar", "despublicar", "publicar", "listo", "publicar", "publicar", "despublicar", "despublicar"]
    req = spark.createDataFrame([("d1", "acme", "acme", a, d(10 + i), i) for i, a in enumerate(acts)],
                                "dashboard string, cuenta string, propietario string, accion string, fecha timestamp, seq int")
    s = seals(spark, [("dw", True, "2026-06-01 09:00:00", 24.0), ("dw", False, "2026-05-31 09:00:00", 240.0)])
    out = sorted((r.seq, r.veredicto, r.version, r.estado_version) for r in CT.publication_verdicts(req, s, subs(spark)).collect())
    assert out == [(0, "aceptada", 1, "DESPUBLICADO"), (1, "aceptada", None, None), (2, "estado_invalido", None, None),
                   (3, "aceptada", None, None), (4, "aceptada", 1, "REEMPLAZADA"), (5, "aceptada", 2, "DESPUBLICADO"),
                   (6, "aceptada", None, None), (7, "publicacion_inexistente", None, None)]


def test_publication_gate_tenant_and_seal_case24(spark):
    d = lambda h: datetime(2026, 6, 1, h)
    req = spark.createDataFrame([("d1", "acme", "otro", "publicar", d(10), 1), ("d2", "acme", "acme", "publicar", d(8), 2)],
                                "dashboard string, cuenta string, propietario string, accion string, fecha timestamp, seq int")
    s = seals(spark, [("dw", True, "2026-06-01 09:00:00", 24.0)])
    out = {r.seq: r.veredicto for r in CT.publication_verdicts(req, s, subs(spark)).collect()}
    assert out[1] == "fuga_multitenant" and out[2] == "sin_sello_calidad"   # seal is newer than the request
    df = spark.createDataFrame([("acme", 1), ("otro", 2)], "cliente string, v int")
    with pytest.raises(S.TenantError):
        S.tenant_scope(df, "acme", {"cliente": "otro"})
    assert S.tenant_scope(df, "acme").count() == 1


def test_gated_inference_case20(spark):
    none = seal_status(seals(spark, [("x", True, "2026-06-01 00:00:00", 24.0)]), "2026-06-01 01:00:00", "dw")
    run = CT.run_inference(spark, none, lambda: (_ for _ in ()).throw(AssertionError("must not run")), "r1").first()
    assert run.estado == "BLOQUEADA_POR_CALIDAD" and run.predicciones == 0
    ok = seal_status(seals(spark, [("dw", True, "2026-06-01 00:00:00", 24.0)]), "2026-06-01 01:00:00", "dw")
    one = spark.range(3)
    run = CT.run_inference(spark, ok, lambda: (one, one.limit(1)), "r2").first()
    assert (run.estado, run.predicciones, run.senales) == ("COMPLETADA", 3, 1)
    bad = CT.run_inference(spark, ok, lambda: 1 / 0, "r3").first()
    assert bad.estado == "FALLIDA"


def test_resolve_fk_modes(spark):
    df = spark.createDataFrame([("Italy",), ("",)], "country string")
    dim = spark.createDataFrame([(1, "Italy"), (2, "Desconocido")], "id_pais int, nombre string")
    assert CT.resolve_fk(df, dim, "country", "id_pais").count() == 1
    assert sorted(r.id_pais for r in CT.resolve_fk(df, dim, "country", "id_pais", "member").collect()) == [1, 2]
    assert CT.resolve_fk(df, dim, "country", "id_pais", "null").filter("id_pais IS NULL").count() == 1


def test_resolve_catalog_case41(spark):
    cat = spark.createDataFrame([(1, "pago", "Pago"), (2, "organico", "Orgánico")], "id_canal int, codigo string, nombre string")
    df = spark.createDataFrame([("PAGO",), ("Orgánico",), ("2",), ("tv",)], "ref string")
    out = {r.ref: (r.id_canal, r.error) for r in CT.resolve_catalog(df, "ref", cat, "id_canal",
                                                                      ["codigo", "nombre", "id_canal"],
                                                                      "canal_inexistente").collect()}
    assert out == {"PAGO": (1, None), "Orgánico": (2, None), "2": (2, None), "tv": (None, "canal_inexistente")}


def test_reload_validates_first(spark, tmp):
    from terroir.sources import readers as RD
    cols = ", ".join(f"{c} string" for c in RD.CONTRACT_COLUMNS)
    spark.createDataFrame([("s", "u", "2024-01-01T00:00:00Z", "1", "click", "p", "c", "b", "x", "web", "d", "n", "o",
                            "", "3", "", "0", "1")], cols).write.option("header", True).csv(f"{tmp}/bad")
    spark.range(2).write.parquet(f"{tmp}/target")
    with pytest.raises(RD.ContractError):
        CT.reload(spark, f"{tmp}/bad", f"{tmp}/target")
    assert spark.read.parquet(f"{tmp}/target").count() == 2      # untouched


def test_daily_report_case26_27(spark):
    a11 = spark.createDataFrame([(202606, "2026-06", 48211, 1)], "id_tiempo int, periodo string, api_llamadas long, incidentes int")
    a01 = spark.createDataFrame([(7, 88.0)], "total_resenas long, puntuacion_promedio double")
    a08 = spark.createDataFrame([("2026-06", 99.5)], "periodo string, calidad double")
    r1 = daily_report(a11, a01, a08, "2026-06-30").first()
    r2 = daily_report(a11, a01, a08, "2026-06-30").first()
    assert r1.estado == "PUBLICADO" and r1.secciones == 4 and r1.documento == r2.documento
    assert '"api_llamadas":48211' in r1.documento
    empty = daily_report(a11.limit(0), a01, a08, "2026-06-30").first()
    assert empty.estado == "FALLIDO"
    blocked = daily_report(a11, a01, a08, "2026-06-30", seal_ok=False).first()
    assert blocked.estado == "BLOQUEADO_SIN_CALIDAD" and blocked.documento is None


def test_search_page_and_total(spark):
    rows = spark.createDataFrame([(i, "t", "CL" if i % 2 else "AR", "v", "b", 80 + i % 20, float(i)) for i in range(50)],
                                 "id_resena long, title string, pais string, variedad string, bodega string, "
                                 "points int, price double")
    got, total, pages = S.search_page_and_total(rows, {"country": "CL", "min_points": 85}, page_no=2, per_page=5)
    exp = sorted([r for r in rows.collect() if r.pais == "CL" and r.points >= 85], key=lambda r: (-r.points, r.id_resena))
    assert total == len(exp) and pages == -(-len(exp) // 5)
    assert [r.id_resena for r in got] == [r.id_resena for r in exp[5:10]]
