import pytest
from pyspark.sql import functions as F

from terroir.operators import quality as Q


def test_suite_single_aggregate_and_gate(spark):
    df = spark.createDataFrame([(1, 90, "a"), (2, 70, "b"), (2, None, "z")], "id int, points int, cat string")
    dim = spark.createDataFrame([(1,)], "id int")
    res = Q.run_suite("d", df, [Q.expect_rows(1), Q.expect_not_null("points"), Q.expect_between("points", 80, 100),
                                Q.expect_in("cat", ["a", "b"]), Q.expect_unique("id"), Q.expect_fk("id", dim, "id"),
                                Q.expect_column("missing")])
    out = {r.expectativa: (r.evaluadas, r.fallidas, r.exito) for r in res.collect()}
    assert out["not_null:points"] == (3, 1, False)
    assert out["between:points"] == (2, 1, False)
    assert out["in_set:cat"] == (3, 1, False)
    assert out["unique:id"][1] == 2
    assert out["fk:id"][1] == 2          # every orphan row counts (dbt relationships)
    assert out["column:missing"][2] is False
    with pytest.raises(Q.QualityGateError):
        Q.gate(res)


def test_mostly(spark):
    df = spark.createDataFrame([(i,) for i in range(100)], "p int")
    ok = Q.run_suite("d", df, [Q.expect_between("p", 0, 98, mostly=0.99)]).first()
    assert ok.exito is True
    lazy = Q.suite_plan("d", df, [Q.expect_between("p", 0, 98, mostly=0.99)]).first()
    assert (lazy.evaluadas, lazy.fallidas, lazy.exito) == (100, 1, True)


def test_seal_status_case22(spark):
    seals = spark.createDataFrame([("dw", True, "2026-06-01 00:00:00", 24.0), ("dw", False, "2026-06-02 00:00:00", 24.0),
                                   ("st", True, "2026-06-01 00:00:00", 24.0)],
                                  "suite string, exito boolean, fecha string, vigencia_horas double")
    now = "2026-06-03 00:00:00"
    assert Q.seal_status(seals, now, "dw").first().motivo == "fallido"
    assert Q.seal_status(seals, now, "st").first().motivo == "vencido"
    assert Q.seal_status(seals, now, "none").first().motivo == "sin_sello"
    fresh = Q.seal_status(seals, "2026-06-01 12:00:00", "st").first()
    assert fresh.ok is True
