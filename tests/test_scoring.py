from datetime import date

from pyspark.sql import functions as F

from terroir.operators import scoring as M
from terroir.operators.windows import quintile, zscore


def test_quintile_case45(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(1, 8)], "id int, v double")
    out = [r.q for r in quintile(df, "v", "id", "q").orderBy("v").collect()]
    assert out == [1, 1, 2, 3, 4, 5, 5]


def test_quintile_matches_qcut_rank_first(spark):
    import pandas as pd
    for n in (5, 9, 23, 57):
        vals = [(i * 7919) % 101 for i in range(n)]
        df = spark.createDataFrame(list(enumerate(vals)), "id int, v int")
        got = [r.q for r in quintile(df, "v", "id", "q").orderBy("id").collect()]
        s = pd.Series(vals)
        exp = pd.qcut(s.rank(method="first"), 5, labels=[1, 2, 3, 4, 5]).astype(int).tolist()
        assert got == exp, n


def test_anomalies_case46(spark):
    const = [("s", 200000 + i, f"p{i}", 5.0) for i in range(6)]
    short = [("t", 200000 + i, f"p{i}", float(i)) for i in range(3)]
    spike = [("u", 200000 + i, f"p{i}", v) for i, v in enumerate([1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 50.0])]
    df = spark.createDataFrame(const + short + spike, "serie string, id_tiempo int, periodo string, valor double")
    out = M.detect_anomalies(df).collect()
    assert all(r.z == 0.0 for r in out if r.serie == "s")
    assert not any(r.serie == "t" for r in out)
    hits = [r for r in out if r.anomalia]
    assert len(hits) == 1 and hits[0].tipo == "pico"


def test_price_projection_case47(spark):
    df = spark.createDataFrame([("v", "2010", 10.0), ("v", "2011", 12.0), ("v", "2012", 15.0), ("w", "2010", 3.0)],
                               "variedad string, anio string, precio_promedio double")
    out = {(r.variedad, r.anio): r for r in M.price_projection(df).collect()}
    assert out[("v", 2013)].precio_proyectado == 17.33 and out[("v", 2014)].precio_proyectado == 19.83
    assert out[("v", 2013)].pendiente == 2.5
    assert not any(k[0] == "w" for k in out)


def test_churn_score_small(spark):
    f = spark.createDataFrame([(1, "a", "t", "CL", "Trial", date(2026, 5, 1), 0.5, 100.0, 0, 0, None, None),
                               (2, "b", "t", "CL", "Enterprise", date(2020, 1, 1), 0.05, 50.0, 9, 10, 150, 10)],
                              "id_cliente int, nombre string, tipo string, pais string, plan string, fecha_alta date, "
                              "riesgo_churn double, ltv double, usuarios_activos int, usuarios_totales int, "
                              "sesiones int, nps_score int")
    out = {r.id_cliente: r for r in M.score_churn(f, 202606).collect()}
    # a: adoption .6 default → .4*.22 + (1-40/150)*.15 + .5*.13 + .85*.15 + (1-1/12)*.10 + .5*.25
    exp = 0.4 * 0.22 + (1 - 40 / 150) * 0.15 + 0.5 * 0.13 + 0.85 * 0.15 + (1 - 1 / 12) * 0.10 + 0.5 * 0.25
    assert out[1].score == round(exp, 3) and out[1].nivel == "Alto"
    assert out[2].nivel == "Bajo"
    assert out[1].factor == "plan inicial" or out[1].factor == "señal histórica"


def test_price_recommendations(spark):
    b = spark.createDataFrame([("a", 300, 20.0, 90.0), ("b", 100, 20.0, 86.0)],
                              "variedad string, demanda long, precio_prom double, puntos_prom double")
    out = {r.variedad: r for r in M.price_recommendations(b).collect()}
    # mean n = 200, mean points = 88: a → (1.5-1)*.06 + 2*.015 = .06
    assert out["a"].ajuste_pct == 6.0 and out["a"].accion == "Subir precio"
    assert out["b"].ajuste_pct == -6.0 and out["b"].accion == "Bajar precio"


def test_quintiles_one_pass_equals_separate(spark):
    from terroir.operators.windows import quintiles
    rows = [(i, float((i * 37) % 11), float((i * 53) % 7)) for i in range(23)]
    df = spark.createDataFrame(rows, "id int, a double, b double")
    one = {r.id: (r.A, r.B) for r in quintiles(df, {"A": "a", "B": "b"}, "id").collect()}
    sep = {r.id: (r.A, r.B) for r in quintile(quintile(df, "a", "id", "A"), "b", "id", "B").collect()}
    assert one == sep
