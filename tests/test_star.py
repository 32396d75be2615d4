from pyspark.sql import functions as F

from terroir.operators import star as D

COLS = ("country description designation points price province region_1 region_2 taster_name "
        "taster_twitter_handle title variety winery").split()


def reviews(spark, n=60, blank_region_at=None):
    rows = []
    for i in range(n):
        rows.append(("Italy", "x", "", 85 + i % 10, float(10 + i), "p", "" if i == blank_region_at else "r", "",
                     f"T{i % 7}", "@x", f"Vino {i}", "Red Blend", f"B{i % 5}", i + 1))
    schema = ", ".join(f"{c} {'int' if c == 'points' else 'double' if c == 'price' else 'string'}" for c in COLS)
    return spark.createDataFrame(rows, schema + ", ordinal long")


def test_star_case7(spark):
    s = D.review_star(reviews(spark))
    assert s["dim_catador"].count() == 7
    assert s["dim_bodega"].count() == 5
    f = s["fact_resenas"]
    assert f.count() == 60
    assert f.select("id_resena").distinct().count() == 60
    # first appearance order: T0 first, B0 first
    assert s["dim_catador"].filter("nombre = 'T0'").first().id_catador == 1
    assert s["dim_bodega"].filter("nombre = 'B3'").first().id_bodega == 4


def test_blank_region_drops_row_case8(spark):
    s = D.review_star(reviews(spark, blank_region_at=4))
    names = [r.nombre for r in s["dim_region"].collect()]
    assert "Desconocido" in names
    f = s["fact_resenas"]
    assert f.count() == 59
    assert f.filter("id_resena = 5").count() == 0   # ids keep their gaps


def test_blank_taster_is_anonymous(spark):
    df = reviews(spark, n=3).withColumn("taster_name", F.when(F.col("ordinal") == 2, "").otherwise(F.col("taster_name")))
    s = D.review_star(df)
    assert s["dim_catador"].filter("nombre = 'Anónimo'").count() == 1
    assert s["fact_resenas"].count() == 3


def test_all_dims_single_pass_equals_separate(spark):
    clean = D.clean_reviews(reviews(spark))
    stacked = D.build_all_dims(clean)
    for name, src, id_col in D.DIM_SPECS:
        a = sorted(tuple(r) for r in D.dim_table(stacked, name).collect())
        b = sorted(tuple(r) for r in D.build_dim(clean, src, id_col).collect())
        assert a == b


def test_month_dim(spark):
    d = D.month_dim(spark.createDataFrame([(202602,), (202611,)], "id_tiempo int")).orderBy("id_tiempo").collect()
    assert (d[0].trimestre, d[0].mes_nombre, d[0].periodo) == (1, "Febrero", "2026-02")
    assert (d[1].trimestre, d[1].mes_nombre) == (4, "Noviembre")
