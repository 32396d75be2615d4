import os

import pytest
from pyspark.sql import functions as F

from terroir import sinks as K
from terroir.sources import readers as RD


def test_contract_csv_errors(spark, tmp):
    good = spark.createDataFrame([("s", "u", "2024-01-01T00:00:00Z", "1", "click", "p", "c", "b", "1.5", "web",
                                   "desktop", "norte", "pago", "", "3", "", "0", "1")], ", ".join(
        f"{c} string" for c in RD.CONTRACT_COLUMNS))
    good.write.option("header", True).csv(f"{tmp}/good")
    rows = RD.read_contract_csv(spark, f"{tmp}/good").collect()
    assert rows[0].drop_off_flag is True and rows[0].price == 1.5 and rows[0].time_spent_sec is None
    good.withColumn("is_conversion", F.lit("yes")).write.option("header", True).csv(f"{tmp}/bad")
    with pytest.raises(RD.ContractError, match="is_conversion"):
        RD.read_contract_csv(spark, f"{tmp}/bad")
    good.drop("region").write.option("header", True).csv(f"{tmp}/missing")
    with pytest.raises(RD.ContractError, match="region"):
        RD.read_contract_csv(spark, f"{tmp}/missing")
    good.limit(0).write.option("header", True).csv(f"{tmp}/empty")
    with pytest.raises(RD.ContractError):
        RD.read_contract_csv(spark, f"{tmp}/empty")


def test_reviews_csv_and_normalise(spark, tmp):
    p = os.path.join(tmp, "r.csv")
    with open(p, "w") as fh:
        fh.write('Unnamed: 0, Country ,title,points,price,description\n0,Italy,"Vino, A",abc,12.345,"long"\n')
    out = RD.read_reviews_csv(spark, p).first()
    assert out.country == "Italy" and out.title == "Vino, A" and out.points == 0 and out.price == 12.35
    assert out.winery == "" and "unnamed: 0" not in RD.read_reviews_csv(spark, p).columns


def test_registry_case9_10(spark):
    reg = spark.createDataFrame([("", "x", "z", "", "diaria")], "nombre string, tipo string, formato string, "
                                "endpoint string, frecuencia string")
    assert len(RD.validate_registry(reg).first().errores) >= 4
    existing = spark.createDataFrame([(7, "reseñas", "http://a", "csv", "HABILITADA")],
                                     "id int, tipo string, endpoint string, formato string, estado string")
    inc = spark.createDataFrame([("reseñas", "http://a", "csv"), ("precios", "http://b", "json")],
                                "tipo string, endpoint string, formato string")
    out = {r.endpoint: (r.estado, r.id_existente) for r in RD.register_sources(existing, inc).collect()}
    assert out["http://a"] == ("DUPLICADA", 7) and out["http://b"] == ("REGISTRADA", None)
    assert RD.enabled(existing).count() == 1


def test_serving_fallback_case25(spark, tmp):
    spark.createDataFrame([], "total long").write.parquet(f"{tmp}/serving")
    fb = lambda: spark.createDataFrame([(7,)], "total long")
    r = RD.read_serving(spark, f"{tmp}/serving", fb).first()
    assert (r.total, r.fuente) == (7, "warehouse")


def test_land_idempotent_case6(spark, tmp):
    df = spark.createDataFrame([("Ana", "V1", "B"), ("Ana", "V1", "B"), ("Beto", "V2", "B"), ("Caro", "V3", "B")],
                               "taster_name string, title string, winery string").dropDuplicates()
    for _ in range(2):
        out = K.land(df, tmp, "rec0001", "2026-06-29")
    back = spark.read.parquet(out)
    assert back.count() == 3
    assert os.path.isdir(os.path.join(out, "fuente=rec0001", "fecha_ingesta=2026-06-29"))


def test_upsert_and_insert_absent(spark, tmp):
    t = spark.createDataFrame([("k1", 1, True)], "clave string, v int, procesada boolean")
    K.upsert(spark, f"{tmp}/u", t, ["clave"])
    src = spark.createDataFrame([("k1", 2, False), ("k2", 3, False)], "clave string, v int, procesada boolean")
    out = {r.clave: (r.v, r.procesada) for r in K.upsert(spark, f"{tmp}/u", src, ["clave"], ["procesada"]).collect()}
    assert out == {"k1": (2, True), "k2": (3, False)}
    new = K.insert_absent(t, src, ["clave"])
    assert [r.clave for r in new.collect()] == ["k2"]


def test_upsert_leaves_other_buckets_alone(spark, tmp):
    path = f"{tmp}/b"
    t = spark.createDataFrame([(i, 0, 1) for i in range(200)], "clave long, v long, corrida int")
    assert K.read_bucketed(spark, path) is None
    K.upsert(spark, path, t, ["clave"], counter="corrida", buckets=16)
    before = {r[0] for r in K.read_bucketed(spark, path).select("_metadata.file_path").distinct().collect()}
    src = spark.createDataFrame([(7, 5, 1), (1000, 6, 1)], "clave long, v long, corrida int")
    out = K.upsert(spark, path, src, ["clave"], counter="corrida")
    after = {r[0] for r in out.select("_metadata.file_path").distinct().collect()}
    assert len(before) == 16 and len(before & after) >= 14 and len(after - before) <= 2
    got = {r.clave: (r.v, r.corrida) for r in out.collect()}
    assert got == {**{i: (0, 1) for i in range(200)}, 7: (5, 2), 1000: (6, 1)}
    for i in range(4):                                        # folders of dropped versions go, the table stays
        out = K.upsert(spark, path, spark.createDataFrame([(7, i, 1)], "clave long, v long, corrida int"), ["clave"], counter="corrida")
    assert out.count() == 201 and out.filter("clave = 7").first().corrida == 6
    assert len(os.listdir(f"{path}/data")) <= 1 + 1 + K.KEEP_VERSIONS


def test_publish_and_export(spark):
    df = spark.createDataFrame([(None, None, None)], "pais string, total long, avg double")
    r = K.publish(df, [("pais", "string"), ("total", "bigint"), ("avg", "double")]).first()
    assert (r.pais, r.total, r.avg) == ("", 0, 0.0)
    rows = spark.createDataFrame([(1, "t", "CL", "v", "b", "p", "r", "c", 90, 0.0), (2, "u", "CL", "v", "b", "p", "r", "c", 95, 12.5)],
                                 "id_resena long, title string, pais string, variedad string, bodega string, "
                                 "provincia string, region string, catador string, points int, price double")
    out = K.export_rows(rows, 10).collect()
    assert [r.precio for r in out] == ["12.50", ""] and out[0].puntos == 95
    assert K.export_rows(rows).count() == 2 and K.export_rows(rows, 1).count() == 1     # no cap of its own


def test_refresh_replace_period_archive_records(spark, tmp):
    dims = spark.createDataFrame([(1, "a")], "id int, nombre string")
    fact = spark.createDataFrame([(i, 1) for i in range(10)], "id_resena long, id int")
    order = K.refresh({"fact": fact, "dim_x": dims}, tmp)
    assert order[0] == "dim_x" and spark.read.parquet(f"{tmp}/fact").count() == 10
    p = f"{tmp}/disp"
    K.replace_period(spark.createDataFrame([(202605, 1), (202606, 2)], "id_tiempo int, v int"), p)
    K.replace_period(spark.createDataFrame([(202606, 9)], "id_tiempo int, v int"), p)
    got = sorted((r.id_tiempo, r.v) for r in spark.read.parquet(p).collect())
    assert got == [(202605, 1), (202606, 9)]
    rep = spark.createDataFrame([("2026-06-30", "PUBLICADO")], "fecha string, estado string")
    K.write_report(rep, f"{tmp}/rep")
    K.write_report(rep, f"{tmp}/rep")
    assert spark.read.json(f"{tmp}/rep").count() == 1
    spark.createDataFrame([("r1", "c", "x", 1)], "id string, collectionId string, title string, points int") \
        .write.json(f"{tmp}/rec")
    assert RD.read_records(spark, f"{tmp}/rec").columns == ["points", "title"]


def test_one_csv_file_by_many_tasks(spark, tmp):
    import csv
    import io
    import random

    from terroir.sources import readers as RD
    rnd = random.Random(2)
    parts = ["word", '"quoted"', "a,b", "\n", "\n\n", "x\ny", "", "é", '""', "\r\n"]
    rows = [[f"t{i}", "".join(rnd.choices(parts, k=rnd.randint(0, 9))), str(rnd.randint(70, 100))] for i in range(900)]
    os.makedirs(f"{tmp}/csv")
    for name, part in (("a.csv", rows[:700]), ("b.csv", rows[700:])):
        text = io.StringIO(newline="")
        w = csv.writer(text, lineterminator="\r\n" if name == "b.csv" else "\n")
        w.writerows([["Title", "Description", "points"], *part])
        with open(f"{tmp}/csv/{name}", "w", newline="") as f:
            f.write(text.getvalue() + ("\n\n" if name == "a.csv" else ""))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
        assert spark.read.text(f"{tmp}/csv/a.csv").rdd.getNumPartitions() > 3
        got = RD.read_split_csv(spark, f"{tmp}/csv").collect()
        skipped = {r["Title"] for r in RD.read_split_csv(spark, f"{tmp}/csv", offset=703).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted((r["Title"], r["Description"] or "", r["points"]) for r in got) == sorted(map(tuple, rows))
    assert skipped == {r[0] for r in rows[703:]}
    assert RD.read_reviews_csv(spark, f"{tmp}/csv").count() == 900
