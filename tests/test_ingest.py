from terroir.operators.ingest import ingest_batch


def batch(spark, rows):
    return spark.createDataFrame(rows, "ordinal long, title string, points string, taster_name string, winery string")


def test_case1_rejects_and_duplicates(spark):
    rows = [(1, "Vino A 2018", "90", "Ana", "Bodega 1"), (2, "Vino A 2018", "91", "Ana", "Bodega 1"),
            (3, "Vino B 2019", "88", "Beto", "Bodega 2"), (4, "", "90", "Ana", "Bodega 3"),
            (5, "Vino C", "55", "Ana", "Bodega 4")]
    valid, rejects, report = ingest_batch(batch(spark, rows), "reseñas", "rec0001", "2026-06-29")
    r = report.first()
    assert (r.filas_leidas, r.filas_rechazadas, r.filas_duplicadas, r.filas_cargadas, r.estado) == (5, 2, 1, 0, "FALLIDA")
    reasons = sorted(x.motivo_rechazo for x in rejects.collect())
    assert reasons[0].startswith("campo_faltante:title") and reasons[1].startswith("dominio:puntaje")
    assert valid.filter("title = 'Vino A 2018'").first().ordinal == 1     # first wins


def _n_invalid(spark, n_bad, bad_points):
    rows = [(i, f"V{i}", bad_points if i < n_bad else "90", "Ana", "B") for i in range(100)]
    return ingest_batch(batch(spark, rows), "reseñas", "s", "2026-06-29")[2].first()


def test_case2_partial(spark):
    r = _n_invalid(spark, 2, "10")
    assert (r.pct_rechazo, r.estado) == (2.0, "PARCIAL")


def test_case3_failed(spark):
    r = _n_invalid(spark, 12, "1")
    assert (r.pct_rechazo, r.estado, r.filas_cargadas) == (12.0, "FALLIDA", 0)


def test_case4_threshold_is_strict(spark):
    assert _n_invalid(spark, 5, "1").estado == "PARCIAL"


def test_case5_empty_batch(spark):
    r = ingest_batch(batch(spark, []), "reseñas", "s", "2026-06-29")[2].first()
    assert r.estado == "FALLIDA"


def test_prices_currency_and_future_date(spark):
    df = spark.createDataFrame([(1, "A", "10", " usd ", "2026-01-01", "CL"), (2, "B", "0", "USD", "2026-01-01", "CL"),
                                (3, "C", "5", "XYZ", "2026-01-01", "CL"), (4, "D", "5", "EUR", "2030-01-01", "CL")],
                               "ordinal long, title string, price string, moneda string, fecha_precio string, mercado string")
    _, rej, rep = ingest_batch(df, "precios", "s", "2026-06-29")
    reasons = {r.title: r.motivo_rechazo for r in rej.collect()}
    assert reasons["B"].startswith("dominio:precio_no_positivo")
    assert reasons["C"].startswith("dominio:moneda_no_iso4217")
    assert reasons["D"].startswith("dominio:fecha_futura")
    assert "A" not in reasons


def test_deduplication_moves_the_rows_once(spark):
    rows = [(3, "V", "90", "Ana", "B"), (1, "V", "91", "Ana", "B"), (2, "W", "92", "Ana", "B"), (4, "W", "93", "Ana", "B")]
    valid = ingest_batch(batch(spark, rows), "reseñas", "s", "2026-06-29")[0]
    p = valid._jdf.queryExecution().executedPlan().toString()
    assert p.count("Exchange hashpartitioning") == 1 and "Join" not in p
    assert sorted((r.ordinal, r.points) for r in valid.collect()) == [(1, "91"), (2, "92")]
