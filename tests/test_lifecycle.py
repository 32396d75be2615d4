import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from terroir.operators import lifecycle as L
from terroir.operators.ledger import subscription_ledger


def brute_replay(events, table, init):
    out, state = [], {}
    for k, seq, w in sorted(events):
        s = state.get(k, init)
        ok = w in table.get(s, [])
        state[k] = w if ok else s
        out.append((k, seq, s, state[k], L.APPLIED if ok else L.INVALID))
    return sorted(out)


def test_replay_matches_brute_force(spark):
    rnd = random.Random(3)
    states = list(L.TICKET)
    events = [(rnd.randint(0, 20), i, rnd.choice(states)) for i in range(2000)]
    df = spark.createDataFrame(events, "k int, seq int, w string").repartition(5)
    got = sorted((r.k, r.seq, r.estado_anterior, r.estado, r.veredicto)
                 for r in L.replay(df, "k", ["seq"], "w", L.TICKET, "ABIERTO").collect())
    assert got == brute_replay(events, L.TICKET, "ABIERTO")


def test_request_windows_brute_force(spark):
    rnd = random.Random(7)
    t0 = datetime(2026, 6, 1, 12, 0, 0)
    rows = [(i, rnd.randint(0, 3), t0 + timedelta(seconds=rnd.randint(0, 300))) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, user_id int, ts timestamp")
    got = {r.id: (r.en_ventana, r.excede) for r in L.request_windows(df, "user_id", "ts", 3, 30.0).collect()}
    for i, u, t in rows:
        n = sum(v == u and 0 <= (t - s).total_seconds() < 30 for _, v, s in rows)
        assert got[i] == (n, n > 3)


def test_ticket_sla_case29_30(spark):
    d = lambda h, m: datetime(2026, 6, 1, h, m)
    rows = [("t1", d(9, 0), 1, "ABIERTO"), ("t1", d(9, 30), 2, "EN_PROCESO"), ("t1", d(11, 0), 3, "RESUELTO"),
            ("t1", d(11, 5), 4, "CERRADO"),
            ("t2", d(9, 0), 1, "ABIERTO"), ("t2", d(9, 1), 2, "CERRADO"), ("t2", d(9, 2), 3, "EN_PROCESO"),
            ("t2", d(9, 3), 4, "REABIERTO")]
    df = spark.createDataFrame(rows, "ticket string, fecha timestamp, seq int, estado_solicitado string")
    out = {r.ticket: r for r in L.ticket_sla(df).collect()}
    assert out["t1"].minutos_primera_respuesta == 30.0 and out["t1"].minutos_resolucion == 120.0
    assert out["t1"].estado_final == "CERRADO"
    assert out["t2"].minutos_resolucion == 1.0             # a direct CERRADO sets the minutes
    # CERRADO → EN_PROCESO rejected, → REABIERTO accepted
    assert out["t2"].rechazados == 2 and out["t2"].estado_final == "REABIERTO"


def test_ticket_resolution_is_rewritten(spark):
    d = lambda h, m: datetime(2026, 6, 1, h, m)
    rows = [("a", d(9, 0), 1, "ABIERTO"), ("a", d(10, 0), 2, "RESUELTO"), ("a", d(10, 30), 3, "REABIERTO"),
            ("a", d(12, 0), 4, "RESUELTO"), ("a", d(12, 5), 5, "CERRADO"),
            ("b", d(9, 0), 1, "ABIERTO"), ("b", d(9, 10), 2, "CERRADO"), ("b", d(9, 20), 3, "REABIERTO"), ("b", d(9, 30), 4, "CERRADO"),
            ("c", d(9, 0), 1, "ABIERTO"), ("c", d(10, 0), 2, "RESUELTO"), ("c", d(10, 5), 3, "REABIERTO"), ("c", d(11, 0), 4, "CERRADO")]
    df = spark.createDataFrame(rows, "ticket string, fecha timestamp, seq int, estado_solicitado string")
    assert {r.ticket: r.minutos_resolucion for r in L.ticket_sla(df).collect()} == {"a": 180.0, "b": 10.0, "c": 60.0}


def test_stage_counts_once_per_lead(spark):
    d = lambda i: datetime(2026, 6, 1, 10, i)
    leads = L.first_touch(spark.createDataFrame([(k, "A", "pago", "CL", d(0), 0) for k in ("x", "y")],
                          "clave string, campana string, canal string, mercado string, fecha timestamp, seq int"))
    rows = [("x", "PERDIDO", d(1), 1), ("x", "CLIENTE", d(2), 2), ("x", "PERDIDO", d(3), 3),
            ("y", "OPORTUNIDAD", d(1), 4), ("y", "PERDIDO", d(2), 5), ("y", "OPORTUNIDAD", d(3), 6), ("y", "OTRA", d(4), 7),
            ("z", "CLIENTE", d(1), 8)]
    acc, rej = L.attribute_conversions(spark.createDataFrame(rows, "lead string, etapa string, fecha timestamp, seq int"), leads)
    assert {r.lead: r.etapa for r in L.lead_stage(acc).collect()} == {"x": "CLIENTE", "y": "PERDIDO"}
    assert {(r.lead, r.motivo) for r in rej.collect()} == {("y", "etapa_invalida"), ("z", "lead_inexistente")}
    accounts = L.accounts_from_conversions(acc.withColumn("id_tiempo", F.lit(202606)),
                                           spark.createDataFrame([(7, "x", "")], "id int, id_fiscal string, email string"))
    assert [(r.id_fiscal, r.id_existente, r.resultado) for r in accounts.collect()] == [("x", 7, "duplicada")]


def test_subscription_ledger_case42_43(spark):
    plans = spark.createDataFrame([("Básico", 49.0), ("Profesional", 149.0), ("Enterprise", 499.0)],
                                  "nombre string, precio_mensual double")
    d = lambda i: datetime(2026, 6, 1, 10, i)
    tok = "tok_visa_4242"
    rows = [("c1", "s1", "alta", "Profesional", "mensual", "A", tok, None, d(1), 1),
            ("c1", "s2", "alta", "Profesional", "mensual", "A", tok, None, d(2), 2),       # second ACTIVE of the plan
            ("c1", "s3", "alta", "Fantasma", "mensual", "A", tok, None, d(3), 3),
            ("c1", "s4", "alta", "Enterprise", "anual", "A", tok, None, d(4), 4),
            ("c1", "s4", "plan", "Profesional", "anual", "A", tok, None, d(5), 5),         # would double the plan
            ("c1", "s4", "plan", "Básico", "anual", "A", tok, None, d(6), 6),
            ("c2", "s5", "alta", "Básico", "mensual", None, None, None, d(1), 7),          # no billing: trial
            ("c2", "s5", "estado", None, "mensual", None, None, "ACTIVA", d(2), 8),
            ("c2", "s6", "alta", "Básico", "mensual", "A", "4111 1111 1111 1111", None, d(3), 9),   # a card number in the clear
            ("c2", "s5", "estado", None, "mensual", None, None, "CANCELADA", d(4), 10),
            ("c2", "s5", "estado", None, "mensual", None, None, "EN_PAUSA", d(5), 11),     # CANCELADA is terminal
            ("c2", "s5", "plan", "Enterprise", "mensual", None, None, None, d(6), 12),
            ("c3", "s7", "alta", "Básico", "mensual", "A", tok, None, d(1), 13),
            ("c3", "s7", "plan", "Enterprise", "mensual", "A", tok, None, d(2), 14),
            ("c3", "s7", "estado", None, "mensual", "A", tok, "EN_PAUSA", d(3), 15),
            ("c3", "s7", "estado", None, "mensual", "A", tok, "ACTIVA", d(4), 16)]
    df = spark.createDataFrame(rows, "cliente string, suscripcion string, accion string, plan string, periodo string, titular string, "
                                     "metodo_pago_token string, estado_solicitado string, fecha timestamp, seq int")
    out = {r.seq: r for r in subscription_ledger(df, plans).collect()}
    got = {k: (r.veredicto, r.tipo_evento, r.mrr_delta, r.mrr_cliente) for k, r in out.items()}
    assert got == {
        1: ("aplicada", "alta", 149.0, 149.0), 2: ("suscripcion_activa_duplicada", None, 0.0, 149.0),
        3: ("plan_inexistente", None, 0.0, 149.0), 4: ("aplicada", "alta", 499.0, 648.0),
        5: ("suscripcion_activa_duplicada", None, 0.0, 648.0), 6: ("aplicada", "downgrade", -450.0, 198.0),
        7: ("aplicada", "alta_prueba", 0.0, 0.0), 8: ("facturacion_incompleta", None, 0.0, 0.0),
        9: ("aplicada", "alta_prueba", 0.0, 0.0), 10: ("aplicada", "cancelacion", -49.0, -49.0),
        11: ("transicion_invalida", None, 0.0, -49.0), 12: ("suscripcion_cancelada", None, 0.0, -49.0),
        13: ("aplicada", "alta", 49.0, 49.0), 14: ("aplicada", "upgrade", 450.0, 499.0),
        15: ("aplicada", "pausa", -499.0, 0.0), 16: ("aplicada", "reactivacion", 499.0, 499.0)}
    assert (out[4].monto, out[1].metodo_pago, out[9].metodo_pago) == (5988.0, "****4242", "")


def test_onboarding_case34(spark):
    df = spark.createDataFrame([("a", i) for i in range(7)] + [("b", 0)], "cuenta string, paso int")
    out = {r.cuenta: r for r in L.onboarding_state(df).collect()}
    assert (out["a"].estado, out["a"].pasos_completados, out["a"].pasos_totales) == ("COMPLETADO", 5, 5)
    assert out["b"].estado == "EN_PROGRESO"


def test_first_touch_and_attribution_case37_38(spark):
    d = lambda i: datetime(2026, 6, 1, 10, i)
    leads = spark.createDataFrame([("L1", "A", "pago", "CL", d(1), 1), ("L1", "B", "organico", "AR", d(2), 2)],
                                  "clave string, campana string, canal string, mercado string, fecha timestamp, seq int")
    ft = L.first_touch(leads)
    assert {(r.campana, r.duplicado) for r in ft.collect()} == {("A", False), ("B", True)}
    conv = spark.createDataFrame([("L1", "CLIENTE", d(3), 1), ("L1", "CLIENTE", d(4), 2), ("L9", "LEAD", d(5), 3)],
                                 "lead string, etapa string, fecha timestamp, seq int")
    acc, rej = L.attribute_conversions(conv, ft)
    assert acc.count() == 1 and acc.first().campana_atribuida == "A"
    assert rej.first().lead == "L9"


def test_lead_stage_fold(spark):
    d = lambda i: datetime(2026, 6, 1, 10, i)
    conv = spark.createDataFrame([("a", "OPORTUNIDAD", d(1), 1), ("a", "PERDIDO", d(2), 2),
                                  ("b", "OPORTUNIDAD", d(1), 1), ("b", "PERDIDO", d(2), 2), ("b", "LEAD", d(3), 3),
                                  ("c", "LEAD", d(1), 1), ("c", "CLIENTE", d(2), 2), ("c", "OPORTUNIDAD", d(3), 3)],
                                 "lead string, etapa string, fecha timestamp, seq int")
    out = {r.lead: r.etapa for r in L.lead_stage(conv).collect()}
    assert out == {"a": "PERDIDO", "b": "LEAD", "c": "CLIENTE"}


def test_entitlement_and_account_dedup_case44(spark):
    subs = spark.createDataFrame([("c1", "s1", "CANCELADA", datetime(2026, 1, 1)),
                                  ("c1", "s2", "ACTIVA", datetime(2026, 2, 1))],
                                 "cliente string, suscripcion string, estado string, fecha timestamp")
    assert L.entitlement(subs).first().suscripcion == "s2"
    existing = spark.createDataFrame([(1, "76.1-K", "a@x.cl")], "id int, id_fiscal string, email string")
    inc = spark.createDataFrame([("76.1-K", "new@x.cl"), (None, "A@X.CL "), (None, None), ("9", "z@z")],
                                "id_fiscal string, email string")
    res = [(r.id_existente, r.resultado) for r in L.dedup_accounts(existing, inc).collect()]
    assert sorted(res, key=str) == sorted([(1, "duplicada"), (1, "duplicada"), (None, "identificacion_requerida"),
                                           (None, "nueva")], key=str)


def test_replay_splits_hot_key_across_partitions(spark):
    rnd = random.Random(11)
    states = list(L.TICKET)
    # one key holds most rows; many partitions → the hot key spans several
    events = [(0 if rnd.random() < 0.7 else rnd.randint(1, 30), i, rnd.choice(states)) for i in range(5000)]
    df = spark.createDataFrame(events, "k int, seq int, w string")
    got = sorted((r.k, r.seq, r.estado_anterior, r.estado, r.veredicto)
                 for r in L.replay(df, "k", ["seq"], "w", L.TICKET, "ABIERTO", num_partitions=13).collect())
    assert got == brute_replay(events, L.TICKET, "ABIERTO")
    pasos = sorted(r.paso for r in L.replay(df, "k", ["seq"], "w", L.TICKET, "ABIERTO", num_partitions=13)
                   .filter("k = 0").collect())
    assert pasos == list(range(1, sum(1 for e in events if e[0] == 0) + 1))


def one_by_one(existing, rows):
    """Sign-ups inserted one after the other."""
    accounts = [("old", i, t.strip(), m.strip().lower()) for i, t, m in existing]
    out = {}
    for seq, tax, mail in rows:
        tax, mail = (tax or "").strip(), (mail or "").strip().lower()
        hit = None
        for campo, value, at in (("id_fiscal", tax, 2), ("email", mail, 3)):
            found = [a for a in accounts if value and a[at] == value]
            if found and hit is None:
                hit = (campo, found[0])
        if not tax and not mail:
            out[seq] = (None, None, None, "identificacion_requerida")
        elif hit:
            kind, ref = hit[1][:2]
            out[seq] = (ref if kind == "old" else None, ref if kind == "new" else None, hit[0], "duplicada")
        else:
            out[seq] = (None, None, None, "nueva")
            accounts.append(("new", seq, tax, mail))
    return out


def test_batch_signups_equal_one_by_one(spark):
    for seed, n in ((1, 12), (2, 60)):
        rnd = random.Random(seed)
        rows = [(i, rnd.choice([None, " ", "hot", *[f"t{rnd.randrange(n)}"] * 5]), rnd.choice([None, "HOT@x", *[f" M{rnd.randrange(n)}@x "] * 4]))
                for i in range(300)]
        existing = [(900 + i, f"t{i * 5}", f"m{i * 7}@x") for i in range(4)]
        got = L.dedup_accounts(spark.createDataFrame(existing, "id int, id_fiscal string, email string"),
                               spark.createDataFrame(rows, "seq int, id_fiscal string, email string").repartition(3), ["seq"]).collect()
        assert {r.seq: (r.id_existente, r.orden_existente and r.orden_existente.seq, r.campo, r.resultado) for r in got} == one_by_one(existing, rows)


def test_sources_follow_the_catalogue(spark):
    d = lambda i: datetime(2026, 6, 1, 10, i)
    rows = [("a", "habilitar", True, False, None, d(1), 1), ("a", "habilitar", True, True, None, d(2), 2),       # rejected, then enabled
            ("a", "ingesta", None, None, "COMPLETADA", d(3), 3), ("a", "ingesta", None, None, "FALLIDA", d(4), 4),
            ("b", "habilitar", False, True, None, d(1), 5), ("c", "habilitar", True, False, None, d(1), 6), ("c", "deshabilitar", None, None, None, d(2), 7)]
    got = {r.fuente: tuple(r)[1:] for r in L.source_state(spark.createDataFrame(
        rows, "fuente string, accion string, metadatos_ok boolean, conexion_ok boolean, estado_ingesta string, fecha timestamp, seq int")).collect()}
    assert got == {"a": ("HABILITADA", "", "FALLIDA", d(3), 0), "b": ("REGISTRADA", "", None, None, 1),
                   "c": ("DESHABILITADA", "conexion_fallida", None, None, 0)}


def test_onboarding_replay(spark):
    steps = ["x", "y", "z"]
    acts = [("avanzar", None), ("estado", "EN_PROGRESO"), ("estado", "estancado"), ("avanzar", None), ("estado", "nada"), ("estado", "COMPLETADO"),
            ("avanzar", None), ("estado", "ESTANCADO")]
    rows = [("a", steps, k, w, datetime(2026, 6, 1, 10, i), i) for i, (k, w) in enumerate(acts)]
    rows += [("b", ["only"], "estado", "COMPLETADO", datetime(2026, 6, 1), 20), ("b", ["only"], "avanzar", None, datetime(2026, 6, 2), 21),
             ("c", None, "avanzar", None, datetime(2026, 6, 2), 22)]
    got = L.onboarding_replay(spark.createDataFrame(
        rows, "cuenta string, pasos array<string>, accion string, estado_solicitado string, fecha timestamp, seq int")).collect()
    assert {r.seq: (r.estado, r.veredicto, r.pasos_completados, r.paso_actual) for r in got} == {
        0: ("EN_PROGRESO", "aplicada", 1, "y"), 1: ("EN_PROGRESO", "transicion_invalida", 1, "y"), 2: ("ESTANCADO", "aplicada", 1, "y"),
        3: ("EN_PROGRESO", "aplicada", 2, "z"), 4: ("EN_PROGRESO", "transicion_invalida", 2, "z"), 5: ("COMPLETADO", "aplicada", 3, "z"),
        6: ("COMPLETADO", "sin_cambio", 3, "z"), 7: ("COMPLETADO", "transicion_invalida", 3, "z"),
        20: ("PENDIENTE", "transicion_invalida", 0, "only"), 21: ("COMPLETADO", "aplicada", 1, "only"), 22: ("COMPLETADO", "aplicada", 1, None)}


def test_request_windows_of_a_hot_key(spark):
    rnd = random.Random(9)
    rows = [(i, "hot" if i % 3 else "b", datetime(2026, 1, 1) + timedelta(microseconds=rnd.randrange(300_000_000))) for i in range(500)]
    got = L.request_windows(spark.createDataFrame(rows, "id int, user_id string, ts timestamp_ntz"), "user_id", "ts", 5, 20.0)
    want = {i: sum(k == u and timedelta(0) <= t - v < timedelta(seconds=20) for _, u, v in rows) for i, k, t in rows}
    assert {r.id: r.en_ventana for r in got.collect()} == want and got.columns == ["id", "user_id", "ts", "en_ventana", "excede"]
