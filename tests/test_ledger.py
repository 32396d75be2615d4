import random
from datetime import datetime, timedelta

import pytest

from pyspark.sql import functions as F

from terroir.operators import ledger, scans
from terroir.operators.ledger import subscription_ledger
from terroir.operators.lifecycle import APPLIED, INVALID, SUBSCRIPTION, SUBSCRIPTION_EVENTS

PRICES = {"P1": 1000, "P2": 2500, "P3": 9900}
SCHEMA = ("cliente string, suscripcion string, accion string, plan string, periodo string, titular string, "
          "metodo_pago_token string, estado_solicitado string, fecha timestamp, seq int")


def step_by_step(requests):
    """The rule, request after request."""
    clients, out = {}, {}
    for who, sub, action, plan, period, holder, token, wanted, when, seq in sorted(requests, key=lambda r: (str(r[0]), r[8], r[9])):
        subs, mrr = clients.setdefault(who, ({}, [0]))
        billed = bool(holder) and bool(token)
        cur = subs.get(sub)
        before = cur[0] if cur else None

        def active_elsewhere(plan=plan, subs=subs, sub=sub):
            return any(k != sub and v[0] == "ACTIVA" and v[1] == plan for k, v in subs.items())
        kind, delta = None, 0
        if action == "alta":
            verdict = ("suscripcion_existente" if cur else "plan_inexistente" if plan not in PRICES
                       else "suscripcion_activa_duplicada" if active_elsewhere() else APPLIED)
            if verdict == APPLIED:
                subs[sub] = ["ACTIVA" if billed else "PRUEBA", plan, period == "anual", billed]
                kind, delta = ("alta", PRICES[plan]) if billed else ("alta_prueba", 0)
        elif cur is None:
            verdict = "suscripcion_inexistente"
        elif action == "plan":
            verdict = ("suscripcion_cancelada" if before == "CANCELADA" else "plan_inexistente" if plan not in PRICES
                       else "suscripcion_activa_duplicada" if plan != cur[1] and active_elsewhere() else APPLIED)
            if verdict == APPLIED:
                delta = PRICES[plan] - PRICES[cur[1]]
                kind, cur[1] = "upgrade" if delta >= 0 else "downgrade", plan
        elif action != "estado" or wanted not in SUBSCRIPTION[before]:
            verdict = INVALID
        elif wanted == "ACTIVA" and not cur[3]:
            verdict = "facturacion_incompleta"
        else:
            verdict, kind = APPLIED, SUBSCRIPTION_EVENTS.get((before, wanted), "cambio_estado")
            cur[0] = wanted
            delta = PRICES[cur[1]] * (1 if wanted == "ACTIVA" else -1)
        mrr[0] += delta
        now = subs.get(sub)
        out[seq] = (verdict, kind, before, now and now[0], now and now[1], now and PRICES[now[1]] * (12 if now[2] else 1) / 100,
                    delta / 100, mrr[0] / 100)
    return out


def random_requests(n, seed, client, sub):
    rnd = random.Random(seed)
    rows, at = [], datetime(2026, 1, 1)
    for seq in range(n):
        at += timedelta(seconds=rnd.choice([0, 0, 1, 60]))
        who = client(rnd)
        rows.append((who, sub(rnd, who), rnd.choice(["alta", "alta", "estado", "estado", "plan", "otra"]),
                     rnd.choice(["P1", "P2", "P3", "nada", None]), rnd.choice(["anual", "mensual", None]),
                     rnd.choice(["A", "A", "A", None]), rnd.choice(["tok_visa_4242", "tok_visa_4242", None]),
                     rnd.choice(["ACTIVA", "ACTIVA", "EN_PAUSA", "CANCELADA", "PRUEBA", None]) if rnd.random() < 0.9 else "EN_PAUSA", at, seq))
    return rows


CASES = {
    "many": (lambda r: f"c{r.randrange(40)}", lambda r, c: f"{c}-s{r.randrange(4)}"),
    "hot_client": (lambda r: "hot" if r.random() < 0.6 else f"c{r.randrange(9)}", lambda r, c: f"{c}-s{r.randrange(60 if c == 'hot' else 3)}"),
    "hot_subscription": (lambda r: "hot" if r.random() < 0.7 else None, lambda r, c: f"{c}-s{r.randrange(2)}"),
}


@pytest.mark.parametrize("light", [10_000, 0, 40])
@pytest.mark.parametrize("case", sorted(CASES))
def test_ledger_equals_step_by_step(spark, case, light, monkeypatch):
    """All clients settled inside tasks, all by jobs over range partitions, or the small ones and the large ones each their way."""
    monkeypatch.setattr(ledger, "LIGHT", light)
    monkeypatch.setattr(ledger, "TASK_ROWS", 300)
    rows = random_requests(900, len(case), *CASES[case])
    plans = spark.createDataFrame([(k, v / 100) for k, v in PRICES.items()], "nombre string, precio_mensual double")
    got = subscription_ledger(spark.createDataFrame(rows, SCHEMA).repartition(5), plans)
    assert {r["seq"]: (r["veredicto"], r["tipo_evento"], r["estado_anterior"], r["estado"], r["plan_vigente"], r["monto"], r["mrr_delta"], r["mrr_cliente"])
            for r in got.collect()} == step_by_step(rows)


def test_empty_ledger(spark):
    plans = spark.createDataFrame([("P1", 10.0)], "nombre string, precio_mensual double")
    assert subscription_ledger(spark.createDataFrame([], SCHEMA), plans).count() == 0
    assert subscription_ledger(spark.createDataFrame(random_requests(20, 1, *CASES["many"]), SCHEMA), plans.where("false")).where(
        F.col("veredicto") == APPLIED).count() == 0


@pytest.mark.parametrize("reverse", [False, True])
def test_running_over_split_keys(spark, reverse):
    rnd = random.Random(5)
    rows = [("hot" if rnd.random() < 0.5 else rnd.choice(["a", "b", None]), i, rnd.choice([None, rnd.randrange(100)])) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, i long, v long")
    r = scans.ranged(df, ["k"], ["i"], 7)
    assert r.select("_pid", "k").distinct().where("k = 'hot'").count() > 2
    lanes = {n: (n, F.col("v")) for n in ("sum", "min", "max")}
    for x in scans.running(r, ["k"], ["i"], lanes, reverse=reverse).collect():
        seen = [v for k, i, v in rows if k == x["k"] and v is not None and (i > x["i"] if reverse else i < x["i"])]
        assert (x["sum"], x["min"], x["max"]) == (sum(seen), min(seen, default=None), max(seen, default=None))
