"""The subscription ledger, without a task per client.

A client may hold one ACTIVE subscription per plan: whether a sign-up or a plan
change is allowed depends on the client's other subscriptions at that moment.
Were it known which requests that rule blocks, every subscription would follow
from its own requests alone, by running aggregates:

* it exists from the first sign-up with a known plan that is not blocked;
* the transition table allows CANCELADA from every state, so a later request
  for it ends the subscription; without valid billing it stays a trial until
  then, with it the last request for ACTIVA or EN_PAUSA is its state;
* its plan is that of its last plan change that was allowed.

And were all subscriptions known, a running sum of activations per (client,
plan) would tell which requests are blocked.  So both are computed in turn,
from "nothing is blocked" on.  What is right up to some request stays right, and
each round settles at least the next request of every client, in practice all
that do not hang on a chain of blocked ones (four rounds on the test data).
When a round changes nothing, the ledger is the one that a step-by-step
replay gives.

Clients of up to ``LIGHT`` requests go through their rounds together in tasks of bounded size, as numpy
arrays of many clients.  A larger client's rounds are Spark jobs whose running aggregates go over range
partitions (``scans``): neither a client nor a subscription nor a plan has to fit a task.  Clients
that a round leaves unchanged are done; the next round takes only the others.  The same two
expressions then give every request's verdict, once, from the blocked requests of both.
"""

from __future__ import annotations

import numpy as np
import pandas as pd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terroir.functions import billing_ok, mask
from terroir.operators.lifecycle import APPLIED, INVALID, MAX_PLANS, SUBSCRIPTION, SUBSCRIPTION_EVENTS
from terroir.operators.scans import cut_keys, ranged, running, stored

SUB = ["cliente", "suscripcion"]
TIME = ["fecha", "seq", "_row"]
LIGHT = 10_000                    # requests of a client that is settled inside one task
TASK_ROWS = 100_000               # requests of such clients per group
BITS = 13                         # plan * 4 + billing ok * 2 + yearly, in the low bits of a packed row number


def _entry(values: Column, code: Column) -> Column:
    """The array's entry by code; null for none (element_at of a literal array and a null index is not null)."""
    return F.when(code.isNotNull(), F.get(values, code))


def _row_of(packed: str) -> Column:
    return F.shiftright(F.col(packed), BITS)


def _prepared(requests: DataFrame, plans: DataFrame) -> tuple[DataFrame, list]:
    """Requests with plan code (null: unknown), flags and row number ``_row``, ranged by subscription; the catalogue by code."""
    catalogue = plans.select("nombre", F.round(F.col("precio_mensual") * 100).cast("long").alias("c")).limit(MAX_PLANS + 1).collect()
    if len(catalogue) > MAX_PLANS:
        raise ValueError(f"the plan catalogue has more than {MAX_PLANS} rows")
    names = requests.sparkSession.createDataFrame([(r["nombre"], i) for i, r in enumerate(catalogue)], "plan string, _plan int")
    rows = (requests.withColumn("facturacion_ok", billing_ok("titular", "metodo_pago_token"))
            .withColumn("metodo_pago", F.when(F.col("facturacion_ok"), mask("metodo_pago_token")).otherwise(F.lit("")))
            .join(F.broadcast(names), "plan", "left").select(*requests.columns, "facturacion_ok", "metodo_pago", "_plan"))
    # _time: the range partition by (client, time), for what spans a client's subscriptions
    timed = ranged(rows, ["cliente"], ["fecha", "seq"]).withColumnRenamed("_pid", "_time").drop("_local")
    r = ranged(timed, SUB, ["fecha", "seq"])
    counts = {x["_pid"]: x["n"] for x in r.groupBy("_pid").agg(F.count(F.lit(1)).alias("n")).collect()}     # a row per partition
    starts, at = [], 0
    for p in range(max(counts, default=-1) + 1):
        starts.append(at)
        at += counts.get(p, 0)
    start = F.element_at(F.array(*[F.lit(s).cast("long") for s in starts]), F.col("_pid") + 1) if starts else F.lit(0).cast("long")
    return r.withColumn("_row", start + F.col("_local")).drop("_local"), catalogue


def _static(rows: DataFrame, cut: DataFrame) -> DataFrame:
    """The subscription's last request to switch (``_switch``) and to cancel (``_cancel``) before each request."""
    wanted = F.when(F.col("accion") == "estado", F.col("estado_solicitado"))
    switch = F.when(wanted.isin("ACTIVA", "EN_PAUSA"), F.col("_row") * 2 + (wanted == "ACTIVA").cast("long"))
    return running(rows, SUB, ["_row"], {"_switch": ("max", switch), "_cancel": ("max", F.when(wanted == "CANCELADA", F.col("_row")))}, cut=cut)


def _history(rows: DataFrame, cut: DataFrame) -> DataFrame:
    """Each request's subscription before it: ``_before`` (state), ``_cur`` (plan code), ``_billed``, ``_yearly``.

    ``rows`` has ``_blocked``, the requests that the duplicate rule turns down.
    """
    known = F.col("_plan").isNotNull() & ~F.col("_blocked")
    code = F.col("_plan") * 4 + F.coalesce("facturacion_ok", F.lit(False)).cast("int") * 2 + F.coalesce(F.col("periodo") == "anual", F.lit(False)).cast("int")
    packed = F.shiftleft(F.col("_row"), BITS) + code
    r = running(rows, SUB, ["_row"], {"_made": ("min", F.when((F.col("accion") == "alta") & known, packed))}, cut=cut)
    made, cancelled = _row_of("_made"), F.coalesce(F.col("_cancel") > _row_of("_made"), F.lit(False))
    changed = (F.col("accion") == "plan") & known & F.col("_made").isNotNull() & ~cancelled
    r = running(r, SUB, ["_row"], {"_moved": ("max", F.when(changed, packed))}, cut=cut)
    billed = F.col("_made").bitwiseAND(F.lit(2)) != 0
    switched = F.coalesce(F.shiftright(F.col("_switch"), 1) > made, F.lit(False))
    state = (F.when(F.col("_made").isNull(), F.lit(None).cast("string")).when(cancelled, "CANCELADA").when(~billed, "PRUEBA")
             .when(~switched | (F.col("_switch") % 2 == 1), "ACTIVA").otherwise("EN_PAUSA"))
    plan = F.shiftright(F.coalesce("_moved", "_made").bitwiseAND(F.lit((1 << BITS) - 1)), 2).cast("int")
    return r.withColumns({"_before": state, "_cur": plan, "_billed": billed, "_yearly": F.col("_made") % 2 == 1})


def _decided(h: DataFrame, cents: list[int]) -> DataFrame:
    """Verdict, event type, state and plan after each request, and the monthly difference in cents."""
    price = F.array(*[F.lit(c).cast("long") for c in cents or [0]])

    def cost(code: str) -> Column:
        return _entry(price, F.col(code))
    before, wanted, action = F.col("_before"), F.col("estado_solicitado"), F.col("accion")
    allowed = F.lit(False)
    for state, targets in SUBSCRIPTION.items():
        allowed = allowed | ((before == state) & wanted.isin(*targets))
    unknown, other = F.col("_plan").isNull(), F.col("_plan") != F.col("_cur")
    verdict = (F.when((action == "alta") & before.isNotNull(), "suscripcion_existente")
               .when((action == "alta") & unknown, "plan_inexistente")
               .when((action == "alta") & F.col("_blocked"), "suscripcion_activa_duplicada").when(action == "alta", APPLIED)
               .when(before.isNull(), "suscripcion_inexistente")
               .when((action == "plan") & (before == "CANCELADA"), "suscripcion_cancelada")
               .when((action == "plan") & unknown, "plan_inexistente")
               .when((action == "plan") & other & F.col("_blocked"), "suscripcion_activa_duplicada").when(action == "plan", APPLIED)
               .when((action == "estado") & allowed, F.when((wanted == "ACTIVA") & ~F.col("_billed"), "facturacion_incompleta").otherwise(APPLIED))
               .otherwise(INVALID))
    h = h.withColumn("veredicto", verdict)
    done = F.col("veredicto") == APPLIED
    signed, moved, switched = done & (action == "alta"), done & (action == "plan"), done & (action == "estado")
    ok = F.coalesce("facturacion_ok", F.lit(False))
    kind = F.lit("cambio_estado")
    for (a, b), name in SUBSCRIPTION_EVENTS.items():
        kind = F.when((before == a) & (wanted == b), name).otherwise(kind)
    delta = (F.when(signed, F.when(ok, cost("_plan")).otherwise(0)).when(moved, cost("_plan") - cost("_cur"))
             .when(switched, F.when(wanted == "ACTIVA", cost("_cur")).when(wanted.isin("EN_PAUSA", "CANCELADA"), -cost("_cur")).otherwise(0)).otherwise(0))
    h = h.withColumns({
        "estado": F.when(signed, F.when(ok, "ACTIVA").otherwise("PRUEBA")).when(switched, wanted).otherwise(before),
        "_now": F.when(signed | moved, F.col("_plan")).otherwise(F.col("_cur")),
        "_year": F.when(signed, F.coalesce(F.col("periodo") == "anual", F.lit(False))).otherwise(F.col("_yearly")), "_delta": delta.cast("long")})
    return h.withColumns({
        "tipo_evento": (F.when(signed, F.when(ok, "alta").otherwise("alta_prueba"))
                        .when(moved, F.when(F.col("_delta") >= 0, "upgrade").otherwise("downgrade")).when(switched, kind)),
        "_amount": cost("_now") * F.when(F.col("_year"), 12).otherwise(1)})


def _blocked(d: DataFrame, cut: DataFrame) -> DataFrame:
    """(cliente, _row) of the requests for a plan that another subscription of the client holds ACTIVE just then."""
    was, now = F.col("_before") == "ACTIVA", F.col("estado") == "ACTIVA"
    changed = ~(was.eqNullSafe(now) & F.col("_cur").eqNullSafe(F.col("_now")))
    asks = (F.col("_plan").isNotNull() & (((F.col("accion") == "alta") & F.col("_before").isNull())
            | ((F.col("accion") == "plan") & (F.col("_before") != "CANCELADA") & (F.col("_plan") != F.col("_cur")))))
    entries = F.array(
        F.struct(F.when(asks, F.col("_plan")).alias("p"), F.lit(0).alias("kind"), F.lit(0).cast("long").alias("n")),
        F.struct(F.when(changed & was, F.col("_cur")).alias("p"), F.lit(1).alias("kind"), F.lit(-1).cast("long").alias("n")),
        F.struct(F.when(changed & now, F.col("_now")).alias("p"), F.lit(1).alias("kind"), F.lit(1).cast("long").alias("n")))
    stacked = d.select(F.col("_time").alias("_pid"), "cliente", *TIME, F.inline(F.filter(entries, lambda e: e["p"].isNotNull())))
    summed = running(stacked, ["cliente", "p"], [*TIME, "kind"], {"_active": ("sum", F.col("n"))}, cut=cut, cut_on=["cliente"])
    return summed.where("kind = 0 AND _active > 0").select("cliente", "_row")


def _settled(pdf: pd.DataFrame) -> np.ndarray:
    """Which requests the duplicate rule blocks, for whole clients, sorted by subscription and time."""
    n = len(pdf)
    at = np.arange(n)
    client, plan, bill = pdf["_client"].to_numpy(), pdf["_code"].to_numpy(), pdf["_bill"].to_numpy(bool)
    action, wanted = pdf["accion"].to_numpy(object), pdf["estado_solicitado"].to_numpy(object)
    sub = np.cumsum(np.r_[True, pdf["_sub"].to_numpy()[1:] != pdf["_sub"].to_numpy()[:-1]]) - 1
    first = np.searchsorted(sub, sub)                                       # the subscription's first row
    time = np.empty(n, np.int64)
    time[np.lexsort((at, pdf["seq"].to_numpy(), pdf["fecha"].to_numpy()))] = at
    known, signs, moves = plan >= 0, action == "alta", action == "plan"
    asked = np.where(action == "estado", wanted, None)

    def last_before(mask: np.ndarray) -> np.ndarray:
        seen = np.r_[-1, np.maximum.accumulate(np.where(mask, at, -1))[:-1]]
        return np.where(seen >= first, seen, -1)
    switch, cancel = last_before((asked == "ACTIVA") | (asked == "EN_PAUSA")), last_before(asked == "CANCELADA")
    blocked = np.zeros(n, bool)
    while True:
        made = np.full(sub[-1] + 1, n)
        np.minimum.at(made, sub[signs & known & ~blocked], at[signs & known & ~blocked])
        made = made[sub]
        exists = made < at
        origin = np.minimum(made, n - 1)
        alive = exists & (cancel <= made)
        moved = last_before(moves & known & ~blocked & alive)
        cur = np.where(moved >= 0, plan[moved], plan[origin])
        billed = bill[origin]
        active = alive & billed & ((switch <= made) | (wanted[switch] == "ACTIVA"))
        asks = known & ((signs & ~exists) | (moves & alive & (plan != cur)))
        made_now = signs & ~exists & known & ~blocked
        now = np.where(made_now, bill, np.where(alive & (asked == "ACTIVA"), billed, np.where((asked == "EN_PAUSA") | (asked == "CANCELADA"), False, active)))
        plan_now = np.where(made_now | (moves & alive & known & ~(blocked & (plan != cur))), plan, cur)
        changed = (active != now) | (active & (cur != plan_now))
        rows = [at[asks], at[changed & active], at[changed & now]]
        key = np.concatenate([client[r] * (1 << BITS) + p[r] for r, p in zip(rows, (plan, cur, plan_now), strict=True)])
        kind, value = np.repeat([0, 1, 1], [len(r) for r in rows]), np.repeat([0, -1, 1], [len(r) for r in rows])
        row = np.concatenate(rows)
        order = np.lexsort((kind, time[row], key))
        total = np.cumsum(value[order]) - value[order]                       # before each entry
        starts = np.r_[True, key[order][1:] != key[order][:-1]] if len(order) else np.zeros(0, bool)
        total -= np.repeat(total[starts], np.diff(np.r_[np.flatnonzero(starts), len(order)]))
        found = np.zeros(n, bool)
        hit = (kind[order] == 0) & (total > 0)
        found[row[order][hit]] = True
        if (found == blocked).all():
            return found
        blocked = found


def _light_blocked(rows: DataFrame, total: int) -> DataFrame:
    """(cliente, _row) of the blocked requests of small clients, many clients to a task."""
    groups = max(1, -(-total // TASK_ROWS))
    narrow = rows.select("cliente", F.xxhash64(*SUB).alias("_sub"), "accion", "estado_solicitado", "fecha", "seq", "_row",
                         F.coalesce("_plan", F.lit(-1)).alias("_code"), F.coalesce("facturacion_ok", F.lit(False)).alias("_bill"),
                         F.pmod(F.xxhash64("cliente"), F.lit(groups)).alias("_group"))

    def settle(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_row", ignore_index=True)                     # by client, subscription and time
        pdf["_client"] = pd.factorize(pdf["cliente"], use_na_sentinel=False)[0]
        return pdf.loc[_settled(pdf), ["cliente", "_row"]]
    schema = narrow.select("cliente", "_row").schema
    return narrow.groupBy("_group").applyInPandas(settle, schema)


def subscription_ledger(requests: DataFrame, plans: DataFrame) -> DataFrame:
    """Replay of subscription requests (cliente, suscripcion, accion in
    alta / estado / plan, plan, periodo, titular, metodo_pago_token,
    estado_solicitado, fecha, seq) over the plan catalogue (at most ``MAX_PLANS`` rows).

    Activation needs valid billing (F20; else the subscription starts as a
    trial), a client has one ACTIVE subscription per plan, unknown plans are
    rejected, and a plan change is an upgrade or downgrade with the price
    difference.  Yearly amounts count a twelfth a month (F16).  Requests of a client are in the
    order of (fecha, seq).
    """
    rows, catalogue = _prepared(requests, plans)
    cents = [x["c"] for x in catalogue]
    cut, time_cut = cut_keys(rows, SUB), cut_keys(rows.withColumn("_pid", F.col("_time")), ["cliente"])

    def decided(some: DataFrame, blocked: DataFrame) -> DataFrame:
        marks = blocked.select("_row", F.lit(True).alias("_b"))
        flagged = some.join(marks, "_row", "left").withColumn("_blocked", F.coalesce("_b", F.lit(False))).drop("_b")
        return _decided(_history(flagged, cut), cents)
    still = F.col("l.cliente").eqNullSafe(F.col("r.cliente"))
    sizes = rows.groupBy("cliente").agg(F.count(F.lit(1)).alias("n"))
    small = F.col("n") <= LIGHT
    count = sizes.agg(F.sum(F.when(small, F.col("n"))).alias("rows"), F.count_if(~small).alias("large")).first()
    if not count["large"]:
        blocked = stored(_light_blocked(rows, count["rows"] or 0))
        rows = _static(rows, cut)
    else:
        rows = stored(_static(rows, cut))
        large = stored(sizes.where(~small))
        blocked = stored(_light_blocked(rows.alias("l").join(large.alias("r"), still, "left_anti"), count["rows"] or 0))
        open_rows = rows.alias("l").join(large.alias("r"), still, "left_semi")          # of the clients that are not settled
        mine = rows.sparkSession.createDataFrame([], rows.select("cliente", "_row").schema)
        while True:
            found = stored(_blocked(decided(open_rows, mine), time_cut))
            changed = stored(found.withColumn("s", F.lit(1)).unionAll(mine.withColumn("s", F.lit(-1))).groupBy("cliente", "_row")
                             .agg(F.sum("s").alias("s")).where("s <> 0").select("cliente").distinct())
            if changed.isEmpty():
                break
            # clients without a change are settled; the others take the new marks and go on
            mine = found.alias("l").join(changed.alias("r"), still, "left_semi")
            blocked = stored(blocked.alias("l").join(changed.alias("r"), still, "left_anti").unionByName(mine))
            open_rows = rows.alias("l").join(changed.alias("r"), still, "left_semi")
    ledger = decided(rows, blocked).withColumn("_pid", F.col("_time"))
    summed = running(ledger, ["cliente"], TIME, {"_mrr": ("sum", F.col("_delta"))}, cut=time_cut)
    names = F.array(*[F.lit(x["nombre"]) for x in catalogue] or [F.lit("")])
    return summed.select(*requests.columns, "facturacion_ok", "metodo_pago",
                         _entry(names, F.col("_now")).alias("plan_vigente"), F.col("_before").alias("estado_anterior"), "estado",
                         "veredicto", "tipo_evento", (F.col("_amount") / 100).alias("monto"), (F.col("_delta") / 100).alias("mrr_delta"),
                         ((F.col("_mrr") + F.col("_delta")) / 100).alias("mrr_cliente"))
