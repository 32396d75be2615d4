"""Lifecycle replays and sequential folds.

Per-key state machines are *sequential*, so they cannot be a plain
aggregate.  The batch form never gathers a key's history into one row or
one pandas frame: rows are range-partitioned and sorted by (key, time), then
``mapInPandas`` streams the sorted Arrow batches through a small fold that
keeps only the *current* key's state; a hot key spans many partitions (see
``replay``).

Where the fold has a closed form (lead stage, first touch, onboarding
counts, entitlement, account dedup) it is written with aggregates instead.
"""

from __future__ import annotations

import numpy as np
import pandas as pd

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Transition tables (state → allowed targets).
SUBSCRIPTION = {"PRUEBA": ["ACTIVA", "CANCELADA"], "ACTIVA": ["EN_PAUSA", "CANCELADA"],
                "EN_PAUSA": ["ACTIVA", "CANCELADA"], "CANCELADA": []}
TICKET = {"ABIERTO": ["EN_PROCESO", "RESUELTO", "CERRADO"], "EN_PROCESO": ["RESUELTO", "CERRADO"],
          "RESUELTO": ["CERRADO", "REABIERTO"], "CERRADO": ["REABIERTO"],
          "REABIERTO": ["EN_PROCESO", "RESUELTO", "CERRADO"]}
ONBOARDING = {"PENDIENTE": ["EN_PROGRESO", "ESTANCADO"], "EN_PROGRESO": ["COMPLETADO", "ESTANCADO"],
              "ESTANCADO": ["EN_PROGRESO", "COMPLETADO"], "COMPLETADO": []}
CAMPAIGN = {"BORRADOR": ["PROGRAMADA"], "PROGRAMADA": ["EN_EJECUCION", "PAUSADA", "FINALIZADA"],
            "EN_EJECUCION": ["PAUSADA", "FINALIZADA"], "PAUSADA": ["EN_EJECUCION", "FINALIZADA"],
            "FINALIZADA": []}
# Subscription event type by (from, to).
SUBSCRIPTION_EVENTS = {("PRUEBA", "ACTIVA"): "alta", ("EN_PAUSA", "ACTIVA"): "reactivacion",
                       ("ACTIVA", "EN_PAUSA"): "pausa", ("ACTIVA", "CANCELADA"): "cancelacion",
                       ("EN_PAUSA", "CANCELADA"): "cancelacion", ("PRUEBA", "CANCELADA"): "cancelacion"}
# Lead stage order (PERDIDO = -1 so a later stage revives).
STAGE_ORDER = {"LEAD": 0, "OPORTUNIDAD": 1, "CLIENTE": 2, "PERDIDO": -1}
ONBOARDING_STEPS = ["alta", "configuracion", "primer_dashboard", "capacitacion", "activacion"]

MAX_PLANS = 1000                  # rows of a plan catalogue
INVALID = "transicion_invalida"
APPLIED = "aplicada"

REPLAY_FIELDS = [T.StructField("estado_anterior", T.StringType()), T.StructField("estado", T.StringType()),
                 T.StructField("veredicto", T.StringType()), T.StructField("permitidos", T.StringType()),
                 T.StructField("paso", T.LongType())]


class _Machine:
    """A finite state machine over integer codes, applied to whole batches.

    ``step[w, s]`` is the state after target w in state s; the last target row
    stands for unknown or missing targets, which change nothing."""

    def __init__(self, transitions: dict[str, list[str]], init: str):
        self.states = list(dict.fromkeys([init, *transitions, *[t for v in transitions.values() for t in v]]))
        code = {st: i for i, st in enumerate(self.states)}
        n = len(self.states)
        self.ok = np.zeros((n + 1, n), dtype=bool)
        for st, targets in transitions.items():
            for t in targets:
                self.ok[code[t], code[st]] = True
        here = np.arange(n, dtype=np.int16)
        self.step = np.where(self.ok, np.arange(n + 1, dtype=np.int16)[:, None], here[None, :])
        self.init, self.code = code[init], code
        self.allowed = np.array([",".join(sorted(transitions.get(st, ()))) for st in self.states], dtype=object)
        self.names = np.array(self.states, dtype=object)

    def targets(self, wanted: pd.Series) -> np.ndarray:
        return wanted.map(self.code).fillna(len(self.states)).to_numpy(dtype=np.int64)

    def composed(self, targets: np.ndarray, segment: np.ndarray) -> np.ndarray:
        """Per row, the map (state at the segment's start → state after the row),
        by a segmented doubling scan: log2(longest segment) vector steps."""
        f = self.step[targets].copy()
        d = 1
        while d < len(f):
            at = np.flatnonzero(segment[d:] == segment[:-d]) + d
            if not len(at):
                break
            before = f[at - d]
            f[at] = np.take_along_axis(f[at], before, axis=1)
            d *= 2
        return f


def _segments(keys: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """(segment number of each row, first row of each segment) of sorted keys."""
    new = np.append(True, keys.to_numpy()[1:] != keys.to_numpy()[:-1])
    return np.cumsum(new) - 1, np.flatnonzero(new)


def replay(events: DataFrame, key: str, order: list[str], target: str, transitions: dict[str, list[str]],
           init: str, num_partitions: int | None = None, keep_pid: bool = False) -> DataFrame:
    """Fold each key's time-ordered requested targets over a transition
    table.  Per event: previous state, resulting state, verdict
    ('aplicada' / 'transicion_invalida'), allowed targets, and ``paso`` (the
    event's 1-based position within its key).  An invalid request leaves the
    state unchanged.

    Hot keys are split: the rows are range-partitioned by (key, order) and
    checkpointed, so one key may span many partitions.  Because the machine
    is finite, each partition summarises its first and last key segment as a
    transfer function (start state → end state, plus the segment length);
    chaining those ≤ 2·N summaries in partition order gives the entry state
    and step offset of every key that continues from an earlier partition (a
    map of ≤ N entries, broadcast), and all partitions then replay in
    parallel from the correct state.  Inside a batch the transfer functions
    are composed by numpy, not row by row.  ``keep_pid`` returns the range
    partition ``_pid`` too, for running aggregates over the result (``scans``).
    """
    from terroir.session import ensure_checkpoint_dir
    spark = events.sparkSession
    ensure_checkpoint_dir(spark)
    m = _Machine(transitions, init)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    cols = [key, *order]
    ranged = (events.repartitionByRange(n, *cols).sortWithinPartitions(*cols)
              .withColumn("_pid", F.spark_partition_id()).checkpoint(eager=True))

    # pass 1: boundary summaries (first / last key segment of each partition)
    summary_schema = "_pid int, pos string, k string, fn array<int>, n long"

    def summarise(batches):
        segs, pid = [], None                        # [key, transfer function, rows]: the first and the current last
        for pdf in batches:
            if pdf.empty:
                continue
            pid = int(pdf["_pid"].iloc[0])
            segment, starts = _segments(pdf[key])
            f = m.composed(m.targets(pdf[target]), segment)
            ends = np.append(starts[1:], len(pdf))
            for b in sorted({0, len(starts) - 1}):
                k, fn, rows = pdf[key].iloc[starts[b]], f[ends[b] - 1], int(ends[b] - starts[b])
                if b == 0 and segs and segs[-1][0] == k:
                    segs[-1] = [k, fn[segs[-1][1]], segs[-1][2] + rows]
                else:
                    segs = [*segs[:1], [k, fn, rows]]
        if pid is None:
            return
        rows = [(pid, "first" if i == 0 else "last", str(k), fn.astype(int).tolist(), c) for i, (k, fn, c) in enumerate(segs)]
        yield pd.DataFrame(rows, columns=["_pid", "pos", "k", "fn", "n"])
    summ = sorted((r._pid, r.pos != "first", r.k, list(r.fn), r.n)
                  for r in ranged.mapInPandas(summarise, summary_schema).collect())   # ≤ 2 rows per partition

    # chain the summaries: entry (state, steps so far) of continuing keys
    entry: dict[int, tuple[str, int, int]] = {}
    carry = None                                    # (key, state, steps) after the previous partition
    by_pid: dict[int, list] = {}
    for pid, _, k, fn, cnt in summ:
        by_pid.setdefault(pid, []).append((k, fn, cnt))
    for pid in sorted(by_pid):
        segs = by_pid[pid]
        k0, fn0, c0 = segs[0]
        start, steps = (carry[1], carry[2]) if carry and carry[0] == k0 else (m.init, 0)
        if carry and carry[0] == k0:
            entry[pid] = (k0, start, steps)
        if len(segs) == 1:
            carry = (k0, fn0[start], steps + c0)
        else:
            kl, fnl, cl = segs[-1]
            carry = (kl, fnl[m.init], cl)
    entry_b = spark.sparkContext.broadcast(entry)     # ≤ N entries

    # pass 2: every partition replays in parallel from its entry state
    fields = events.schema.fields + ([T.StructField("_pid", T.IntegerType())] if keep_pid else [])
    out_schema = T.StructType(fields + REPLAY_FIELDS)
    names = [f.name for f in fields]

    def fold(batches):
        current, state, steps, first = object(), m.init, 0, True
        for pdf in batches:
            if pdf.empty:
                continue
            segment, starts = _segments(pdf[key])
            k0 = pdf[key].iloc[0]
            if k0 != current:
                e = entry_b.value.get(int(pdf["_pid"].iloc[0])) if first else None
                state, steps = (e[1], e[2]) if e is not None and e[0] == str(k0) else (m.init, 0)
            first = False
            begin = np.full(len(starts), m.init)
            offset = np.zeros(len(starts), dtype=np.int64)
            begin[0], offset[0] = state, steps
            w = m.targets(pdf[target])
            after = m.composed(w, segment)[np.arange(len(pdf)), begin[segment]].astype(np.int64)
            before = np.append(begin[0], after[:-1])
            before[starts] = begin
            done = m.ok[w, before]
            position = np.arange(len(pdf)) - starts[segment] + 1 + offset[segment]
            current, state, steps = pdf[key].iloc[-1], int(after[-1]), int(position[-1])
            yield pdf[names].assign(estado_anterior=m.names[before], estado=m.names[after],
                                    veredicto=np.where(done, APPLIED, INVALID), permitidos=m.allowed[before], paso=position)
    return ranged.mapInPandas(fold, out_schema)


def final_state(replayed: DataFrame, key: str) -> DataFrame:
    """State after the last event per key (max_by over the sequence)."""
    return replayed.groupBy(key).agg(F.max_by("estado", "paso").alias("estado_final"),
                                     F.count(F.lit(1)).alias("eventos"),
                                     F.count_if(F.col("veredicto") == INVALID).alias("rechazados"))


# ---------------------------------------------------------------- T05 / A22
def request_windows(requests: DataFrame, key: str = "user_id", ts: str = "ts", n: int = 60,
                    window_s: float = 60.0) -> DataFrame:
    """T05, re-aimed: the requests of the key in (t - window, t] and whether
    they exceed ``n``.  A range window over the log, cut into time buckets as
    long as the window: a row counts in its own bucket and, as a halo, in the
    next one, so a key's requests spread over as many tasks as it has
    buckets.  The server's admission decisions themselves are not replayed."""
    span = int(window_s * 1_000_000)
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    rows = requests.withColumns({"_us": us, "_own": F.explode(F.array(F.lit(True), F.lit(False)))})
    bucket = F.floor(F.col("_us") / span) + F.when(F.col("_own"), 0).otherwise(1)
    w = Window.partitionBy(key, "_bucket").orderBy("_us").rangeBetween(-span + 1, Window.currentRow)
    counted = rows.withColumn("_bucket", bucket).withColumn("en_ventana", F.count(F.lit(1)).over(w)).where("_own")
    return counted.withColumn("excede", F.col("en_ventana") > n).drop("_us", "_own", "_bucket")


def api_usage(windows: DataFrame, key: str = "user_id") -> DataFrame:
    """A22, re-aimed: calls per key, and how many came above the limit (the total is a rollup row)."""
    return (windows.rollup(key).agg(F.count(F.lit(1)).alias("llamadas"), F.count_if("excede").alias("excedidas"))
            .withColumn("ambito", F.when(F.col(key).isNull(), F.lit("total")).otherwise(F.lit("clave"))))


# ---------------------------------------------------------------- T06 / T07 / T08
def first_touch(leads: DataFrame, key: str = "clave", order: list[str] | None = None) -> DataFrame:
    """The earliest record per natural key fixes campaign/channel/market;
    later claims are flagged duplicate (min_by, no sort of the table)."""
    order = order or ["fecha", "seq"]
    o = F.struct(*[F.col(c) for c in order])
    first = leads.groupBy(key).agg(F.min(o).alias("_first"))
    return (leads.join(first, key).withColumn("duplicado", o != F.col("_first")).drop("_first"))


def attribute_conversions(conversions: DataFrame, leads: DataFrame, lead_key: str = "lead") -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected).  One conversion per (lead, stage) counts (the
    first); campaign, channel and market come from the lead's first touch.
    Rejected, with a reason: unknown stages, then conversions without a lead."""
    valid_stage = F.coalesce(F.col("etapa").isin(*STAGE_ORDER.keys()), F.lit(False))
    o = F.struct("fecha", "seq")
    firsts = (conversions.filter(valid_stage).groupBy(lead_key, "etapa")
              .agg(F.min_by(F.struct(*[c for c in conversions.columns if c not in (lead_key, "etapa")]), o)
                   .alias("_c")).select(lead_key, "etapa", "_c.*"))
    lead_attr = (leads.filter(~F.col("duplicado"))
                 .select(F.col("clave").alias(lead_key), F.col("campana").alias("campana_atribuida"),
                         F.col("canal").alias("canal_lead"), F.col("mercado").alias("mercado_lead")))
    accepted = firsts.join(lead_attr, lead_key, "inner")
    orphans = (conversions.filter(valid_stage).join(lead_attr.select(lead_key), lead_key, "left_anti")
               .withColumn("motivo", F.lit("lead_inexistente")))
    unknown = conversions.filter(~valid_stage).withColumn("motivo", F.lit("etapa_invalida"))
    return accepted, unknown.unionByName(orphans)


def accounts_from_conversions(accepted: DataFrame, existing: DataFrame, lead_key: str = "lead") -> DataFrame:
    """T07 hand-over: each lead's CLIENTE conversion becomes an account with the
    lead's key as fiscal id; an account that exists is linked, not doubled."""
    won = accepted.filter(F.col("etapa") == "CLIENTE").select(
        F.col(lead_key).alias("id_fiscal"), F.lit(None).cast("string").alias("email"),
        F.col("mercado_lead").alias("mercado"), F.col("id_tiempo"))
    return dedup_accounts(existing, won)


def lead_stage(conversions: DataFrame, lead_key: str = "lead") -> DataFrame:
    """T08 over the conversions that T07 accepted (one per lead and stage: a
    repeated stage never moves the lead).  Closed form of the stage fold: after the last PERDIDO only later
    events count, and among them the highest-order stage wins; with none the
    lead is PERDIDO (or LEAD when it never advanced)."""
    order = F.element_at(F.create_map(*[x for k, v in STAGE_ORDER.items() for x in (F.lit(k), F.lit(v))]),
                         F.col("etapa"))
    c = conversions.withColumn("_o", order).withColumn("_t", F.struct("fecha", "seq"))
    last_lost = c.filter(F.col("etapa") == "PERDIDO").groupBy(lead_key).agg(F.max("_t").alias("_lost"))
    j = c.join(last_lost, lead_key, "left")
    after = j.filter(F.col("_lost").isNull() | (F.col("_t") > F.col("_lost")))
    best = after.filter(F.col("_o") >= 0).groupBy(lead_key).agg(F.max_by("etapa", F.struct("_o", "_t")).alias("_b"))
    leads = c.select(lead_key).distinct()
    return (leads.join(best, lead_key, "left").join(last_lost, lead_key, "left")
            .select(lead_key, F.coalesce(F.col("_b"), F.when(F.col("_lost").isNotNull(), F.lit("PERDIDO")),
                                         F.lit("LEAD")).alias("etapa")))


# ---------------------------------------------------------------- T10
def ticket_sla(transitions: DataFrame, key: str = "ticket", replayed: DataFrame | None = None) -> DataFrame:
    """Ticket replay + SLA per ticket: first response once (first
    applied EN_PROCESO, or RESUELTO directly); resolution minutes from
    opening, rewritten by every applied RESUELTO, and set by a direct CERRADO
    only while there are none (so: the last RESUELTO, else the first CERRADO)."""
    r = replay(transitions, key, ["fecha", "seq"], "estado_solicitado", TICKET, "ABIERTO")
    applied = r.filter(F.col("veredicto") == APPLIED)
    opened = transitions.groupBy(key).agg(F.min("fecha").alias("abierto"))
    agg = applied.groupBy(key).agg(
        F.min(F.when(F.col("estado").isin("EN_PROCESO", "RESUELTO"), F.col("fecha"))).alias("primera_respuesta"),
        F.coalesce(F.max(F.when(F.col("estado") == "RESUELTO", F.col("fecha"))),
                   F.min(F.when(F.col("estado") == "CERRADO", F.col("fecha")))).alias("resuelto"))
    fin = final_state(r, key)
    from terroir.functions import round_half_up
    mins = lambda a, b: round_half_up((F.unix_micros(b.cast("timestamp"))
                                       - F.unix_micros(a.cast("timestamp"))) / 6e7, 2)
    return (opened.join(agg, key, "left").join(fin, key)
            .select(key, "estado_final", "eventos", "rechazados",
                    mins(F.col("abierto"), F.col("primera_respuesta")).alias("minutos_primera_respuesta"),
                    mins(F.col("abierto"), F.col("resuelto")).alias("minutos_resolucion")))


# ---------------------------------------------------------------- T11
def onboarding_state(advances: DataFrame, key: str = "cuenta") -> DataFrame:
    """T11 closed form: completed steps = min(#advances, 5); state
    COMPLETADO at 5 (terminal), EN_PROGRESO when > 0, else PENDIENTE."""
    total = len(ONBOARDING_STEPS)
    steps = F.array(*[F.lit(s) for s in ONBOARDING_STEPS])
    g = advances.groupBy(key).agg(F.least(F.count(F.lit(1)), F.lit(total)).alias("pasos_completados"))
    return g.select(key, "pasos_completados", F.lit(total).alias("pasos_totales"),
                    F.when(F.col("pasos_completados") >= total, "COMPLETADO")
                    .when(F.col("pasos_completados") > 0, "EN_PROGRESO").otherwise("PENDIENTE").alias("estado"),
                    F.element_at(steps, F.least(F.col("pasos_completados") + 1, F.lit(total)).cast("int"))
                    .alias("paso_actual"))


def onboarding_replay(requests: DataFrame, key: str = "cuenta") -> DataFrame:
    """T11 with each account's own step list: requests (cuenta, pasos, accion in avanzar / estado,
    estado_solicitado, fecha, seq) replayed over the product of status and steps done.

    An advance does the next step and leads to EN_PROGRESO, the last one to COMPLETADO, from any other
    status; after that nothing changes.  Explicit moves follow the ONBOARDING table; a move to COMPLETADO
    counts all steps as done.  While an account is open its steps done are its advances so far, a running
    count over range partitions; which advance is the last one is then known before the status machine
    is replayed, and hot accounts are split in both."""
    from terroir.operators.scans import ranged, running, stored
    advance = F.col("accion") == "avanzar"
    total = F.greatest(F.size("pasos"), F.lit(1))
    r = ranged(requests.withColumn("_total", total), [key], ["fecha", "seq"])
    r = running(r, [key], ["fecha", "seq"], {"_done": ("sum", advance.cast("long"))}).drop("_pid", "_local")
    # what an advance reaches has names of its own: only explicit moves are held to the table
    target = (F.when(advance, F.when(F.col("_done") + 1 >= F.col("_total"), "FIN").otherwise("AVANCE"))
              .when(F.col("accion") == "estado", F.upper("estado_solicitado")))
    table = {s: [*to, "AVANCE", "FIN"] if to else [] for s, to in ONBOARDING.items()}
    table |= {"AVANCE": table["EN_PROGRESO"], "FIN": []}
    f = replay(r.withColumn("_target", F.when(target.isin("AVANCE", "FIN") & ~advance, F.lit(None)).otherwise(target)), key,
               ["fecha", "seq"], "_target", table, "PENDIENTE", keep_pid=True)

    def status(c):
        return F.when(F.col(c) == "AVANCE", "EN_PROGRESO").when(F.col(c) == "FIN", "COMPLETADO").otherwise(F.col(c))
    closed = advance & (status("estado_anterior") == "COMPLETADO")
    f = stored(f.withColumns({"estado_anterior": status("estado_anterior"), "estado": status("estado"),
                              "veredicto": F.when(closed, "sin_cambio").otherwise(F.col("veredicto"))}))
    did = (advance & (F.col("veredicto") == APPLIED)).cast("long")
    f = running(f.drop("_done"), [key], ["paso"], {"_done": ("sum", did)}).withColumn("_done", F.col("_done") + did)
    # an explicit move leaves the present step as it is
    step = F.get("pasos", F.least(F.col("_done"), F.size("pasos") - 1).cast("int"))
    done = F.when(F.col("estado") == "COMPLETADO", F.col("_total")).otherwise(F.col("_done")).cast("int")
    return f.select(*requests.columns, "estado_anterior", "estado", "veredicto", done.alias("pasos_completados"), step.alias("paso_actual"), "paso")


# ---------------------------------------------------------------- T12
def run_due_campaigns(campaigns: DataFrame, events: DataFrame, now: str, period: int) -> tuple[DataFrame, DataFrame]:
    """(funnel rows to upsert, campaigns after the run).  Due = PROGRAMADA
    with schedule <= now or none.  One row per (campaign, period): a repeated
    run rewrites it with the next ``corrida``; only a new period adds to the
    campaign's ``ejecuciones``.  ``events`` holds the keys written before."""
    from terroir.functions import default_funnel
    due = campaigns.filter((F.col("estado") == "PROGRAMADA")
                           & (F.col("programada").isNull() | (F.col("programada") <= F.lit(now).cast("timestamp_ntz"))))
    key = F.concat_ws(":", F.lit("camp"), F.col("campana").cast("string"), F.lit(str(period)))
    before = events.select("clave", F.col("corrida").alias("_before"))
    runs = due.withColumn("clave", key).join(before, "clave", "left")
    rows = runs.select("campana", F.lit(period).alias("id_tiempo"), "clave", (F.coalesce("_before", F.lit(0)) + 1).cast("int").alias("corrida"),
                       *[v.alias(k) for k, v in default_funnel("presupuesto").items()])
    mark = runs.select("campana", F.col("_before").isNull().cast("int").alias("_new"))
    after = (campaigns.join(mark, "campana", "left")
             .withColumn("estado", F.when(F.col("_new").isNotNull(), "EN_EJECUCION").otherwise(F.col("estado")))
             .withColumn("ejecuciones", (F.coalesce("ejecuciones", F.lit(0)) + F.coalesce("_new", F.lit(0))).cast("int")).drop("_new"))
    return rows, after


# ---------------------------------------------------------------- T19 / T21
def entitlement(subs: DataFrame, key: str = "cliente") -> DataFrame:
    """Access iff the client has a subscription in {ACTIVA, PRUEBA};
    the first such (by date) grants it."""
    ok = subs.filter(F.col("estado").isin("ACTIVA", "PRUEBA"))
    return ok.groupBy(key).agg(F.min_by("suscripcion", F.struct("fecha", "suscripcion")).alias("suscripcion"),
                               F.lit(True).alias("acceso"))


def _blank(c: str):
    return F.coalesce(F.trim(F.col(c)), F.lit(""))


def _undecided_firsts(rows: DataFrame) -> DataFrame:
    """The undecided rows that come first among the undecided of their fiscal id and of their e-mail."""
    out = rows
    for k in ("_tax", "_mail"):
        first = rows.filter(F.col(k) != "").groupBy(k).agg(F.min("_pos").alias(f"_first{k}"))
        out = out.join(first, k, "left").filter(F.coalesce(F.col(f"_first{k}"), F.col("_pos")) == F.col("_pos")).drop(f"_first{k}")
    return out.select(*rows.columns)


def _without_rivals(rows: DataFrame, kept: DataFrame) -> DataFrame:
    """``rows`` less the kept ones and those that share a fiscal id or e-mail with one."""
    for k in ("_tax", "_mail"):
        rows = rows.join(kept.filter(F.col(k) != "").select(k), k, "left_anti")
    return rows.join(kept.select("_pos"), "_pos", "left_anti")


def dedup_accounts(existing: DataFrame, incoming: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Match by fiscal id, then by lower-cased e-mail; at least one is
    required; returns the existing id (or NULL when new / invalid).

    With ``order`` (a total order of ``incoming``) the batch is also matched against itself, as if its rows
    were signed up one after the other: an accepted row is an account for the later ones, a rejected one is
    not.  That is an ordered greedy selection, made in rounds: an undecided row that is the earliest
    undecided holder of both its keys is accepted, the rows that share a key with it are rejected, and so
    on until none is undecided.  Every round accepts at least the earliest undecided row; chains of rows
    that hang on each other are short, so rounds are few.  ``orden_existente`` is then the ``order`` value
    of the batch's account, ``campo`` the key that matched."""
    inc = incoming.withColumns({"_tax": _blank("id_fiscal"), "_mail": F.lower(_blank("email"))})
    # one row per lookup key (the oldest account): the joins cannot fan out
    by_tax = (existing.filter(_blank("id_fiscal") != "").groupBy(F.trim("id_fiscal").alias("_tax")).agg(F.min("id").alias("_id_tax")))
    by_mail = (existing.filter(_blank("email") != "").groupBy(F.lower(F.trim("email")).alias("_mail")).agg(F.min("id").alias("_id_mail")))
    j = inc.join(by_tax, "_tax", "left").join(by_mail, "_mail", "left")
    has_key = (F.col("_tax") != "") | (F.col("_mail") != "")
    if order is None:
        found = F.coalesce("_id_tax", "_id_mail")
        return j.select(*incoming.columns, found.alias("id_existente"),
                        F.when(~has_key, "identificacion_requerida").when(found.isNotNull(), "duplicada").otherwise("nueva").alias("resultado"))
    from terroir.operators.scans import stored
    rows = stored(j.withColumn("_pos", F.struct(*order)))
    undecided = stored(rows.filter(has_key & F.col("_id_tax").isNull() & F.col("_id_mail").isNull()).select("_pos", "_tax", "_mail"))
    kept = None
    while not undecided.isEmpty():
        now = stored(_undecided_firsts(undecided))
        kept = now if kept is None else kept.unionByName(now)
        undecided = stored(_without_rivals(undecided, now))
    kept = undecided if kept is None else kept
    taken = rows.join(kept.select(F.col("_pos").alias("_kept")), F.col("_pos") == F.col("_kept"), "left")
    for k in ("_tax", "_mail"):                                # at most one account of the batch per key value
        holder = kept.filter(F.col(k) != "").select(k, F.col("_pos").alias(f"_in{k}"))
        taken = taken.join(holder, k, "left").withColumn(f"_in{k}", F.when(F.col(f"_in{k}") < F.col("_pos"), F.col(f"_in{k}")))
    by = (F.when(F.coalesce(F.col("_id_tax").isNotNull(), F.lit(False)) | F.col("_in_tax").isNotNull(), "id_fiscal")
          .when(F.col("_id_mail").isNotNull() | F.col("_in_mail").isNotNull(), "email"))
    new = F.col("_kept").isNotNull()
    return taken.select(
        *incoming.columns, F.when(~new, F.when(by == "id_fiscal", F.col("_id_tax")).otherwise(F.col("_id_mail"))).alias("id_existente"),
        F.when(~new, F.when(by == "id_fiscal", F.when(F.col("_id_tax").isNull(), F.col("_in_tax")))
               .otherwise(F.when(F.col("_id_mail").isNull(), F.col("_in_mail")))).alias("orden_existente"),
        F.when(~new, by).alias("campo"),
        F.when(~has_key, "identificacion_requerida").when(new, "nueva").otherwise("duplicada").alias("resultado"))


# ---------------------------------------------------------------- T04
def alert_moves(alerts: DataFrame, moves: DataFrame, key: str = "alerta") -> tuple[DataFrame, DataFrame]:
    """(alerts after the moves, moves on unknown alerts).  Every move to RECONOCIDA, RESUELTA or
    SILENCIADA is accepted whatever the present state, and stamps ``ultima_vez``; the last one stays."""
    o = F.struct("fecha", "seq")
    last = moves.groupBy(key).agg(F.max_by("estado_solicitado", o).alias("_to"), F.max("fecha").alias("_at"), F.count(F.lit(1)).alias("_n"))
    after = (alerts.join(last, key, "left")
             .withColumns({"estado": F.coalesce("_to", "estado"), "ultima_vez": F.coalesce("_at", "ultima_vez"),
                           "movimientos": F.coalesce("_n", F.lit(0))}).drop("_to", "_at", "_n"))
    return after, moves.join(alerts.select(key), key, "left_anti").withColumn("motivo", F.lit("alerta_inexistente"))


# ---------------------------------------------------------------- T20
def source_state(requests: DataFrame) -> DataFrame:
    """Per source, from its requests (fuente, accion, metadatos_ok, conexion_ok, estado_ingesta, fecha,
    seq): state, rejection reason, and the stamps of its ingests.

    Enabling checks the metadata first (invalid: refused, nothing changes), then the connection (failed: the
    source becomes RECHAZADA with the reason); a rejected or disabled source may be enabled again.
    Disabling always succeeds.  ``ultimo_estado_ingesta`` is that of the last run, ``ultima_ingesta`` the
    time of the last COMPLETADA or PARCIAL one.  No request depends on the state before it, so all of it
    is one aggregate."""
    o = F.struct("fecha", "seq")
    action = F.col("accion")
    enable = action == "habilitar"
    refused = enable & ~F.col("metadatos_ok")
    to = F.when(enable & F.col("metadatos_ok"), F.when(F.col("conexion_ok"), "HABILITADA").otherwise("RECHAZADA")).when(
        action == "deshabilitar", "DESHABILITADA")
    # disabling leaves the reason as it is
    reason = F.when(to == "HABILITADA", "").when(to == "RECHAZADA", "conexion_fallida")
    run = F.when(action == "ingesta", F.col("estado_ingesta"))

    def last(value, when):
        return F.max_by(value, F.when(when.isNotNull(), o))
    return requests.groupBy("fuente").agg(
        F.coalesce(last(to, to), F.lit("REGISTRADA")).alias("estado"), F.coalesce(last(reason, reason), F.lit("")).alias("motivo_rechazo"),
        last(run, run).alias("ultimo_estado_ingesta"),
        F.max(F.when(run.isin("COMPLETADA", "PARCIAL"), F.col("fecha"))).alias("ultima_ingesta"),
        F.count_if(refused).alias("rechazos_metadatos"))
