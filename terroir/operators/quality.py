"""Data-quality expectations (Q01-Q05, Q07), suite runner and gate (Q08),
and quality-seal freshness (Q09).

All per-column checks of one dataset compile into ONE aggregate (one scan);
uniqueness and foreign-key checks need a shuffle each and run as separate
aggregates.  A bounded sample of violating rows is attached to failures.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terroir.operators.windows import latest_by


@dataclass
class Check:
    name: str
    column: str
    kind: str                      # not_null | between | in_set | unique | fk | rows | column
    args: dict = field(default_factory=dict)
    mostly: float = 1.0


def expect_not_null(c: str) -> Check:            # Q01
    return Check(f"not_null:{c}", c, "not_null")


def expect_unique(c: str) -> Check:              # Q02
    return Check(f"unique:{c}", c, "unique")


def expect_fk(c: str, dim: DataFrame, key: str) -> Check:   # Q03
    return Check(f"fk:{c}", c, "fk", {"dim": dim, "key": key})


def expect_in(c: str, values) -> Check:          # Q04
    return Check(f"in_set:{c}", c, "in_set", {"values": list(values)})


def expect_between(c: str, lo, hi, mostly: float = 1.0) -> Check:   # Q05
    return Check(f"between:{c}", c, "between", {"lo": lo, "hi": hi}, mostly)


def expect_rows(min_rows: int = 1) -> Check:     # Q07
    return Check("rows", "*", "rows", {"min": min_rows})


def expect_column(c: str) -> Check:              # Q07
    return Check(f"column:{c}", c, "column")


def _violation(ch: Check) -> Column | None:
    c = F.col(ch.column)
    if ch.kind == "not_null":
        return c.isNull()
    if ch.kind == "between":
        return c.isNotNull() & ~c.between(ch.args["lo"], ch.args["hi"])
    if ch.kind == "in_set":
        return c.isNotNull() & ~c.isin(*ch.args["values"])
    return None


def _evaluated(ch: Check) -> Column:
    # range / set checks are evaluated over non-null values ("mostly" semantics)
    if ch.kind in ("between", "in_set"):
        return F.count(F.col(ch.column))
    return F.count(F.lit(1))


def _offending(df: DataFrame, checks: list[Check]) -> DataFrame:
    """(i, v, n): the offending values of each check (its number) with their rows, all checks in one pass.

    Each row lists a value per row-local check that it violates, and its keys for the uniqueness and
    relationship checks; what is offending among those shows once equal values are counted."""
    listed = []
    for i, ch in enumerate(checks):
        c = F.col(ch.column)
        hit = _violation(ch) if ch.kind in ("not_null", "between", "in_set") else c.isNotNull()
        listed.append(F.when(hit, F.struct(F.lit(i).alias("i"), c.cast("string").alias("v"))))
    counts = (df.select(F.inline(F.array_compact(F.array(*listed)))).groupBy("i", "v").agg(F.count(F.lit(1)).alias("n")))
    types = dict(df.dtypes)
    keys = [ch.args["dim"].select(F.lit(i).alias("i"), F.col(ch.args["key"]).cast(types[ch.column]).cast("string").alias("v"))
            for i, ch in enumerate(checks) if ch.kind == "fk"]
    unique = [i for i, ch in enumerate(checks) if ch.kind == "unique"]
    if unique:
        counts = counts.filter(~F.col("i").isin(unique) | (F.col("n") > 1))
    return counts.join(reduce(DataFrame.unionAll, keys), ["i", "v"], "left_anti") if keys else counts


RESULTS = "dataset string, expectativa string, evaluadas long, fallidas long, exito boolean, muestra string"


def run_suite(dataset: str, df: DataFrame, checks: list[Check], sample: int = 3) -> DataFrame:
    """Q08: results (dataset, check, evaluated, failed, success, sample).

    One job per dataset: the evaluated rows of every check in one aggregate, and beside it the offending
    values counted by (check, value), of which the total and the ``sample`` smallest are kept per check."""
    spark = df.sparkSession
    cols = set(df.columns)
    row_kinds = ("not_null", "between", "in_set", "unique", "fk")
    real = [ch for ch in checks if ch.kind in row_kinds and ch.column in cols]
    evaluated = df.agg(F.count(F.lit(1)).alias("_n"), *[_evaluated(ch).alias(f"e{i}") for i, ch in enumerate(real)])
    counts = evaluated.select(F.inline(F.array(
        F.struct(F.lit(-1).alias("i"), F.col("_n").alias("e")), *[F.struct(F.lit(i).alias("i"), F.col(f"e{i}").alias("e")) for i in range(len(real))])))
    if real:
        bad = _offending(df, real)
        rank = F.row_number().over(Window.partitionBy("i").orderBy("v"))
        few = (bad.filter(F.col("v").isNotNull()).withColumn("_r", rank).filter(F.col("_r") <= sample)      # pruned before the exchange
               .groupBy("i").agg(F.array_join(F.array_sort(F.collect_list("v")), ",").alias("s")))
        counts = counts.join(bad.groupBy("i").agg(F.sum("n").alias("f")).join(few, "i", "left"), "i", "left")
    found = {r["i"]: r for r in counts.collect()}                      # a row per check
    n, number, rows = found[-1]["e"], 0, []
    for ch in checks:
        if ch.kind == "rows":
            rows.append((dataset, ch.name, int(n), 0 if n >= ch.args["min"] else 1, n >= ch.args["min"], ""))
        elif ch.kind == "column" or ch.column not in cols:
            present = ch.column in cols
            rows.append((dataset, ch.name if ch.kind == "column" else f"column:{ch.column}", 1, 0 if present else 1, present, ""))
        else:
            r, number = found[number], number + 1
            ev, fl = r["e"], r["f"] or 0
            ok = (fl == 0) if ch.mostly >= 1.0 else (ev == 0 or (ev - fl) / ev >= ch.mostly)
            rows.append((dataset, ch.name, int(ev), int(fl), bool(ok), r["s"] or ""))
    return spark.createDataFrame(rows, RESULTS)


def datasets_present(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Q07: one 'dataset' check per path; an absent table is a failed check, not an error."""
    from terroir.plans.materialize import exists
    rows = [(n, "dataset", 1, 0 if ok else 1, ok, "") for n, ok in ((n, exists(spark, p)) for n, p in paths.items())]
    return spark.createDataFrame(rows, RESULTS)


def suite_plan(dataset: str, df: DataFrame, checks: list[Check]) -> DataFrame:
    """The row-local part of a suite as a lazy one-row-per-check DataFrame
    (single aggregate, then ``stack``) — usable as a query plan."""
    local = [ch for ch in checks if ch.kind in ("not_null", "between", "in_set")]
    aggs = []
    for i, ch in enumerate(local):
        aggs += [_evaluated(ch).alias(f"e{i}"), F.count_if(_violation(ch)).alias(f"f{i}")]
    one = df.agg(*aggs)
    args = ", ".join(f"'{ch.name}', e{i}, f{i}" for i, ch in enumerate(local))
    long = one.select(F.expr(f"stack({len(local)}, {args}) as (expectativa, evaluadas, fallidas)"))
    mostly = F.create_map(*[x for ch in local for x in (F.lit(ch.name), F.lit(float(ch.mostly)))])
    m = F.element_at(mostly, F.col("expectativa"))
    ok = F.when(m >= 1.0, F.col("fallidas") == 0).otherwise(
        (F.col("evaluadas") == 0) | ((F.col("evaluadas") - F.col("fallidas")) / F.col("evaluadas") >= m))
    return long.select(F.lit(dataset).alias("dataset"), "expectativa", F.col("evaluadas").cast("long"),
                       F.col("fallidas").cast("long"), ok.alias("exito"))


class QualityGateError(RuntimeError):
    """Raised by ``gate`` to stop promotion (non-zero exit in a job)."""


def gate(results: DataFrame) -> DataFrame:
    """Q08 fail-fast: per dataset AND of its checks; raise when any failed."""
    per = results.groupBy("dataset").agg(F.bool_and("exito").alias("exito"),
                                         F.count(F.lit(1)).alias("evaluadas"),
                                         F.count_if(~F.col("exito")).alias("fallidas"))
    failed = per.filter(~F.col("exito")).select("dataset").collect()
    if failed:
        raise QualityGateError("suites fallidas: " + ", ".join(r.dataset for r in failed))
    return per


# ---------------------------------------------------------------- Q09
DEFAULT_VALIDITY_HOURS = 24.0


def seal_status(seals: DataFrame, now: str, suite: str | None = None) -> DataFrame:
    """Q09: newest seal (per suite) → ok iff success and age ≤ its validity.
    Reasons: sin_sello (none, via an outer spine), fallido, fecha_invalida,
    vencido."""
    s = seals if suite is None else seals.filter(F.col("suite") == suite)
    newest = latest_by(s.withColumn("_ts", F.col("fecha").cast("timestamp")), ["suite"], "_ts")
    age_h = (F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp("_ts")) / 3600.0
    validity = F.coalesce(F.col("vigencia_horas"), F.lit(DEFAULT_VALIDITY_HOURS))
    reason = (F.when(~F.col("exito"), "fallido").when(F.col("_ts").isNull(), "fecha_invalida")
              .when(age_h > validity, "vencido").otherwise(""))
    out = newest.select("suite", "exito", "_ts", reason.alias("motivo"))
    if suite is not None:
        spine = seals.sparkSession.createDataFrame([(suite,)], "suite string")
        out = spine.join(out, "suite", "left").withColumn(
            "motivo", F.coalesce(F.col("motivo"), F.lit("sin_sello")))
    return out.select("suite", (F.col("motivo") == "").alias("ok"), "motivo", F.col("_ts").alias("fecha"))


def union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def warehouse_suites(spark: SparkSession, star: dict[str, DataFrame]) -> list[tuple[str, DataFrame, list[Check]]]:
    """The warehouse suite of the reviews star (fact ranges, key uniqueness,
    relationships to every dimension)."""
    f = star["fact_resenas"]
    checks = [expect_rows(1), expect_not_null("id_resena"), expect_unique("id_resena"),
              expect_between("points", 80, 100, 0.7), expect_between("price", 0, 100000),
              *[expect_fk(k, star[d], k) for d, k in (("dim_pais", "id_pais"), ("dim_variedad", "id_variedad"),
                                                     ("dim_bodega", "id_bodega"), ("dim_region", "id_region"),
                                                     ("dim_catador", "id_catador"))]]
    dims = [(d, star[d], [expect_rows(1), expect_not_null("nombre"), expect_unique("nombre")])
            for d in ("dim_pais", "dim_variedad", "dim_bodega")]
    return [("fact_resenas", f, checks), *dims]
