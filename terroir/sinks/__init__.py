"""Writers (K01-K13).

Plain Parquet has no MERGE: small tables are rewritten into a *new version
directory*; the highest complete version is the live one (readers never see a
half-written table and a plan never overwrites the path it reads).  Keyed
upserts (K09) go to a hash-bucketed table whose versions are manifests: only
the buckets that a batch touches are read, merged and written.  Partition-scoped replacement uses
``partitionOverwriteMode=dynamic``.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Export headers (K12) in output order.
EXPORT_HEADERS = ["titulo", "pais", "variedad", "bodega", "provincia", "region", "catador", "puntos", "precio"]


# ---------------------------------------------------------------- K01/K02
def land(df: DataFrame, base: str, source: str, ingest_date: str, kind: str = "resenas") -> str:
    """Snappy Parquet at ``base/kind/fuente=/fecha_ingesta=``; only that
    partition is replaced (idempotent re-runs)."""
    out = f"{base.rstrip('/')}/{kind}"
    (df.withColumn("fuente", F.lit(source)).withColumn("fecha_ingesta", F.lit(ingest_date))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "snappy")
     .partitionBy("fuente", "fecha_ingesta").parquet(out))
    return out


def land_rejects(rejects: DataFrame, base: str, source: str, ingest_date: str) -> str | None:
    """Reject sink with reason, source and date; skipped when empty."""
    if rejects.isEmpty():
        return None
    return land(rejects, base, source, ingest_date, kind="rejects")


# ---------------------------------------------------------------- K03/K05/K06
def snapshot(df: DataFrame, path: str) -> None:
    """Full overwrite."""
    df.write.mode("overwrite").parquet(path)


def refresh(tables: dict[str, DataFrame], base: str, order: list[str] | None = None) -> list[str]:
    """Ordered full refresh (dimensions first, then the fact)."""
    names = order or sorted(tables, key=lambda n: (not n.startswith("dim"), n))
    for n in names:
        tables[n].write.mode("overwrite").parquet(f"{base.rstrip('/')}/{n}")
    return names


# ---------------------------------------------------------------- K04/K13
def write_report(report: DataFrame, base: str, partition: str = "fecha") -> None:
    """Report rows as JSON, overwrite by date partition."""
    (report.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition).json(base))


# ---------------------------------------------------------------- K07
def publish(df: DataFrame, spec: list[tuple[str, str]]) -> DataFrame:
    """Typed transport — explicit column order, NULL → ''/0/0.0."""
    def default(t):
        t = t.lower()
        if t in ("string", "varchar"):
            return F.lit("")
        if t in ("double", "float") or t.startswith("decimal"):
            return F.lit(0.0)
        return F.lit(0)
    return df.select(*[F.coalesce(F.col(c).cast(t), default(t).cast(t)).alias(c) for c, t in spec])


# ---------------------------------------------------------------- K08
def replace_period(df: DataFrame, path: str, period_col: str = "id_tiempo") -> None:
    """Rows of the periods present in ``df`` replace those periods only."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(period_col).parquet(path))


# ---------------------------------------------------------------- K09
def merge_frames(target: DataFrame, src: DataFrame, keys: list[str], keep_from_target: list[str] | None = None,
                 counter: str | None = None) -> DataFrame:
    """Upsert as a DataFrame: full outer join on keys; source values win
    except ``keep_from_target`` columns; ``counter`` is incremented for
    re-emitted keys (e.g. a run counter)."""
    keep = set(keep_from_target or [])
    t = target.alias("t")
    s = src.alias("s")
    cond = reduce(lambda a, b: a & b, [F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys])
    j = t.join(s, cond, "full_outer")
    cols = []
    for c in target.columns:
        if c in keys:
            cols.append(F.coalesce(F.col(f"s.{c}"), F.col(f"t.{c}")).alias(c))
        elif c == counter:
            cols.append(F.when(F.col(f"t.{keys[0]}").isNotNull() & F.col(f"s.{keys[0]}").isNotNull(),
                               F.col(f"t.{c}") + 1)
                        .otherwise(F.coalesce(F.col(f"t.{c}"), F.col(f"s.{c}") if c in src.columns else F.lit(1)))
                        .alias(c))
        elif c in keep or c not in src.columns:
            cols.append(F.coalesce(F.col(f"t.{c}"), F.col(f"s.{c}") if c in src.columns else F.lit(None)).alias(c))
        else:
            present = reduce(lambda a, b: a & b, [F.col(f"s.{k}").isNotNull() for k in keys])
            cols.append(F.when(present, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
    return j.select(*cols)


KEEP_VERSIONS = 3


def _versions(spark: SparkSession, path: str) -> list[str]:
    from terroir.plans.materialize import complete_children
    return [n for n in complete_children(spark, path) if n.startswith("v-")]


def read_versioned(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    """The live version of a versioned table (None when it has none yet): the
    highest complete one.  There is no pointer to swap, so a crash at any
    moment leaves the version before it readable."""
    found = _versions(spark, path)
    if not found:
        return None
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(f"{path.rstrip('/')}/{found[-1]}")


def write_version(spark: SparkSession, path: str, df: DataFrame) -> DataFrame:
    """Write ``df`` as the next version; it becomes live with its success
    marker.  All but the newest ``KEEP_VERSIONS`` are removed (a reader may
    still hold the ones before the live version)."""
    from terroir.plans.materialize import remove
    found = _versions(spark, path)
    number = int(found[-1].split("-")[1]) + 1 if found else 1
    df.write.mode("errorifexists").parquet(f"{path.rstrip('/')}/v-{number:012d}-{uuid.uuid4().hex[:8]}")
    for old in _versions(spark, path)[:-KEEP_VERSIONS]:
        remove(spark, f"{path.rstrip('/')}/{old}")
    return read_versioned(spark, path)


BUCKETS = 16
MANIFEST = "bucket int, folder string, buckets int, keys string"


def _manifest(spark: SparkSession, path: str) -> list:
    """The live manifest: a row per bucket with the folder of its files (at most as many rows as buckets)."""
    live = read_versioned(spark, f"{path.rstrip('/')}/manifest", MANIFEST)
    return [] if live is None else live.collect()


def _bucket(keys: list[str], n: int):
    return F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int")


def _bucket_files(spark: SparkSession, path: str, entries: list, schema) -> DataFrame:
    folders = [f"{path.rstrip('/')}/data/{e['folder']}/_bucket={e['bucket']}" for e in entries]
    return spark.read.schema(schema).parquet(*folders)


def read_bucketed(spark: SparkSession, path: str) -> DataFrame | None:
    """The live version of a bucketed table (None when it has none yet)."""
    entries = _manifest(spark, path)
    if not entries:
        return None
    first = f"{path.rstrip('/')}/data/{entries[0]['folder']}/_bucket={entries[0]['bucket']}"
    return _bucket_files(spark, path, entries, spark.read.parquet(first).schema)


def upsert(spark: SparkSession, path: str, src: DataFrame, keys: list[str],
           keep_from_target: list[str] | None = None, counter: str | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Keyed upsert into a hash-bucketed Parquet table; returns the new table.

    Rows lie in ``buckets`` folders by the hash of their key.  A merge reads and writes only the buckets
    that ``src`` touches; the next manifest names their new folders and the old folders of all others,
    whose files stay as they are.  A version is live once its manifest is complete, so a crash at any
    moment leaves the one before.  Folders that no kept manifest names are removed.  The number of buckets
    and the keys are fixed by the first write.  Several rows of ``src`` with one key are an error of the
    caller (the reference writes one record at a time).
    """
    from terroir.plans.materialize import complete_children, remove
    base, entries = path.rstrip("/"), _manifest(spark, path)
    n = entries[0]["buckets"] if entries else buckets
    if entries and entries[0]["keys"] != ",".join(keys):
        raise ValueError(f"the table is bucketed by {entries[0]['keys']}")
    present = {e["bucket"]: e for e in entries}
    schema = read_bucketed(spark, path).schema if entries else src.schema
    rows = src.select(*[f.name for f in schema]).withColumn("_bucket", _bucket(keys, n))
    touched = sorted(r[0] for r in rows.select("_bucket").distinct().collect())                 # at most n rows
    old = [present[b] for b in touched if b in present]
    merged = rows.drop("_bucket")
    if old:
        merged = merge_frames(_bucket_files(spark, path, old, schema), merged, keys, keep_from_target, counter)
    folder = uuid.uuid4().hex
    (merged.withColumn("_bucket", _bucket(keys, n)).repartition(max(1, len(touched)), "_bucket")
     .write.mode("errorifexists").partitionBy("_bucket").parquet(f"{base}/data/{folder}"))
    lines = [(b, e["folder"], n, e["keys"]) for b, e in present.items() if b not in touched] + [(b, folder, n, ",".join(keys)) for b in touched]
    write_version(spark, f"{base}/manifest", spark.createDataFrame(sorted(lines), MANIFEST).coalesce(1))
    kept = spark.read.schema(MANIFEST).parquet(*[f"{base}/manifest/{v}" for v in _versions(spark, f"{base}/manifest")])
    named = {r[0] for r in kept.select("folder").distinct().collect()}                          # at most KEEP_VERSIONS * n rows
    for name in complete_children(spark, f"{base}/data"):
        if name not in named:
            remove(spark, f"{base}/data/{name}")
    return read_bucketed(spark, path)


# ---------------------------------------------------------------- K10/K11
def insert_absent(target: DataFrame, src: DataFrame, keys: list[str]) -> DataFrame:
    """The source rows whose keys are new (to be appended)."""
    return src.dropDuplicates(keys).join(target.select(*keys), keys, "left_anti")


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


# ---------------------------------------------------------------- K12
def export_rows(star_rows: DataFrame, limit: int | None = None) -> DataFrame:
    """Export projection — 9 Spanish headers, points int, price with
    2 decimals or '' when 0/NULL, by points desc; every row unless the caller
    asks for the first ``limit``."""
    price = F.when(F.col("price") > 0, F.format_string("%.2f", F.col("price").cast("double"))).otherwise(F.lit(""))
    rows = star_rows.orderBy(F.col("points").desc(), F.col("id_resena").asc())
    return ((rows if limit is None else rows.limit(limit))
            .select(F.col("title").alias("titulo"), "pais", "variedad", "bodega", "provincia", "region",
                    "catador", F.col("points").cast("int").alias("puntos"), price.alias("precio")))


def export_csv(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("header", True).csv(path)
