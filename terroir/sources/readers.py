"""Readers (S01-S09).

Schemas are explicit (never ``inferSchema``).  Contract checks of a source
are compiled into a *single* aggregate over the file; only a bounded sample
of offending values is collected for the error message.
"""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terroir.functions import lenient_int, lenient_price, strip, truncate

# The 18-column clickstream contract, in file order.
CONTRACT_COLUMNS = ["session_id", "user_id", "timestamp_utc", "event_index", "user_action", "product_id", "category",
                    "brand", "price", "channel", "device_type", "region", "traffic_source", "time_spent_sec",
                    "session_length", "interaction_count", "is_conversion", "drop_off_flag"]
CONTRACT_TYPES = {"timestamp_utc": "timestamp", "event_index": "int", "price": "double", "time_spent_sec": "int",
                  "session_length": "int", "interaction_count": "int", "is_conversion": "boolean",
                  "drop_off_flag": "boolean"}
# Record-store metadata columns dropped by S04.
RECORD_META = ["id", "collectionId", "collectionName", "created", "updated", "expand"]
# Review columns required after normalisation.
REQUIRED_REVIEW_COLUMNS = ["country", "description", "designation", "points", "price", "province", "region_1",
                           "region_2", "taster_name", "taster_twitter_handle", "title", "variety", "winery"]
# Source registry domains.
SOURCE_TYPES = ("reseñas", "precios", "puntuaciones")
SOURCE_FORMATS = ("csv", "json", "parquet", "api")

SAMPLE_LIMIT = 5


class ContractError(ValueError):
    """A contract violation; the message names the column and bad values."""


# ---------------------------------------------------------------- S01
def read_contract_csv(spark: SparkSession, path: str) -> DataFrame:
    """Strict 18-column CSV.  All columns must exist, the file must not
    be empty, timestamps parse as UTC, flags are 0/1, price is numeric.
    The first violation raises ``ContractError`` naming bad values."""
    raw_schema = T.StructType([T.StructField(c, T.StringType()) for c in CONTRACT_COLUMNS])
    header = spark.read.option("header", True).csv(path).columns
    missing = [c for c in CONTRACT_COLUMNS if c not in header]
    if missing:
        raise ContractError(f"columnas_faltantes:{','.join(missing)}")
    raw = spark.read.option("header", True).schema(raw_schema).option("enforceSchema", False).csv(path)
    ts = F.try_to_timestamp(F.regexp_replace("timestamp_utc", "Z$", ""))
    bad = {
        "timestamp_utc": F.col("timestamp_utc").isNotNull() & ts.isNull(),
        "is_conversion": ~F.coalesce(F.trim("is_conversion").isin("0", "1"), F.lit(False)),
        "drop_off_flag": ~F.coalesce(F.trim("drop_off_flag").isin("0", "1"), F.lit(False)),
        "price": F.col("price").isNotNull() & F.col("price").try_cast("double").isNull(),
    }
    # one pass: the row count and a violation count per rule; a bounded
    # sample of bad values is fetched only for the first failing rule
    aggs = [F.count(F.lit(1)).alias("_n")] + [F.count_if(cond).alias(f"n_{c}") for c, cond in bad.items()]
    stats = raw.agg(*aggs).first()
    if stats["_n"] == 0:
        raise ContractError("archivo_vacio")
    for c, cond in bad.items():
        if stats[f"n_{c}"]:
            sample = [r[0] for r in raw.filter(cond).select(c).distinct().limit(SAMPLE_LIMIT).collect()]
            raise ContractError(f"valores_invalidos:{c}:{sample}")
    # validated: parse as UTC wall-clock (TIMESTAMP_NTZ), independent of the
    # session time zone
    ts_ntz = F.to_timestamp_ntz(F.regexp_replace(F.regexp_replace("timestamp_utc", "Z$", ""), "T", " "))
    return raw.select(
        *[(ts_ntz.alias(c) if c == "timestamp_utc" else
           (F.trim(F.col(c)) == "1").alias(c) if CONTRACT_TYPES.get(c) == "boolean" else
           F.col(c).try_cast(CONTRACT_TYPES[c]).alias(c) if c in CONTRACT_TYPES else F.col(c))
          for c in CONTRACT_COLUMNS])


def write_contract_csv(df: DataFrame, path: str) -> None:
    """Write typed clickstream rows in the contract layout (flags 0/1, UTC)."""
    out = df.select(*[
        F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias(c) if c == "timestamp_utc" else
        F.col(c).cast("int").cast("string").alias(c) if CONTRACT_TYPES.get(c) == "boolean" else
        F.col(c).cast("string").alias(c) for c in CONTRACT_COLUMNS])
    out.write.mode("overwrite").option("header", True).csv(path)


# ---------------------------------------------------------------- S02 / S07
def normalise_columns(df: DataFrame, required: list[str] = REQUIRED_REVIEW_COLUMNS) -> DataFrame:
    """lower/trim header names, drop ``unnamed*``, add missing required
    columns as NULL."""
    names = [c.strip().lower() for c in df.columns]
    df = df.toDF(*names)
    df = df.drop(*[c for c in names if c.startswith("unnamed")])
    return df.withColumns({c: F.lit(None).cast("string") for c in required if c not in df.columns})


def split_csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(_path, _n, record): the records of CSV files with line breaks inside quotes, read by many tasks per file.

    The text reader cuts files by bytes and lines.  A line begins inside a quoted field where an odd
    number of quotes lies before it in its file, so the quotes of each split, summed over the splits before,
    tell every split which of its lines begin a record; doubled quotes count as two.  Lines are then numbered
    by the records begun so far, in the same way, and joined per record.  ``_n`` counts a file's records from
    0, the header included; blank lines between records are none.  Quotes must follow RFC 4180 (a lone quote
    inside an unquoted field is taken for an opening one).
    """
    from terroir.operators.scans import stored
    split = ["_path", "_block"]
    lines = stored(spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at")))

    def before(totals: DataFrame, c: str) -> DataFrame:                # one row per split
        w = Window.partitionBy("_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
        return totals.select(*split, F.coalesce(F.sum(c).over(w), F.lit(0)).alias(f"_in{c}"))
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    counted = lines.withColumn("_q", quotes)
    earlier = Window.partitionBy(*split).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    parity = (F.col("_in_q") + F.coalesce(F.sum("_q").over(earlier), F.lit(0))) % 2
    opened = (counted.join(before(counted.groupBy(*split).agg(F.sum("_q").alias("_q")), "_q"), split)
              .withColumn("_outside", parity == 0).withColumn("_begins", (F.col("_outside") & (F.trim(F.translate("value", "\r", "")) != "")).cast("int")))
    opened = stored(opened.filter((F.col("_begins") == 1) | ~F.col("_outside")).drop("_in_q", "_q"))
    upto = Window.partitionBy(*split).orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = (opened.join(before(opened.groupBy(*split).agg(F.sum("_begins").alias("_b")), "_b"), split)
                .withColumn("_n", F.col("_in_b") + F.sum("_begins").over(upto) - 1))
    ordered = F.array_sort(F.collect_list(F.struct("_block", "_at", "value")))           # the lines of one record
    record = F.array_join(F.transform(ordered, lambda x: x["value"]), "\n")
    return numbered.groupBy("_path", "_n").agg(F.regexp_replace(record, "\r$", "").alias("record"))


def read_split_csv(spark: SparkSession, path: str, offset: int = 0) -> DataFrame:
    """All columns as strings, by the header of the first file; ``offset`` skips the first rows in the order of path and record."""
    from terroir.operators.scans import stored
    records = stored(split_csv_records(spark, path))
    first = records.filter("_n = 0").orderBy("_path").first()
    if first is None:
        return spark.createDataFrame([], T.StructType([]))
    names = next(csv.reader([first["record"]]))
    schema = ", ".join(f"c{i} string" for i in range(len(names)))
    rows = records.filter("_n > 0")
    if offset:
        counts = rows.groupBy("_path").agg(F.count(F.lit(1)).alias("_rows"))            # one row per file
        w = Window.orderBy("_path").rowsBetween(Window.unboundedPreceding, -1)
        starts = counts.select("_path", F.coalesce(F.sum("_rows").over(w), F.lit(0)).alias("_start"))
        rows = rows.join(starts, "_path").filter(F.col("_start") + F.col("_n") > offset)
    parsed = F.from_csv("record", schema, {"escape": '"', "multiLine": "true", "maxCharsPerColumn": "-1"})
    return rows.select(parsed.alias("r")).select("r.*").toDF(*[n if n else f"_c{i}" for i, n in enumerate(names)])


def read_reviews_csv(spark: SparkSession, path: str, offset: int = 0, max_description: int | None = None) -> DataFrame:
    """Lenient review CSV → record-normalised rows (strings '' for NULL,
    points int 0 default, price 0.0 default; the whole description unless
    ``max_description`` asks for a cut).  ``offset`` skips the first rows in
    the order of file path and row (resume).  A large file is read by many tasks."""
    df = normalise_columns(read_split_csv(spark, path, offset))
    text = [c for c in REQUIRED_REVIEW_COLUMNS if c not in ("points", "price")]
    return df.select(
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in text if c != "description"],
        (F.coalesce(F.col("description"), F.lit("")) if max_description is None
         else truncate(F.coalesce(F.col("description"), F.lit("")), max_description)).alias("description"),
        lenient_int("points").alias("points"), lenient_price("price").cast("double").alias("price"))


# ---------------------------------------------------------------- S03 / S05
def read_stage(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    r = spark.read
    return (r.schema(schema) if schema is not None else r).parquet(path)


def read_table(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Projected warehouse scan (column pruning reaches the reader)."""
    return spark.read.parquet(path).select(*columns)


# ---------------------------------------------------------------- S04
def read_records(spark: SparkSession, path: str, fmt: str = "json", schema: T.StructType | None = None) -> DataFrame:
    """A landing folder of records minus the record-store metadata."""
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    df = r.load(path)
    return df.drop(*[c for c in RECORD_META if c in df.columns])


# ---------------------------------------------------------------- S06
def read_serving(spark: SparkSession, path: str | None, fallback, name: str = "serving") -> DataFrame:
    """The serving aggregate when present and non-empty, else the
    warehouse plan ``fallback()``; the result says which source answered."""
    from terroir.plans.materialize import exists
    df = spark.read.parquet(path) if path and exists(spark, path) else None      # other read errors are raised
    if df is not None and not df.isEmpty():
        return df.withColumn("fuente", F.lit(name))
    return fallback().withColumn("fuente", F.lit("warehouse"))


# ---------------------------------------------------------------- S08 / S09
def validate_registry(df: DataFrame) -> DataFrame:
    """Per registry row an array of errors (empty when valid)."""
    def blank(c):
        return F.coalesce(F.trim(F.col(c)), F.lit("")) == ""
    cron_fields = F.size(F.split(F.trim(F.coalesce(F.col("frecuencia"), F.lit(""))), r"\s+"))
    errors = F.array_compact(F.array(
        F.when(blank("nombre"), F.lit("nombre_requerido")),
        F.when(~F.coalesce(F.lower(F.col("tipo")).isin(*SOURCE_TYPES), F.lit(False)), F.lit("tipo_invalido")),
        F.when(~F.coalesce(F.lower(F.col("formato")).isin(*SOURCE_FORMATS), F.lit(False)), F.lit("formato_invalido")),
        F.when(blank("endpoint"), F.lit("endpoint_requerido")),
        F.when(blank("frecuencia") | (cron_fields < 5), F.lit("frecuencia_cron_invalida"))))
    return df.withColumn("errores", errors)


def register_sources(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Incoming sources; duplicates on (tipo, endpoint, formato) carry
    the existing id and are rejected, the others get state REGISTRADA."""
    keys = ["tipo", "endpoint", "formato"]
    ex = existing.groupBy(*keys).agg(F.min("id").alias("id_existente"))   # one row per key: no fan-out
    j = incoming.join(ex, keys, "left")
    return j.withColumn("estado", F.when(F.col("id_existente").isNotNull(), F.lit("DUPLICADA"))
                        .otherwise(F.lit("REGISTRADA")))


def enabled(df: DataFrame) -> DataFrame:
    """Only enabled sources are ingested."""
    return df.filter(F.col("estado") == "HABILITADA")


__all__ = ["read_contract_csv", "write_contract_csv", "normalise_columns", "read_reviews_csv", "read_stage",
           "read_table", "read_records", "read_serving", "validate_registry", "register_sources", "enabled",
           "ContractError", "strip"]
