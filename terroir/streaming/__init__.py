"""Structured Streaming variants.

* ``ingest_stream``: a landing folder read as a stream; each micro-batch is
  validated (Q06), landed per partition (K01, idempotent on replay), rejects
  written (K02) and the batch report appended (A20/K04).
* ``alert_stream``: the signal bus as a stream; each micro-batch is drained
  into the versioned alert table (T01-T03, K09), once per batch id and
  signal key, so a replayed batch or a re-emitted signal raises nothing twice;
  the keys seen are state that the watermark clears.
* ``replays``: lifecycle replays (T00, T10) with keyed state and event-time timers.
* ``event_facts_stream`` / ``write_daily_facts`` / ``month_facts``: event
  feeds projected into facts (D15): daily rows are final once the watermark
  passes (append mode), appended per micro-batch, and rolled up to the month
  grain by a batch aggregate.

Checkpoints live under ``spark.checkpoint.dir`` (shared storage on a
cluster), so a restarted query resumes exactly once per micro-batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from terroir.session import ensure_checkpoint_dir


def checkpoint_location(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/terroir/streams/{name}"


# ---------------------------------------------------------------- ingest
def ingest_stream(spark: SparkSession, landing: str, schema, kind: str, source: str, base: str,
                  name: str = "ingest", available_now: bool = True) -> StreamingQuery:
    from terroir.operators.ids import global_row_number
    from terroir.operators.ingest import ingest_batch
    from terroir.sinks import land, land_rejects

    def per_batch(df: DataFrame, batch_id: int) -> None:
        ingest_date = f"batch-{batch_id:06d}"
        # input order is file path, then row: a repeated batch numbers alike
        scanned = df.withColumn("_scan", F.monotonically_increasing_id())
        numbered = global_row_number(scanned, ["_path", "_scan"], "ordinal").drop("_path", "_scan")
        valid, rejects, report = ingest_batch(numbered, kind, source, ingest_date)
        state = report.select("estado").first()["estado"]
        if state != "FALLIDA":
            land(valid.drop("ordinal"), base, source, ingest_date, kind)
        land_rejects(rejects.drop("ordinal"), base, source, ingest_date)
        (report.withColumn("fecha", F.lit(ingest_date)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("fecha").json(f"{base.rstrip('/')}/_reportes"))

    stream = spark.readStream.schema(schema).format("json").load(landing).select("*", F.col("_metadata.file_path").alias("_path"))
    w = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint_location(spark, name))
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")).start()


# ---------------------------------------------------------------- signals → alerts
SIGNAL_KEY = ["origen", "clave", "id_tiempo"]


def alert_stream(spark: SparkSession, signals_dir: str, schema, alerts_path: str, drained_at: str,
                 name: str = "alerts", repeats_within: str = "40 days") -> StreamingQuery:
    """Signals into the versioned alert table.  A signal key emitted again within ``repeats_within`` of its
    first ``fecha`` raises nothing: the keys are stream state that the watermark clears, so
    it holds that span's keys and no more.  Signals behind the watermark are dropped
    and counted (``late_rows``)."""
    from terroir.operators.alerts import group_alerts
    from terroir.sinks import read_versioned, write_version

    def per_batch(df: DataFrame, batch_id: int) -> None:
        """The alert table carries the last batch in it (``lote``), written in the same version."""
        current = read_versioned(spark, alerts_path)
        if current is not None and (current.agg(F.max("lote")).first()[0] or -1) >= batch_id:
            return                                            # this batch is already in the table
        merged, _ = group_alerts(df.withColumn("procesada", F.lit(False)), None if current is None else current.drop("lote"), drained_at)
        write_version(spark, alerts_path, merged.withColumn("lote", F.lit(batch_id).cast("long")))

    stream = spark.readStream.schema(schema).format("parquet").load(signals_dir)
    once = stream.withWatermark("fecha", repeats_within).dropDuplicatesWithinWatermark(SIGNAL_KEY)
    return (once.writeStream.foreachBatch(per_batch)
            .option("checkpointLocation", checkpoint_location(spark, name)).trigger(availableNow=True).start())


def late_rows(query: StreamingQuery) -> int:
    """Rows that the query's stateful operators dropped behind the watermark, over its reported batches."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])


def kept_keys(query: StreamingQuery) -> int:
    """Rows in the query's state after its last batch."""
    return sum(op["numRowsTotal"] for op in query.lastProgress["stateOperators"]) if query.lastProgress else 0


# ---------------------------------------------------------------- D15
def event_facts_stream(stream: DataFrame, ts: str = "fecha", group: list[str] | None = None,
                       value: str = "mrr_delta", watermark: str = "2 days") -> DataFrame:
    """Events → daily rows (count, Σ value) per group; a day is emitted
    once, when the watermark has passed it (append mode)."""
    group = group or ["plan"]
    return (stream.withWatermark(ts, watermark)
            .groupBy(F.window(ts, "1 day").alias("dia"), *group)
            .agg(F.count(F.lit(1)).alias("eventos"), F.sum(value).alias(value)))


def write_daily_facts(spark: SparkSession, daily: DataFrame, path: str, name: str) -> StreamingQuery:
    """Append the final daily rows, partitioned by period (replays of a
    batch rewrite the same files: the sink is the streaming file sink,
    exactly-once through its metadata log)."""
    rows = daily.select((F.year("dia.start") * 100 + F.month("dia.start")).cast("int").alias("id_tiempo"),
                        F.col("dia.start").cast("date").alias("dia"),
                        *[c for c in daily.columns if c != "dia"])
    return (rows.writeStream.outputMode("append").format("parquet").partitionBy("id_tiempo")
            .option("path", path).option("checkpointLocation", checkpoint_location(spark, name))
            .trigger(availableNow=True).start())


def month_facts(spark: SparkSession, path: str, group: list[str] | None = None,
                value: str = "mrr_delta") -> DataFrame:
    """The month-grain fact from the daily rows (batch aggregate)."""
    group = group or ["plan"]
    return (spark.read.parquet(path).groupBy("id_tiempo", *group)
            .agg(F.sum("eventos").alias("eventos"), F.sum(value).alias(value)))
