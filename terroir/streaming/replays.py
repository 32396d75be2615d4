"""Lifecycle replays as streams: T00 (and T10 on its result) with keyed state.

Requests may arrive out of order.  A request waits in its key's state until the
watermark has passed its time; a timer then applies all waiting requests up to
there in the order of (time, number), so the table that the stream writes is
the one that the batch replay gives.  A request that arrives twice while it waits
counts once; one that arrives behind the watermark cannot be put in order any more: it
goes to a dead-letter table, with the watermark that it missed.

A key's state is its machine's state, its step count and the requests that
wait, hence bounded by the watermark's delay.  With ``idle_days``, a key
without requests for that long is forgotten (a later request starts anew).

Each micro-batch replaces its own partition (``lote``) of both tables, so a batch that
is run again after a failure writes the same rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from terroir.operators.lifecycle import APPLIED, INVALID
from terroir.streaming import checkpoint_location

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
LATE = "tardia"
DAY_MS = 86_400_000
OUTPUT = ("clave string, fecha timestamp, seq long, estado_solicitado string, estado_anterior string, estado string, "
          "veredicto string, paso long, marca timestamp")


class Replay(StatefulProcessor):
    """One key's machine; see the module's description."""

    def __init__(self, transitions: dict[str, list[str]], init: str, idle_days: int | None):
        self.transitions, self.start, self.idle_days = transitions, init, idle_days

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.machine = handle.getValueState("machine", "estado string, paso long, ultima long")
        self.waiting = handle.getMapState("waiting", "us long, seq long", "quiere string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        late, timers = [], set()
        for pdf in rows:
            for us, seq, wanted in zip(pdf["us"].tolist(), pdf["seq"].tolist(), pdf["quiere"].tolist(), strict=True):
                if watermark > 0 and us <= watermark * 1000:
                    late.append((key[0], us, seq, wanted, None, None, LATE, None, watermark * 1000))
                else:
                    self.waiting.updateValue((us, seq), (wanted,))
                    timers.add(-(-us // 1000))
        for t in timers:
            self.handle.registerTimer(t)
        yield frame(late)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        until = expiredTimerInfo.getExpiryTimeInMs() * 1000
        state, step, last = self.machine.get() if self.machine.exists() else (self.start, 0, 0)
        out = []
        for (us, seq), (wanted,) in sorted((tuple(k), tuple(v)) for k, v in self.waiting.iterator() if k[0] <= until):
            before, step, last = state, step + 1, us
            done = wanted in self.transitions.get(before, ())
            state = wanted if done else before
            out.append((key[0], us, seq, wanted, before, state, APPLIED if done else INVALID, step, None))
            self.waiting.removeKey((us, seq))
        idle = None if self.idle_days is None else self.idle_days * DAY_MS
        if out:
            self.machine.update((state, step, last))
            if idle is not None:
                self.handle.registerTimer(last // 1000 + idle)
        elif idle is not None and self.machine.exists() and until >= last + idle * 1000 and not list(self.waiting.keys()):
            self.machine.clear()
        yield frame(out)

    def close(self) -> None:
        pass


def frame(rows: list) -> pd.DataFrame:
    names = [c.split()[0] for c in OUTPUT.split(", ")]
    out = pd.DataFrame(rows, columns=names)
    for c in ("fecha", "marca"):
        out[c] = pd.to_datetime(out[c], unit="us")
    return out.astype({"seq": "int64", "paso": "Int64", "clave": object})


def replayed(stream: DataFrame, key: str, transitions: dict[str, list[str]], init: str, delay: str = "1 day",
             idle_days: int | None = None) -> DataFrame:
    """The stream (key, fecha, seq, estado_solicitado) with previous state, state, verdict and step
    per request, emitted when the watermark has passed it; late requests with the verdict 'tardia' and ``marca``.

    The watermark is declared on a copy of the time that goes no further: Spark then keeps
    the late rows, which the processor returns instead of dropping them.
    """
    us = F.unix_micros(F.col("fecha").cast("timestamp"))
    rows = (stream.withColumn("_mark", F.col("fecha").cast("timestamp")).withWatermark("_mark", delay)
            .select(F.col(key).cast("string").alias("clave"), us.alias("us"), F.col("seq").cast("long").alias("seq"),
                    F.col("estado_solicitado").alias("quiere")))
    return rows.groupBy("clave").transformWithStateInPandas(Replay(transitions, init, idle_days), OUTPUT, "Append", "EventTime")


def replay_stream(spark: SparkSession, stream: DataFrame, key: str, transitions: dict[str, list[str]], init: str, table: str,
                  dead_letters: str, name: str, delay: str = "1 day", idle_days: int | None = None) -> StreamingQuery:
    """T00 as a stream into ``table``, late requests into ``dead_letters`` (Parquet, by ``lote``)."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)

    def per_batch(df: DataFrame, batch_id: int) -> None:
        rows = df.withColumn("lote", F.lit(batch_id).cast("long")).persist()
        for path, part in ((table, rows.where(F.col("veredicto") != LATE).drop("marca")), (dead_letters, rows.where(F.col("veredicto") == LATE))):
            part.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("lote").parquet(path)
        rows.unpersist()
    return (replayed(stream, key, transitions, init, delay, idle_days).writeStream.foreachBatch(per_batch)
            .option("checkpointLocation", checkpoint_location(spark, name)).trigger(availableNow=True).start())
