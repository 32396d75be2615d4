"""terroir — a Spark-native analytics engine for a reviews market and the
subscription business around it.

Sub-packages:
  sources/    readers (contract CSV, lenient CSV, Parquet stages, record dirs)
  sinks/      writers (partitioned landing, rejects, keyed upsert, exports)
  functions/  scalar column expressions (rounding, parsing, keys, classes)
  operators/  DataFrame operators (star builders, aggregates, windows,
              search, quality, scoring, signals/alerts, lifecycle replay)
  plans/      composed query plans over the test tables + oracle SQL
  streaming/  Structured Streaming variants of ingest, alerts, rate limit
"""

__version__ = "0.1.0"
