"""Line dedup: range-partitioned line hashes with secondary sort.

Method: every long line becomes (128-bit hash, document, position).  The rows
are range-partitioned by (hash, document) and sorted by (hash, document
descending, position), so each partition is one ordered stream.  Streaming
over it finds the first occurrence per (hash, document); the first document
of a run is the keeper.  Each task reduces its runs to one row per hash
before the small final combine, and a run that many documents share spans
several partitions, so no hot line meets in one task.  The result is not
text but one compressed keep bitmap per document: the runs of dropped line
positions (a run-length container); a document without one keeps all lines.

Defined results
* null or empty text: one empty line, kept.
* repeated rows / ties: rows of one ``doc_id`` count as one document; each
  row's lines are judged by key, so equal rows get equal results.
* null ``doc_id``: all such rows are one document, ordered below every other.
* very long texts are split whole; from then on each long line is a row of its own,
  and only its hash and position travel.
* empty table: empty result with the same columns.
* extra columns pass through ``apply``; internal columns start with ``__``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terroir.llm.storage import shuffle_partitions, written
from terroir.llm.text import WHITE, ascii_lower, let, lines, text_or_empty

MIN_CHARS = 40
MIN_DOCS = 5
MAX_HOT = 100_000                 # hot lines that may be broadcast (about 10 MB)
MIN_HOT_DOCS = 1_000
BITMAP = "array<struct<start:int,len:int>>"


def line_key(line: Column) -> Column:
    """White space stripped at both ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(WHITE)))


def line_hashes(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per line with a long key: (__h1, __h2, __nd, __th, __pos).

    ``__nd`` is the negated doc_id, so ascending order is document
    descending; ``__th`` tells rows of one doc_id with different texts apart.
    """
    rows = (docs.select((-F.col("doc_id")).alias("__nd"), F.xxhash64("text").alias("__th"),
                        F.posexplode(lines(F.col("text"))).alias("__pos", "__line"))
            .withColumn("__key", line_key(F.col("__line")))
            .where(F.char_length("__key") >= min_chars))
    return rows.select(F.xxhash64("__key").alias("__h1"), F.xxhash64(F.lit(1), "__key").alias("__h2"),
                       "__nd", "__th", "__pos")


def drop_runs(positions: Column) -> Column:
    """Sorted distinct positions as runs (start, length)."""
    def runs(p):
        starts = F.filter(p, lambda x, i: (i == 0) | (x - F.get(p, i - 1) != 1))
        ends = F.filter(p, lambda x, i: (i == F.size(p) - 1) | (F.get(p, i + 1) - x != 1))
        return F.zip_with(starts, ends, lambda a, b: F.struct(
            a.cast("int").alias("start"), (b - a + 1).cast("int").alias("len")))
    return let(positions, runs)


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(__nd, __th, drop_runs) for the documents that lose lines."""
    n = shuffle_partitions(docs.sparkSession)
    hashed = line_hashes(docs, min_chars)
    stream = hashed.repartitionByRange(n, "__h1", "__h2", "__nd").sortWithinPartitions(
        "__h1", "__h2", "__nd", "__th", "__pos")
    # The range partitioning already clusters (hash, document): no new exchange here.
    in_doc = Window.partitionBy("__h1", "__h2", "__nd").orderBy("__th", "__pos")
    stream = written(stream.withColumn("__first", F.row_number().over(in_doc) == 1), "lines")
    shared = (stream.where("__first").groupBy("__h1", "__h2")
              .agg(F.count(F.lit(1)).alias("__docs"), F.min("__nd").alias("__keeper"))
              .where(F.col("__docs") >= min_docs))
    shared = written(shared, "shared-lines")
    # A line in more than 1 / MAX_HOT of all rows is hot: there are fewer than MAX_HOT of
    # these, so they are broadcast and their rows never meet in a shuffle.
    hot_docs = max(MIN_HOT_DOCS, stream.count() // MAX_HOT)
    hot = shared.where(F.col("__docs") > hot_docs).select("__h1", "__h2", F.col("__keeper").alias("__hot_keeper"), F.lit(True).alias("__hot"))
    tagged = stream.join(F.broadcast(hot), ["__h1", "__h2"], "left")
    spread = tagged.where(F.col("__hot")).withColumnRenamed("__hot_keeper", "__keeper").drop("__hot")
    rest = (tagged.where(F.col("__hot").isNull()).drop("__hot", "__hot_keeper")
            .join(shared.where(F.col("__docs") <= hot_docs).drop("__docs"), ["__h1", "__h2"]))
    dropped = spread.unionByName(rest).where(~F.col("__nd").eqNullSafe(F.col("__keeper")))
    return (dropped.groupBy("__nd", "__th")
            .agg(drop_runs(F.sort_array(F.collect_set("__pos"))).alias("drop_runs")))


def with_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, name: str = "drop_runs") -> DataFrame:
    """``docs`` plus the bitmap ``name`` (an empty array where nothing is dropped)."""
    bitmaps = keep_bitmaps(docs, min_chars, min_docs).select(
        F.col("__nd").alias("__bnd"), F.col("__th").alias("__bth"), F.col("drop_runs").alias("__runs"))
    left = docs.withColumns({"__nd": -F.col("doc_id"), "__th": F.xxhash64("text")})
    joined = left.join(bitmaps, F.col("__nd").eqNullSafe(F.col("__bnd")) & (F.col("__th") == F.col("__bth")), "left")
    return (joined.withColumn(name, F.coalesce("__runs", F.array().cast(BITMAP)))
            .drop("__nd", "__th", "__bnd", "__bth", "__runs"))


def kept_lines(all_lines: Column, runs: Column) -> Column:
    """Lines outside the dropped runs, in order."""
    def segments(ls):
        def one(i):
            before = F.get(runs, i - 1)
            start = F.when(i == 0, F.lit(0)).otherwise(before["start"] + before["len"])
            end = F.coalesce(F.get(runs, i)["start"], F.size(ls))
            return F.slice(ls, start + 1, end - start)
        return F.flatten(F.transform(F.sequence(F.lit(0), F.size(runs)), one))
    return let(all_lines, segments)


def kept_text(text: Column, runs: Column) -> Column:
    return F.when(F.size(runs) == 0, text_or_empty(text)).otherwise(
        F.array_join(kept_lines(lines(text), runs), "\n"))


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with the repeated lines removed from ``text`` (columns unchanged).

    ``n_chars``, where present, follows a changed text.
    """
    out = with_bitmaps(docs, min_chars, min_docs, "__drop_runs")
    runs = F.col("__drop_runs")
    changed = F.size(runs) > 0
    out = out.withColumn("text", F.when(changed, kept_text(F.col("text"), runs)).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(changed, F.char_length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns per document, from the keep bitmaps."""
    out = with_bitmaps(docs.select("doc_id", "text"))
    n_dropped = F.aggregate("drop_runs", F.lit(0).cast("long"), lambda a, r: a + r["len"])
    return out.select(
        "doc_id", F.size(lines(F.col("text"))).cast("long").alias("n_lines"), n_dropped.alias("n_dropped"),
        F.sha2(kept_text(F.col("text"), F.col("drop_runs")), 256).alias("kept_sha256"))


ORACLE_SQL = r"""
WITH ls AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM ls),
shared AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 40
  GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT m.doc_id, m.pos, m.line, s.k IS NOT NULL AND m.doc_id <> s.keeper AS gone
  FROM keyed m LEFT JOIN shared s ON m.k = s.k)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
