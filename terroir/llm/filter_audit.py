"""Filter interaction audit: five filters under all 120 orders of applying them.

Method: what happens to a document depends only on the set (mask) of filters
that it fails.  In lexicographic order of the permutations, all orders with a
common prefix are neighbours (Lehmer ranks ``start`` to ``start + (5 - step)!``).
A mask leaves at the first filter of an order that it fails, so for each step
the orders under which it leaves there are such intervals: a prefix of filters
that it passes, then one that it fails.  Every mask's count is added at each
interval's start and taken off at its end; a running sum over the 120 ranks
then gives the documents removed at each step of every order.

Scale: the texts are read once and become narrow rows (doc_id, part, text
hash, four flags), written once.  Copies are found by aggregates with a
map-side combine: a group of equal texts is reduced to a row per part and
labels before its rows meet, so a text that a third of all rows share is
a few rows per task.  All later tables hold at most 32 masks or 600 cells a
part, and the 325 prefixes per mask follow from a rule.

Defined results
* null text: empty; null lang: the part ''.  Empty texts have no words, hence
  fail A and pass B, C and D; of several, all but the smallest doc_id fail E.
* repeated rows (one doc_id) count as often as they occur, and none of them is
  a smaller document than the others.
* null doc_id: compared with nothing (passes E) and without labels.
* several label rows of a doc_id: good (toxic) if any says so; null labels
  say nothing.
* very long texts are read whole; only their counts and hashes go on.
* empty table: empty result; columns beyond doc_id, text and lang are not read.
"""

from __future__ import annotations

from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terroir.llm.storage import written
from terroir.llm.text import SPACED_WORD, let, text_or_empty, words

FILTERS = "ABCDE"
N = len(FILTERS)
ORDERS = factorial(N)
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_CAPITAL_PERCENT = 3
COPY = 1 << FILTERS.index("E")
COUNTS = ("n", "good", "toxic")


def text_flags(t: Column) -> Column:
    """Bits A to D of the filters that a text fails."""
    def of_words(w):
        few = F.size(w) < MIN_WORDS
        repetitive = 100 * F.size(F.array_distinct(w)) < MIN_DISTINCT_PERCENT * F.size(w)
        return few.cast("int") + 2 * repetitive.cast("int")
    chars = F.char_length(t).cast("long")
    capitals = chars - F.char_length(F.regexp_replace(t, "[A-Z]+", ""))
    return (let(words(t, SPACED_WORD), of_words) + 4 * (100 * capitals > MAX_CAPITAL_PERCENT * chars).cast("int")
            + 8 * t.rlike("[#$%&*|]").cast("int"))


def masked(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents per part and set of failed filters."""
    t = text_or_empty("text")
    rows = written(docs.select(
        F.col("doc_id").alias("__id"), text_or_empty("lang").alias("part"), text_flags(t).alias("__flags"),
        F.xxhash64(t).alias("__h1"), F.xxhash64(F.lit(1), t).alias("__h2")), "audit-rows")
    once = (rows.where(F.col("__id").isNotNull()).groupBy("__id", "__h1", "__h2", "part", "__flags")
            .agg(F.count(F.lit(1)).alias("__n")))
    marks = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("__id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("__good"), F.max((F.col("toxic") == 1).cast("int")).alias("__toxic"))
    marked = once.join(marks, "__id", "left").fillna(0, ["__good", "__toxic"])
    # one row per text, part and labels: how many rows, and how many of them have the smallest doc_id
    copies = (marked.groupBy("__h1", "__h2", "part", "__flags", "__good", "__toxic")
              .agg(F.sum("__n").alias("__n"), F.min("__id").alias("__id"), F.min_by("__n", "__id").alias("__n_first")))
    same_text = Window.partitionBy("__h1", "__h2")             # rows of one text: its parts times four
    first = F.when(F.col("__id") == F.min("__id").over(same_text), F.col("__n_first")).otherwise(F.lit(0))
    split = copies.withColumn("__n_first", first).select("part", "__good", "__toxic", F.inline(F.array(
        F.struct(F.col("__flags").alias("mask"), F.col("__n_first").alias("n")),
        F.struct((F.col("__flags") + COPY).alias("mask"), (F.col("__n") - F.col("__n_first")).alias("n")))))
    nameless = rows.where(F.col("__id").isNull()).select(
        "part", F.lit(0).alias("__good"), F.lit(0).alias("__toxic"), F.col("__flags").alias("mask"), F.lit(1).cast("long").alias("n"))
    return split.unionByName(nameless).where("n > 0").groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("__good")).alias("good"),
        F.sum(F.col("n") * F.col("__toxic")).alias("toxic"))


def orders(spark: SparkSession) -> DataFrame:
    """(rank, filter_order, step, letter, bit, before): the 120 permutations by
    their Lehmer rank, a row per step; ``before`` has the bits of earlier steps."""
    rest, order = F.lit(FILTERS), F.lit("")
    for i in range(N):
        digit = F.floor(F.col("rank") / factorial(N - 1 - i)).cast("int") % (N - i)
        order = F.concat(order, F.substring(rest, digit + 1, F.lit(1)))
        rest = F.concat(F.substring(rest, F.lit(1), digit), F.substring(rest, digit + 2, F.lit(N)))
    listed = spark.range(ORDERS).select(F.col("id").cast("int").alias("rank"))
    steps = listed.withColumn("filter_order", order).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(N))))

    def bit(position: Column) -> Column:
        number = F.instr(F.lit(FILTERS), F.substring("filter_order", position, F.lit(1)))
        return F.element_at(F.array(*[F.lit(1 << i) for i in range(N)]), number)
    before = F.aggregate(F.filter(F.sequence(F.lit(1), F.lit(N)), lambda s: s < F.col("step")), F.lit(0), lambda a, s: a + bit(s))
    return steps.select("rank", "filter_order", "step", F.substring("filter_order", F.col("step"), F.lit(1)).alias("letter"),
                        bit(F.col("step")).alias("bit"), before.alias("before"))


def intervals(spark: SparkSession) -> DataFrame:
    """(mask, step, start, end): the ranks under which a mask leaves at a step."""
    length = F.element_at(F.array(*[F.lit(factorial(N - s)) for s in range(1, N + 1)]), F.col("step"))
    prefixes = orders(spark).withColumn("__length", length).where(F.col("rank") % F.col("__length") == 0)
    return (prefixes.withColumn("mask", F.explode(F.sequence(F.lit(1), F.lit(2 ** N - 1))))
            .where((F.col("mask").bitwiseAND(F.col("bit")) != 0) & (F.col("mask").bitwiseAND(F.col("before")) == 0))
            .select("mask", "step", F.col("rank").alias("start"), (F.col("rank") + F.col("__length")).alias("end")))


def audit(counts: DataFrame) -> DataFrame:
    """The report of ``counts`` (part, mask, n, good, toxic), 600 rows a part."""
    spark = counts.sparkSession
    ends = (counts.join(F.broadcast(intervals(spark)), "mask")                # fewer than 31 * 325 intervals
            .select("part", "step", F.inline(F.array(
                F.struct(F.col("start").alias("rank"), *[F.col(c).alias(f"__{c}") for c in COUNTS]),
                F.struct(F.col("end").alias("rank"), *[(-F.col(c)).alias(f"__{c}") for c in COUNTS])))))
    steps = ends.where(F.col("rank") < ORDERS).groupBy("part", "step", "rank").agg(*[F.sum(f"__{c}").alias(f"__{c}") for c in COUNTS])
    bits = F.array(*[F.struct(F.lit(f).alias("letter"), F.lit(1 << i).alias("__bit")) for i, f in enumerate(FILTERS)])
    fails = F.col("mask").bitwiseAND(F.col("__bit")) != 0
    parts = (counts.select("part", "mask", "n", F.inline(bits)).groupBy("part", "letter").agg(
        F.sum("n").alias("__total"), F.sum(F.when(fails, F.col("n")).otherwise(0)).alias("__fails"),
        F.sum(F.when(F.col("mask") == F.col("__bit"), F.col("n")).otherwise(0)).alias("unique_fails")))
    listed = F.broadcast(orders(spark).select("rank", "filter_order", "step", "letter"))      # 600 rows
    grid = parts.join(listed, "letter").join(steps, ["part", "step", "rank"], "left").fillna(0, [f"__{c}" for c in COUNTS])
    ranks = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = grid.select("part", "filter_order", "step", "letter", "__total", "__fails", "unique_fails",
                         F.sum("__n").over(ranks).alias("removed"), F.sum("__good").over(ranks).alias("good_lost"),
                         F.sum("__toxic").over(ranks).alias("toxic_lost"))
    applied = Window.partitionBy("part", "filter_order").orderBy("step").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return summed.select(
        "part", "filter_order", "step", (F.col("__total") - F.sum("removed").over(applied)).alias("kept"), "removed",
        (F.col("__fails") - F.col("removed")).alias("redundant"), "unique_fails", "good_lost", "toxic_lost",
        F.sum("removed").over(Window.partitionBy("part", "letter")).alias("shapley"))


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's columns."""
    return audit(written(masked(docs, labels), "audit-masks"))


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
firsts AS (SELECT t, min(doc_id) AS first_id FROM d GROUP BY t),
marks AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY doc_id),
docs AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         CASE WHEN len(w) < 200 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
         || CASE WHEN 100 * len(regexp_extract_all(d.t, '[A-Z]')) > 3 * length(d.t) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(d.t, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN d.doc_id > first_id THEN 'E' ELSE '' END AS failed
  FROM d JOIN firsts f ON d.t = f.t LEFT JOIN marks m ON d.doc_id = m.doc_id),
kinds AS (SELECT part, failed, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM docs GROUP BY part, failed),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
perms AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letters a JOIN letters b ON b.x <> a.x JOIN letters c ON c.x NOT IN (a.x, b.x)
  JOIN letters d ON d.x NOT IN (a.x, b.x, c.x) JOIN letters e ON e.x NOT IN (a.x, b.x, c.x, d.x)),
steps AS (SELECT filter_order, s AS step, substr(filter_order, s, 1) AS f FROM perms, (SELECT unnest([1, 2, 3, 4, 5]) AS s)),
fate AS (
  SELECT k.*, s.filter_order, s.step, s.f, contains(k.failed, s.f) AS fails,
         len(regexp_extract_all(left(s.filter_order, s.step - 1), '[' || k.failed || 'x]')) > 0 AS gone
  FROM kinds k, steps s),
cells AS (
  SELECT part, filter_order, step, f,
         sum(CASE WHEN NOT gone AND NOT fails THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN fails AND NOT gone THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN fails AND gone THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN failed = f THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN fails AND NOT gone THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN fails AND NOT gone THEN toxic ELSE 0 END) AS toxic_lost
  FROM fate GROUP BY part, filter_order, step, f)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM cells
"""
