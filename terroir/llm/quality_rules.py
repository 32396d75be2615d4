"""Quality rules: robust multivariate outliers per language and source.

Method: every document gets a vector of transformed statistics.  For each
(language, source) the minimum covariance determinant is approximated
by concentration steps: starting from the coordinate-wise median and
median absolute deviation, the h = 75 % of rows with the smallest Mahalanobis
distances give the next mean and covariance, until ``steps`` rounds are done.
The final distances are scaled down to the chi-square median and a row beyond the
cut-off quantile is rejected.

All of it is grouped aggregates: the vectors are fixed-point integers, so
sums are exact and independent of the order of rows, and quantiles come from
exact counts per integer value.  A group only ever becomes a few numbers in
a partial aggregate, so a source with a third of all rows needs no salting.
The triangular (Cholesky) factor of each covariance is unrolled into column
expressions.

Defined results
* null or empty text: no words, hence ``base_failed``.
* null language or source: a group of its own value (null joins null).
* groups with fewer than ``MIN_GROUP`` rows that pass the base rules share one
  pooled estimate; if the pool itself is smaller, its rows keep the base verdict.
* very long texts: all words of a row are held at once; only its counts go on.
* constant statistics: a variance floor keeps every covariance regular.
* repeated rows count as often as they occur and get equal verdicts;
  empty table: empty result; extra columns are not read by ``verdicts``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terroir.llm.storage import written
from terroir.llm.text import SPACED_WORD, WHITE, let, text_or_empty, words

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_GROUP = 200
SUBSET = 0.75
STEPS = 4
SCALE = 1000                      # fixed point of the vectors
# Chi-square quantiles for 4 degrees of freedom (median, and the cut-off at 1 - 1e-6).
CHI2_MEDIAN = 3.3567
CHI2_CUTOFF = 33.377
IDX_BITS = 30                     # a text has fewer than 2^30 words (Java strings)
# Statistics and the least standard deviation of each, in its transformed unit: differences
# below it (a symbol or a repeated line more) are no evidence even where most rows are equal.
FLOORS = {"length": 0.5, "word": 0.05, "symbol": 0.5, "line": 0.5}
STATS = tuple(FLOORS)
FLOOR = [v * SCALE for v in FLOORS.values()]


def n_repeat_words(w: Column) -> Column:
    """Words inside 3-word windows that occur at least twice.

    Window hashes are sorted as plain longs whose low bits hold the position:
    neighbours with equal high bits are candidates.  Only these are compared
    by the full hash.
    """
    mask = (1 << IDX_BITS) - 1

    def near(a, key):
        return F.filter(a, lambda x, i: F.coalesce(key(x) == key(F.get(a, i - 1)), F.lit(False))
                        | F.coalesce(key(x) == key(F.get(a, i + 1)), F.lit(False)))

    def from_hashes(h):
        packed = F.sort_array(F.transform(h, lambda x, i: x.bitwiseAND(F.lit(~mask)).bitwiseOR(i.cast("long"))))
        likely = let(packed, lambda p: near(p, lambda x: F.shiftright(x, IDX_BITS)))
        full = F.transform(likely, lambda x: F.struct(
            F.get(h, x.bitwiseAND(F.lit(mask)).cast("int")).alias("h"), x.bitwiseAND(F.lit(mask)).cast("int").alias("i")))
        twice = let(F.sort_array(full), lambda s: near(s, lambda x: x["h"]))
        at = F.sort_array(F.transform(twice, lambda s: s["i"]))
        start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
        return F.aggregate(at, start, lambda a, i: F.struct(
            (i + 3).alias("end"), (a["n"] + (i + 3 - F.greatest(a["end"], i)).cast("long")).alias("n")), lambda a: a["n"])
    hashes = F.transform(F.sequence(F.lit(0), F.size(w) - 3),
                         lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
    return F.when(F.size(w) >= 3, let(hashes, from_hashes)).otherwise(F.lit(0).cast("long"))


def statistics(docs: DataFrame) -> DataFrame:
    """The contract's base columns, with lang and source."""
    t = text_or_empty("text")

    def of_words(w):
        return F.struct(F.size(w).cast("long").alias("n_words"),
                        F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
                        n_repeat_words(w).alias("n_repeat_words"))
    with_word = F.filter(F.split(t, "\n", -1), lambda x: F.btrim(x, F.lit(WHITE)) != "")
    dup = let(with_word, lambda x: F.size(x) - F.size(F.array_distinct(x)))
    row = docs.select("doc_id", F.col("lang").alias("__lang"), F.col("source").alias("__source"),
                      let(words(t, SPACED_WORD), of_words).alias("__s"),
                      F.regexp_count(t, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
                      dup.cast("long").alias("n_dup_lines"), F.xxhash64("text").alias("__th"))
    row = row.select("doc_id", "__th", "__lang", "__source", "__s.n_words", "__s.word_chars", "n_symbols",
                     "n_dup_lines", "__s.n_repeat_words")
    return row.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def vectors(stats: DataFrame) -> DataFrame:
    """Fixed-point transformed statistics, one column per name of STATS.

    Logs for sizes and rates; all are monotone and even out long right tails.
    """
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    parts = {
        "length": F.log1p(n),
        "word": 2 * F.log1p(F.col("word_chars") / n),
        "symbol": F.log1p(100 * F.col("n_symbols") / n),
        "line": F.log1p(100 * F.col("n_dup_lines") / n),
    }
    return stats.withColumns({f"__x_{k}": F.round(v * SCALE).cast("long") for k, v in parts.items()})


def value_counts(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Rows per group and integer value (``__n``): a partial aggregate."""
    return df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"))


def group_quantile(counts: DataFrame, keys: list[str], value: str, q: float, name: str) -> DataFrame:
    """The smallest integer value that at least a share ``q`` of each group's
    rows do not exceed, from exact counts per value."""
    run = Window.partitionBy(*keys).orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = Window.partitionBy(*keys)
    return (counts.withColumns({"__run": F.sum("__n").over(run), "__all": F.sum("__n").over(total)})
            .where(F.col("__run") >= F.ceil(F.col("__all") * F.lit(q)))
            .groupBy(*keys).agg(F.min(value).alias(name)))


def cholesky(df: DataFrame) -> DataFrame:
    """(__g, __m_i, __l_ij) from means and covariances (__m_i, __c_ij)."""
    p = len(STATS)
    for j in range(p):
        rest = df
        for i in range(j, p):
            s = F.col(f"__c_{i}{j}")
            for k in range(j):
                s = s - F.col(f"__l_{i}{k}") * F.col(f"__l_{j}{k}")
            value = F.sqrt(F.greatest(s, F.lit(FLOOR[j] ** 2))) if i == j else s / F.col(f"__l_{j}{j}")
            rest = rest.withColumn(f"__l_{i}{j}", value)
        df = rest
    return df.select("__g", *[f"__m_{i}" for i in range(p)],
                     *[f"__l_{i}{j}" for i in range(p) for j in range(i + 1)])


def distance(df: DataFrame) -> DataFrame:
    """``df`` plus ``__d`` = squared Mahalanobis distance, by forward substitution."""
    for i, s in enumerate(STATS):
        z = F.col(f"__x_{s}") - F.col(f"__m_{i}")
        for k in range(i):
            z = z - F.col(f"__l_{i}{k}") * F.col(f"__z_{k}")
        df = df.withColumn(f"__z_{i}", z / F.col(f"__l_{i}{i}"))
    total = sum((F.col(f"__z_{i}") * F.col(f"__z_{i}") for i in range(1, len(STATS))), F.col("__z_0") * F.col("__z_0"))
    # the bin of the distance on a fine log scale: quantiles count whole bins
    return df.withColumn("__d", total).withColumn("__bin", F.round(F.log1p(total) * SCALE).cast("long")).drop(
        *[f"__z_{i}" for i in range(len(STATS))])


def moments(df: DataFrame) -> DataFrame:
    """Means and covariances per group from exact integer sums."""
    p = len(STATS)
    x = [F.col(f"__x_{s}") for s in STATS]
    wide = "decimal(38,0)"
    sums = df.groupBy("__g").agg(
        F.count(F.lit(1)).alias("__n"), *[F.sum(x[i]).alias(f"__s_{i}") for i in range(p)],
        *[F.sum((x[i] * x[j]).cast("decimal(20,0)")).cast(wide).alias(f"__q_{i}{j}") for i in range(p) for j in range(i + 1)])
    n = F.col("__n").cast("double")
    mean = {f"__m_{i}": F.col(f"__s_{i}") / n for i in range(p)}
    cov = {f"__c_{i}{j}": F.col(f"__q_{i}{j}").cast("double") / n - (F.col(f"__s_{i}") / n) * (F.col(f"__s_{j}") / n)
           + F.lit(FLOOR[i] ** 2 if i == j else 0.0) for i in range(p) for j in range(i + 1)}
    return sums.withColumns({**mean, **cov})


def start_estimate(df: DataFrame) -> DataFrame:
    """Coordinate-wise median and median absolute deviation as a diagonal covariance."""
    keys = ["__g", "__k"]
    long = df.select("__g", F.posexplode(F.array(*[f"__x_{s}" for s in STATS])).alias("__k", "__v"))
    counts = written(value_counts(long, keys, "__v"), "mcd-values")
    med = group_quantile(counts, keys, "__v", 0.5, "__med")
    dev = (counts.join(med, keys).groupBy(*keys, "__med", F.abs(F.col("__v") - F.col("__med")).alias("__dev"))
           .agg(F.sum("__n").alias("__n")))
    mad = group_quantile(dev, [*keys, "__med"], "__dev", 0.5, "__mad")
    sd = F.col("__mad") * 1.4826 + F.element_at(F.array(*[F.lit(v) for v in FLOOR]), F.col("__k") + 1)
    p = len(STATS)
    at = lambda i, c: F.max(F.when(F.col("__k") == i, c))
    return mad.groupBy("__g").agg(
        *[at(i, F.col("__med")).cast("double").alias(f"__m_{i}") for i in range(p)],
        *[(at(i, sd * sd) if i == j else F.max(F.lit(0.0))).alias(f"__c_{i}{j}") for i in range(p) for j in range(i + 1)])


def estimates(x: DataFrame, steps: int = STEPS) -> DataFrame:
    """Per group: rows, mean, Cholesky factor and the median distance bin."""
    x = x.select("__g", *[f"__x_{s}" for s in STATS])
    current = written(cholesky(start_estimate(x)), "mcd")
    for _ in range(steps):
        d = distance(x.join(current, "__g"))
        # one row per group, written: the join knows its size and never deals the rows by group
        limit = written(group_quantile(value_counts(d, ["__g"], "__bin"), ["__g"], "__bin", SUBSET, "__limit"), "mcd-limit")
        subset = d.join(limit, "__g").where("__bin <= __limit")
        current = written(cholesky(moments(subset)), "mcd")
    d = distance(x.join(current, "__g"))
    size = x.groupBy("__g").agg(F.count(F.lit(1)).alias("__n"))
    return written(current.join(group_quantile(value_counts(d, ["__g"], "__bin"), ["__g"], "__bin", 0.5, "__mid"), "__g").join(size, "__g"), "mcd")


def with_group(x: DataFrame, min_group: int) -> DataFrame:
    """``x`` plus its group ``__g``: its language and source, or the pool of the small ones."""
    named = x.withColumn("__g", F.to_json(F.struct("__lang", "__source")))
    sizes = (named.where(~F.col("base_failed")).groupBy("__g").agg(F.count(F.lit(1)).alias("__n"))
             .where(F.col("__n") >= min_group).select(F.col("__g").alias("__own")))
    sizes = written(sizes, "mcd-groups")
    return (named.join(sizes, F.col("__g") == F.col("__own"), "left")
            .withColumn("__g", F.coalesce("__own", F.lit("pool"))).drop("__own"))


def verdicts(docs: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    """Base columns, ``base_failed``, ``kept`` and the scaled ``distance`` per row, with doc_id and __th."""
    stats = written(statistics(docs), "stats")
    x = written(with_group(vectors(stats), min_group), "vectors")
    d = distance(x.join(estimates(x.where(~F.col("base_failed"))), "__g", "left"))
    # the subset's covariance is too small: distances are scaled down to the chi-square median
    scaled = F.col("__d") * CHI2_MEDIAN / F.greatest(F.expm1(F.col("__mid") / SCALE), F.lit(CHI2_MEDIAN))
    outlier = F.coalesce((F.col("__n") >= min_group) & (scaled > CHI2_CUTOFF), F.lit(False))
    return d.select("doc_id", "__th", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "base_failed", (~F.col("base_failed") & ~outlier).alias("kept"), scaled.alias("distance"))


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns, and the scaled distance."""
    return verdicts(docs.select("doc_id", "text", "lang", "source")).drop("__th")


def reject(docs: DataFrame) -> DataFrame:
    """The documents that the rules keep (columns unchanged)."""
    bad = verdicts(docs.select("doc_id", "text", "lang", "source")).where(~F.col("kept")).select(
        F.col("doc_id").alias("__bid"), F.col("__th").alias("__bth"))
    return (docs.withColumn("__th", F.xxhash64("text"))
            .join(bad, F.col("doc_id").eqNullSafe(F.col("__bid")) & (F.col("__th") == F.col("__bth")), "left_anti")
            .select(*docs.columns))
