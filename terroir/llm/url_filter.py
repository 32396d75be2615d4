"""URL filters: policy rules first, then a logistic regression on hashed
character n-grams of host and path, trained from a small labelled URL table.

Method: host and path each become their character n-grams, hashed into
``DIM`` buckets; a URL's features are the bucket counts of its host and of its
path, each divided by the root of its number of n-grams.  ``pyspark.ml`` fits the logistic regression on the labelled table (its
size is checked against ``MAX_LABELLED``).  The fitted weights are one literal
array in the scoring expression, so every page is judged in a single
scan without any shuffle.

Rules are a short ordered policy: a rule fits its host and all subdomains if
the path starts with the rule's path.  The longest rule wins (then the longer
host, then block).

Defined results
* null url or no ``://``: empty host and path; judged by the model's bias.
* repeated rows and ties: one result row each, equal rows get equal verdicts.
* empty table: empty result.  Very long urls: all n-grams count.
* extra columns are not read; the result has the contract's columns and score.
"""

from __future__ import annotations

import json
from collections import Counter

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terroir.llm.text import LOWER, UPPER, let, text_or_empty

DIM = 1 << 14                     # buckets for each of host and path
SIZES = (3, 4, 5)
MAX_LABELLED = 100_000
MAX_RULES = 1_000
THRESHOLD = 0.5

# The contract's policy (host, path, verdict).
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block")]

# The labelled URL table: invented addresses, generic spam vocabulary against ordinary sites.
BLOCKED = """
https://royal-casino.test/play/win-cash https://casino-bonus.test/free-spins https://m.online-casino.test/slots
http://poker-king.test/bet-now https://best-bets.test/odds/today http://www.sports-bets.test/free-bet
https://betting-tips.test/win http://lucky-win.test/jackpot https://win-prizes.test/claim-prize
https://buy-pills.test/cheap http://cheap-meds.test/order-pills https://online-pills.test/no-prescription
https://www.cheap-pharmacy.test/buy/pills http://diet-pills.test/free-trial https://viagra-store.test/buy-now
https://free-money.test/claim http://fast-loans.test/apply-now https://payday-loans.test/cash-today
http://cheap-loans.test/bad-credit https://ads-server.test/click?id=1 http://ad-track.test/pixel.gif
https://track-clicks.test/redirect http://www.banner-ads.test/popup https://ads-network.test/track/imp
http://click-track.test/go https://popup-ads.test/landing https://adult-cams.test/live-xxx
http://xxx-videos.test/free-porn https://hot-dating.test/sexy-singles http://porn-tube.test/watch
https://replica-watches.test/cheap-rolex http://cheap-handbags.test/outlet https://torrent-free.test/crack-keygen
http://warez-crack.test/serial https://crypto-double.test/get-rich http://free-gifts.test/winner
https://free-casino.test/bonus http://bets-online.test/casino https://cheap-followers.test/buy-likes
http://spam-links.test/seo-backlinks
""".split()
ALLOWED = """
https://www.library.test/catalogue/1204 https://news.daily.test/world/article-55.html http://blog.garden.test/en/2021/roses
https://university.test/research/papers/88 https://docs.software.test/guide/install http://www.museum.test/fr/visit
https://weather.test/forecast/north https://wiki.open.test/page/Mountain http://cooking.test/recipes/bread.html
https://www.school.test/courses/history https://m.transport.test/timetable https://forum.linux.test/thread/9912
http://travel.test/de/berlin https://city.test/services/water https://hospital.test/departments
https://www.orchestra.test/es/concerts http://science.test/journal/volume/12 https://books.test/authors/novels
https://football.test/results/2020 https://blog.teacher.test/lessons/3 http://government.test/law/act-17
https://www.farm.test/products/milk https://radio.test/programmes/morning http://theatre.test/tickets
https://astronomy.test/stars/catalog https://health.test/advice/sleep http://m.railway.test/stations
https://history.test/en/1848 https://www.language.test/grammar/verbs http://nature.test/birds/heron
https://archive.test/2003/index.html https://shop.furniture.test/chairs https://www.bank.test/branches
http://insurance.test/contact https://engineering.test/bridges https://math.test/theorem/proof
https://photo.test/gallery/7 http://music.test/albums/jazz https://painting.test/artists
https://geology.test/rocks?page=2 https://blog.other.test/the/then http://stationer.test/paper
https://www.institution.test/nation https://thinking.test/en/77 https://heritage.test/fr/4031.html
http://lesson.test/es/512/ https://www.thread.test/de/6003 https://orient.test/en/2410#top
https://editorial.test/en/190?ref=x http://ring.test/fr/8 https://www.hanging.test/en/31/
https://stable.test/es/900.html https://m.rest.test/de/45 https://blog.anchor.test/en/678?page=3
http://national.test/fr/5512 https://www.shore.test/en/82.html https://tiling.test/en/7001
https://eastern.test/de/1555/ http://www.region.test/en/94 https://position.test/es/4400
""".split()


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; empty without ``://``."""
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    u = text_or_empty(url)
    return F.translate(F.regexp_extract(u, parts, 1), UPPER, LOWER), F.regexp_extract(u, parts, 2)


def ngrams(c: Column, sizes: tuple[int, ...] = SIZES) -> Column:
    """Character n-grams of ``^text$``, hashed into ``DIM`` buckets."""
    marked = F.concat(F.lit("^"), c, F.lit("$"))

    def of(s):
        def of_size(n):
            at = F.when(F.char_length(s) >= n, F.sequence(F.lit(1), F.char_length(s) - n + 1)).otherwise(
                F.array().cast("array<int>"))
            return F.transform(at, lambda i: F.pmod(F.xxhash64(F.substring(s, i, F.lit(n))), F.lit(DIM)).cast("int"))
        return F.concat(*[of_size(n) for n in sizes])
    return let(marked, of)


def rule_matches(rules: list[tuple[str, str, str]], host: Column, path: Column) -> tuple[Column, Column]:
    """(rule string, verdict) of the longest fitting rule, else nulls."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; the policy is one expression of at most {MAX_RULES}")
    ordered = sorted(rules, key=lambda r: (-len(r[0] + r[1]), -len(r[0]), r[2] != "block"))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in reversed(ordered):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The built-in labelled table (url, label), label 1 = block."""
    rows = [(u, 1) for u in BLOCKED] + [(u, 0) for u in ALLOWED]
    return spark.createDataFrame(rows, "url string, label int")


def train(labelled: DataFrame, reg: float = 1e-3) -> tuple[list[float], list[float], float]:
    """(host weights, path weights, bias) of the logistic regression.

    ``labelled`` has url and label (0/1); rows with a null are left out.  Its
    size is checked: it is a seed list, not a corpus.
    """
    clean = labelled.where(F.col("url").isNotNull() & F.col("label").isNotNull())
    n = clean.count()
    if not 2 <= n <= MAX_LABELLED:
        raise ValueError(f"{n} labelled URLs; between 2 and {MAX_LABELLED} are needed")
    host, path = host_and_path(F.col("url"))
    rows = clean.select(F.col("label").cast("double"), ngrams(host), ngrams(path)).collect()   # <= MAX_LABELLED rows

    def features(h, p):
        out = Counter()
        for buckets, offset in ((h, 0), (p, DIM)):
            for b in buckets:
                out[offset + b] += len(buckets) ** -0.5
        return Vectors.sparse(2 * DIM, dict(out))
    x = labelled.sparkSession.createDataFrame([(y, features(h, p)) for y, h, p in rows], ["label", "features"])
    model = LogisticRegression(regParam=reg, standardization=False, maxIter=100).fit(x)
    w = [round(v, 5) for v in model.coefficients.toArray().tolist()]
    return w[:DIM], w[DIM:], float(model.intercept)


def score(host: Column, path: Column, model: tuple[list[float], list[float], float]) -> Column:
    """Probability of label 1."""
    def part(c, weights):
        table = F.from_json(F.lit(json.dumps(weights)), "array<double>")      # a folded literal
        total = lambda b: F.aggregate(b, F.lit(0.0), lambda a, k: a + F.get(table, k)) / F.sqrt(F.greatest(F.size(b), F.lit(1)))
        return let(ngrams(c), total)
    z = part(host, model[0]) + part(path, model[1]) + F.lit(model[2])
    return 1 / (1 + F.exp(-z))


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], model: tuple[list[float], list[float], float],
          threshold: float = THRESHOLD) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) per row."""
    h, p = host_and_path(F.col("url"))
    parts = pages.select("page_id", h.alias("host"), p.alias("path"))
    rule, verdict = rule_matches(rules, F.col("host"), F.col("path"))
    scored = parts.withColumns({"rule": rule, "__rule_says": verdict, "score": score(F.col("host"), F.col("path"), model)})
    by_model = F.when(F.col("score") >= threshold, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("__rule_says", by_model).alias("verdict"), "score")


def digest(pages: DataFrame) -> DataFrame:
    """The contract's columns, and the score."""
    return judge(pages, RULES, train(labelled_urls(pages.sparkSession)))
