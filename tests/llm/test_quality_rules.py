import random
import re

import numpy as np
from pyspark.sql import functions as F

from terroir.llm import quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    t = text or ""
    w = WORD.findall(t)
    seen = {}
    for i in range(len(w) - 2):
        seen.setdefault(tuple(w[i:i + 3]), []).append(i)
    hit = {p for at in seen.values() if len(at) > 1 for i in at for p in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(hit),
            len(w) < 50 or 100 * len(hit) > 50 * len(w))


def test_base_equals_brute_force(spark, messy, messy_rows):
    rnd = random.Random(1)
    more = [(1000 + i, " ".join(rnd.choices(["a", "b", "cc", "é|", "x\n", "#"], k=rnd.randint(0, 90))), "en", "s0", 0, 0, "", "")
            for i in range(60)]
    docs = messy.unionAll(spark.createDataFrame(more, messy.schema))
    got = quality_rules.digest(docs).collect()
    key = lambda r: (str(r[0]), r[1:])
    assert sorted(((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"],
                    r["base_failed"]) for r in got), key=key) == sorted(
        ((r[0], *brute(r[1])) for r in messy_rows + more), key=key)
    assert not any(r["kept"] and r["base_failed"] for r in got)


def corpus(n=700, junk=60):
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choices("abcdefghij", k=rnd.randint(2, 9)))
    rows = []
    for i in range(n):
        w = [word() for _ in range(int(rnd.lognormvariate(5.2, 0.5)) + 50)]
        if i < junk:
            w = [x + "|###" for x in w]
        rows.append((i, " ".join(w), "en" if i % 2 else None, "s1"))
    return rows


def test_outliers_per_group(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r["doc_id"]: r["kept"] for r in quality_rules.verdicts(docs, min_group=100).collect()}
    assert not any(kept[i] for i in range(60))
    assert sum(not kept[i] for i in range(60, 700)) <= 3
    out = quality_rules.reject(docs)
    assert out.columns == docs.columns


def test_small_groups_keep_the_base_verdict(spark):
    docs = spark.createDataFrame(corpus(40, 10), "doc_id long, text string, lang string, source string")
    got = quality_rules.verdicts(docs).collect()
    assert all(r["kept"] == (not r["base_failed"]) for r in got)


def test_cholesky_and_distance(spark):
    rng = np.random.default_rng(2)
    p = len(quality_rules.STATS)
    a = rng.normal(size=(p, p)) * 3000
    cov = a @ a.T + np.eye(p) * 5000 ** 2
    mean, x = rng.normal(size=p) * 100, rng.normal(size=p) * 9000
    row = {"__g": "g", **{f"__m_{i}": float(mean[i]) for i in range(p)},
           **{f"__c_{i}{j}": float(cov[i, j]) for i in range(p) for j in range(i + 1)}}
    df = quality_rules.cholesky(spark.createDataFrame([row]))
    df = df.withColumns({f"__x_{s}": F.lit(float(x[i])) for i, s in enumerate(quality_rules.STATS)})
    got = quality_rules.distance(df).first()["__d"]
    assert abs(got - (x - mean) @ np.linalg.solve(cov, x - mean)) < 1e-6 * got


def test_empty(empty):
    assert quality_rules.digest(empty).count() == 0 and quality_rules.reject(empty).columns == empty.columns
