import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest

from terroir.llm import mixing

SCHEMA = "doc_id long, text string, source string, size string, number long, start int, block string"
COLUMNS = ["doc_id", "size", "source_size", "target", "taken"]


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def brute_targets(sizes):
    """Water filling by the definition, in fractions."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, held = Fraction(3, 2) * sum(sizes.values()), {}
    while len(held) < len(names):
        free = [s for s in names if s not in held]
        level = (total - sum(held.values())) / sum(weight[s] for s in free)
        above = [s for s in free if weight[s] * level > 2 * sizes[s]]
        if not above:
            return {s: float(held.get(s, weight[s] * level)) for s in names}
        held |= {s: Fraction(2 * sizes[s]) for s in above}
    return {s: float(held[s]) for s in names}


def checked(spark, rows, df=None):
    docs = df if df is not None else spark.createDataFrame([(*r, "x", 1, 2, "y") for r in rows], SCHEMA)
    got = mixing.digest(docs)
    assert got.columns == COLUMNS
    out = [tuple(r) for r in got.collect()]
    sizes, key = defaultdict(int), Counter()
    for doc_id, text, source in rows:
        sizes[source] += len(words(text))
    want = brute_targets(sizes) if rows else {}
    for doc_id, text, source in rows:
        key[doc_id, len(words(text)), sizes[source], round(want[source], 6)] += 1
    assert Counter((d, s, ss, round(t, 6)) for d, s, ss, t, _ in out) == key
    assert all(0 <= taken <= 2 * size for _, size, _, _, taken in out)
    by_fact = defaultdict(int)
    for _, _, ss, t, taken in out:
        by_fact[ss, round(t, 6)] += taken
    needed = defaultdict(int)
    for s in sizes:
        needed[sizes[s], round(want[s], 6)] += int(want[s] + 0.5)
    assert by_fact == needed                                  # to the word
    return docs, out


def corpus(n, seed, sources=5, hot=True):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        source = "s0" if hot and i % 3 == 0 else f"s{rnd.randrange(sources)}"
        out.append((i, " ".join(f"w{i}_{k}" for k in range(rnd.choice([0, 1, 5, 60, 200, 700]))), source))
    return out


def test_targets_and_bounds(spark):
    rows = corpus(300, 1) + [(900, "one two three", "tiny"), (901, "a", None), (902, "", "void"), (903, None, "void")]
    docs, out = checked(spark, rows)
    assert Counter(out) == Counter(tuple(r) for r in mixing.digest(docs.repartition(7)).collect())       # reruns agree


def test_messy(spark, messy, messy_rows):
    checked(spark, [(r[0], r[1], r[3]) for r in messy_rows], messy)


def test_empty(spark, empty):
    assert mixing.digest(empty).collect() == []
    checked(spark, [(1, "", "a"), (2, None, None), (3, " \n", "a")])


@pytest.mark.parametrize("slots", [8, 4096])
def test_mixed_texts(spark, monkeypatch, slots):
    """The texts of the mix hold just the words that the counts say, and each shard is full."""
    monkeypatch.setattr(mixing, "SHARD_SLOTS", slots)
    monkeypatch.setattr(mixing, "CHUNK", 2 if slots == 8 else mixing.CHUNK)
    rows = corpus(120, 2) + [(500, " \n".join(["r"] * 90), "s1"), (500, " \n".join(["r"] * 90), "s1")]
    docs = spark.createDataFrame([(*r, "x", 1, 2, "y") for r in rows], SCHEMA)
    taken = Counter()
    for r in mixing.digest(docs).collect():
        taken[r["doc_id"]] += r["taken"]
    mix = mixing.mixed(docs).collect()
    seen = Counter()
    for r in mix:
        w = r["text"].split(" ")
        assert len(w) == r["n_words"] <= mixing.BLOCK_WORDS
        seen.update(500 if x == "r" else int(x[1:].split("_")[0]) for x in w)
    assert seen == +taken
    by_word = Counter(x for r in mix for x in r["text"].split(" ") if x != "r")
    assert max(by_word.values()) <= 2
    shards = defaultdict(list)
    for r in mix:
        shards[r["shard"]].append(r["position"])
    assert all(sorted(p) == list(range(len(p))) for p in shards.values())
    assert all(len(p) == slots for s, p in shards.items() if s < max(shards))


def test_permutation():
    for n in (1, 2, 3, 17, 64, 65, 1000):
        at = np.arange(n)
        a = mixing.permuted(at, np.full(n, n), mixing.permutation_key(np.full(n, 5), np.zeros(n)))
        b = mixing.permuted(at, np.full(n, n), mixing.permutation_key(np.full(n, 5), np.ones(n)))
        assert sorted(a) == sorted(b) == list(range(n))
        assert (mixing.permuted(a, np.full(n, n), mixing.permutation_key(np.full(n, 5), np.zeros(n)), inverse=True) == at).all()
        if n >= 64:
            assert (a != at).mean() > 0.8 and (a != b).mean() > 0.8


def test_shards_follow_the_weights(spark, monkeypatch):
    """Each shard holds about its share of every source."""
    monkeypatch.setattr(mixing, "SHARD_SLOTS", 100)
    docs = spark.createDataFrame([(*r, "x", 1, 2, "y") for r in corpus(400, 3, sources=3, hot=False)], SCHEMA)
    _, sources, mix = mixing.planned(docs)
    chance = {r["number"]: r["slots"] for r in sources.collect()}
    total = sum(chance.values())
    by_shard = defaultdict(Counter)
    for r in mix.collect():
        by_shard[r["shard"]][r["number"]] += 1
    for counts in by_shard.values():
        n = sum(counts.values())
        for number, c in chance.items():
            p = c / total
            assert abs(counts[number] - n * p) <= 6 * (n * p * (1 - p)) ** 0.5 + 1
