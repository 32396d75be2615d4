import hashlib
import re
from collections import Counter

import pytest

from terroir.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items):
    windows = {}
    for item_id, text in items:
        w = words(text)
        k = min(13, len(w))
        for i in range(len(w) - k + 1 if w else 0):
            windows.setdefault(tuple(w[i:i + k]), set()).add(item_id)
    lengths = {len(k) for k in windows}
    out = Counter()
    for d in docs:
        w, hit, ids = words(d[1]), set(), set()
        for k in lengths:
            for i in range(len(w) - k + 1):
                if tuple(w[i:i + k]) in windows:
                    hit.update(range(i, i + k))
                    ids |= windows[tuple(w[i:i + k])]
        names = sorted(str(i) for i in ids if i is not None)
        out[(d[0], len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(),
             bool(hit) and 20 * len(hit) >= len(w))] += 1
    return out


ITEMS = [(1, " ".join(f"w{i}" for i in range(20))), (2, "The the THE"), (10, "x"), (3, None), (4, ""), (5, "--- !!"),
         (6, "the the the"), (None, "some words"), (7, "ünï Çødé"), (1, " ".join(f"w{i}" for i in range(20))),
         (8, " ".join(f"w{i}" for i in range(100, 113)))]


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(*i, "clash") for i in ITEMS], "item_id long, text string, doc_id string")


@pytest.mark.parametrize("max_windows", [200_000, 3])
def test_digest_equals_brute_force(messy, messy_rows, items, max_windows, monkeypatch):
    hits = decontaminate.hits
    monkeypatch.setattr(decontaminate, "hits", lambda d, b: hits(d, b, max_windows=max_windows))
    got = Counter(tuple(r) for r in decontaminate.digest(messy, items).collect())
    assert got == brute(messy_rows, ITEMS)


@pytest.mark.parametrize("max_bytes", [64 << 20, 20_000])
def test_long_windows_and_windows_of_many_items(spark, monkeypatch, max_bytes):
    """Windows too long for the broadcast go as a digest, and the items of one window as several rows."""
    long = [c * 3000 for c in "abcdefgh"]
    texts = [(1, " ".join(long)), (2, " ".join(long[:7])), (3, "x " + " ".join(long[:7]) + " y"), (4, "same short words here"),
             (5, " ".join(long[:6] + ["g" * 2999 + "h"])), (6, "Same, short words here!"), (7, None)]
    items = [(100, " ".join(long[:7])), (101, " ".join(long[4:6])), *[(1000 + i, "same short words here") for i in range(25)]]
    monkeypatch.setattr(decontaminate, "MAX_ITEMS", 10)
    hits = decontaminate.hits
    monkeypatch.setattr(decontaminate, "hits", lambda d, b: hits(d, b, max_bytes=max_bytes))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = Counter(tuple(r) for r in decontaminate.digest(spark.createDataFrame(texts, "doc_id long, text string"), bench).collect())
    assert got == brute(texts, items)
    windows = decontaminate.item_windows(bench).collect()
    assert len(windows) == 5 and max(r["__bytes"] for r in windows) < 1000


def test_no_items(messy, items):
    assert decontaminate.digest(messy, items.limit(0)).where("n_hit > 0 or contaminated").count() == 0


def test_remove(spark, items):
    docs = spark.createDataFrame([
        (1, "clean words only here", "a"), (2, "(The the, the) tail", "b"), (None, "the the the", "c"), (4, None, "d")],
        "doc_id long, text string, n_hit string")
    kept = decontaminate.remove(docs, items)
    assert kept.columns == docs.columns and sorted(r["n_hit"] for r in kept.collect()) == ["a", "d"]
    cut = {r["n_hit"]: r["text"] for r in decontaminate.remove(docs, items, "spans").collect()}
    assert cut == {"a": "clean words only here", "b": "(tail", "c": "", "d": None}


def test_empty(empty, items):
    assert decontaminate.digest(empty, items).count() == 0
