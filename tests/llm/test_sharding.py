import random
import zlib
from collections import defaultdict

import pytest

from terroir.llm import sharding


def check(rows, got, n):
    size = lambda t: len((t or "").encode()) + 8
    assert sorted((r["doc_id"] or -1, r["size"], r["text_crc32"]) for r in got) == sorted(
        (r[0] or -1, size(r[1]), zlib.crc32((r[1] or "").encode())) for r in rows)
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(n))
    return slots


def test_messy(messy, messy_rows):
    got = sharding.digest(messy, 4).collect()
    check(messy_rows, got, 4)
    assert {r["law"] for r in got} == {"bytes"} and {r["grown_shard"] for r in got} == {None}
    by_text = defaultdict(set)
    texts = {(r[0], len((r[1] or "").encode()) + 8): r[1] or "" for r in messy_rows}
    for r in got:
        by_text[texts[r["doc_id"], r["size"]]].add(r["shard"])
    assert all(len(s) == 1 for s in by_text.values())


@pytest.mark.parametrize("hot", [0, 400])
def test_near_equal_and_minimal(spark, hot):
    rnd = random.Random(3)
    rows = [(i, "h" * 900 if i < hot else "".join(rnd.choices("abc d", k=rnd.randint(0, 400)))) for i in range(900)]
    n = 8
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sharding.assign(docs, n).collect()
    check(rows, got, n)
    load = defaultdict(int)
    for r in got:
        load[r["shard"]] += r["size"]
    groups = defaultdict(int)
    for _, t in rows:
        groups[t] += len(t) + 8
    others = sorted(load.values())[:-1] if hot else sorted(load.values())
    largest = max(v for k, v in groups.items() if k[:1] != "h")
    assert len(load) == n and max(others) - min(others) <= 2 * largest
    if hot:
        assert max(load.values()) == 400 * 908


def exact_capacity(sizes, n):
    low, high = max(max(sizes), -(-sum(sizes) // n)), sum(sizes)
    while low < high:
        mid, shards, at = (low + high) // 2, 1, 0
        for s in sizes:
            if at + s > mid:
                shards, at = shards + 1, 0
            at += s
        low, high = (low, mid) if shards <= n else (mid + 1, high)
    return low


@pytest.mark.parametrize("points", [3, 50, 5000])
def test_capacity_equals_exact_search(spark, points):
    rnd = random.Random(points)
    sizes = [rnd.choice([8, 9, 40, 300, 1000]) for _ in range(700)]
    at, rows = 0, []
    for s in sizes:
        at += s
        rows.append((at, s))
    sums = spark.createDataFrame(rows, "__cum long, __size long").cache()
    got, borders = sharding.minimax_capacity(sums, [], at, max(sizes), 6, points)
    assert got == exact_capacity(sizes, 6)
    ends = sharding.even_cuts(sums, borders, 0, got, at, 6, points)
    assert ends[-1] == at and set(ends) <= {r[0] for r in rows}
    assert max(b - a for a, b in zip([0, *ends], ends)) <= got


def test_empty(empty):
    assert sharding.digest(empty).count() == 0
