import math
import random

import numpy as np
import pytest

from terroir.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, score long, key string"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows, limit=hn.LIMIT):
    """By the definitions, one pair after the other."""
    seen = []
    for vec_id, v, label, *_ in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if vec_id is not None and vec_id % 7 == 0 else label
        ints = tuple(max(-limit, min(limit, math.floor(256 * float(np.float32(x))))) for x in v)
        if (vec_id, label, ints) not in seen:
            seen.append((vec_id, label, ints))
    out = []

    def best(kept):
        return sorted(kept, key=lambda t: (-t[0], t[1] is None, t[1] or 0))[:5]
    for anchor in seen:
        if anchor[0] is None or anchor[0] % 100:
            continue
        scored = [(sum(a * b for a, b in zip(anchor[2], r[2], strict=False)), r[0], r[1]) for r in seen if r != anchor]
        for ps, pid, _ in best([s for s in scored if s[2] == anchor[1]]):
            band = [s for s in scored if s[2] != anchor[1] and 80 * ps <= 100 * s[0] <= 100 * ps]
            out += [(anchor[0], pid, k, s[1], ps, s[0]) for k, s in enumerate(best(band), 1)]
    return sorted(out, key=str)


def checked(spark, rows):
    got = hn.digest(spark.createDataFrame(rows, SCHEMA))
    assert got.columns == COLUMNS
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)


def vectors(n, width, seed, noise=0.5, clusters=6):
    rnd = np.random.default_rng(seed)
    centres = rnd.standard_normal((clusters, width))
    return [((centres[i % clusters] + noise * rnd.standard_normal(width)) / np.sqrt(width)).astype(np.float32).tolist() for i in range(n)]


@pytest.mark.parametrize("width", [3, 64, 70])
def test_brute_force(spark, width, monkeypatch):
    monkeypatch.setattr(hn, "BLOCK", 3)
    rows = [(i, v, i % 4, None, None) for i, v in enumerate(vectors(640, width, width))]
    checked(spark, rows)


def test_ties_and_a_hot_vector(spark):
    rnd = random.Random(4)
    same = vectors(1, 16, 1)[0]
    few = vectors(5, 16, 2, clusters=1)
    rows = [(i, same if i % 3 else rnd.choice(few), rnd.randrange(3), None, None) for i in range(450)]
    checked(spark, rows)


def test_messy(spark):
    nan, inf = float("nan"), float("inf")
    ok = vectors(40, 8, 3, clusters=2)
    rows = [(100 * (i // 8) + i % 8, v, i % 2, None, "x") for i, v in enumerate(ok)]
    rows += [(900, None, 1, None, None), (901, ok[0], None, None, None), (902, [nan, 1.0], 1, None, None), (903, [inf], 0, None, None),
             (904, [1.0, None], 0, None, None), (1000, [], 0, None, None), (1001, [], 0, None, None), (None, ok[1], 0, None, None),
             (1100, ok[2][:3], 1, None, None), (1200, [0.0] * 8, 1, None, None), (-100, [-x for x in ok[3]], 0, None, None)]
    rows += [rows[0], rows[0], rows[9]]
    checked(spark, rows)
    checked(spark, [(0, [1e30, 1.0], 1, None, None), (1, [1e30, 2.0], 3, None, None), (2, [3e4, -1.0], 3, None, None),
                    (3, [1e30, 1.0], 4, None, None), (4, [2.9e4, -1.0], 1, None, None)])


def test_empty(spark):
    assert hn.digest(spark.createDataFrame([], SCHEMA)).collect() == []
    assert hn.digest(spark.createDataFrame([(1, [1.0], 2, None, None)], SCHEMA)).collect() == []


def test_interval_holds_every_score():
    """The interval of each level contains the score, for any pair."""
    width = 64
    v = np.floor(256 * np.array(vectors(200, width, 9, noise=1.0))).astype(np.int64)
    turn = hn.rotation(width)
    codes, alignments, residual = hn.encode(v.astype(float) @ turn)
    rows = hn.Rows.__new__(hn.Rows)
    rows.codes, rows.alignments, rows.residual = codes, alignments, residual
    rows.lengths = np.sqrt((v.astype(float) ** 2).sum(1))
    true = v @ v.T
    spans = []

    def wanted(low, high):
        assert (low <= true).all() and (true <= high).all()
        spans.append(float((high - low).mean()))
        return np.ones(true.shape, bool)
    hn.survivors(hn.Planes(v, turn), slice(0, 200), rows, wanted)
    assert len(spans) == hn.LEVELS and spans[0] > 2 * spans[-1]
    assert np.allclose(turn @ turn.T, np.eye(width))
