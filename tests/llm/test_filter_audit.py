import re
from collections import defaultdict
from itertools import permutations

import pytest

from terroir.llm import filter_audit

COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def failed(rows):
    """The filters that each row fails, by their definitions."""
    out = []
    for doc_id, text, *_ in rows:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        f = {"A"} if len(w) < 200 else set()
        f |= {"B"} if 100 * len(set(w)) < 50 * len(w) else set()
        f |= {"C"} if 100 * len(re.findall("[A-Z]", t)) > 3 * len(t) else set()
        f |= {"D"} if re.search(r"[#$%&*|]", t) else set()
        if doc_id is not None and any(o[0] is not None and o[0] < doc_id and (o[1] or "") == t for o in rows):
            f.add("E")
        out.append(f)
    return out


def brute(rows, labels):
    good = {d for d, q, _ in labels if d is not None and q == 1}
    toxic = {d for d, _, x in labels if d is not None and x == 1}
    cells = {}
    for part in {r[2] or "" for r in rows}:
        docs = [(r[0], f) for r, f in zip(rows, failed(rows), strict=True) if (r[2] or "") == part]
        shapley = defaultdict(int)
        for order in permutations("ABCDE"):
            left = list(docs)
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                fails = sum(f in d[1] for d in docs)
                shapley[f] += len(gone)
                cells[part, "".join(order), step] = [
                    len(left), len(gone), fails - len(gone), sum(d[1] == {f} for d in docs),
                    sum(d[0] in good for d in gone), sum(d[0] in toxic for d in gone)]
        for (p, order, step), v in cells.items():
            if p == part:
                v.append(shapley[order[step - 1]])
    return cells


def checked(spark, rows, labels, docs=None):
    docs = docs if docs is not None else spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = filter_audit.digest(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert got.columns == COLUMNS
    assert {(r[0], r[1], r[2]): list(r)[3:] for r in got.collect()} == brute(rows, labels)
    return got


def test_messy(spark, messy, messy_rows):
    rows = [(r[0], r[1], r[2]) for r in messy_rows]
    checked(spark, rows, [(1, 1, 0), (2, 0, 1), (2, 1, None), (9, 1, 1), (None, 1, 1), (77, 1, 1), (7, None, None)], messy)


def test_every_mask(spark):
    bodies = [" ".join(f"w{i}" for i in range(n)) + s for n in (10, 250) for s in ("", " AAAAAAAAAAAAAAAAAAAAAAAA" * 3, " #", " x" * 300)]
    rows = [(i, bodies[(i * 7) % len(bodies)] + (" y" if i % 3 else ""), [None, "", "en", "de"][i % 4]) for i in range(80)]
    rows += [(5, rows[5][1], "en"), (None, rows[5][1], "en"), (None, None, "en")]
    checked(spark, rows, [(i, i % 2, i % 3 // 2) for i in range(0, 80, 2)])


def test_copies_across_parts(spark):
    """A copy is one whatever its part, and only the smallest doc_id is the first."""
    rows = [(i, "the same text", "en" if i % 2 else "de") for i in range(300)] + [(0, "the same text", "fr")]
    checked(spark, rows, [(0, 1, 0), (1, 1, 1)])


def test_empty(spark, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.digest(empty, labels).count() == 0


@pytest.mark.parametrize("mask", [1, 6, 31])
def test_intervals_are_the_removal_steps(spark, mask):
    got = [r for r in filter_audit.intervals(spark).where(f"mask = {mask}").collect()]
    steps = {}
    for r in got:
        for rank in range(r["start"], r["end"]):
            assert (rank, r["step"]) not in steps
            steps[rank, r["step"]] = True
    want = {}
    for rank, order in enumerate(permutations(range(5))):
        want[rank, next(s for s, f in enumerate(order, 1) if mask >> f & 1)] = True
    assert steps == want


def test_native(spark, messy):
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    plan = filter_audit.audit(filter_audit.masked(messy, labels))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|CartesianProduct|BroadcastNestedLoopJoin", plan)
