import hashlib
from collections import Counter, defaultdict

from terroir.llm import line_dedup

WHITE = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(WHITE))


def brute(rows):
    holders = defaultdict(set)
    for r in rows:
        for line in (r[1] or "").split("\n"):
            if len(key(line)) >= 40:
                holders[key(line)].add(-1 if r[0] is None else r[0])
    out = []
    for r in rows:
        lines = (r[1] or "").split("\n")
        me = -1 if r[0] is None else r[0]
        kept = [x for x in lines if not (len(holders.get(key(x), ())) >= 5 and me != max(holders[key(x)]))]
        out.append((r[0], len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return Counter(out)


def test_digest_equals_brute_force(messy, messy_rows):
    got = Counter(tuple(r) for r in line_dedup.digest(messy).collect())
    assert got == brute(messy_rows)
    assert any(r[2] for r in got)


def test_hot_line_path(spark, messy, messy_rows, monkeypatch):
    monkeypatch.setattr(line_dedup, "MIN_HOT_DOCS", 4)
    assert Counter(tuple(r) for r in line_dedup.digest(messy).collect()) == brute(messy_rows)


def test_texts_and_columns(messy):
    out = line_dedup.dedup_lines(messy)
    assert out.columns == messy.columns and out.count() == messy.count()
    got = {r["doc_id"]: r for r in out.where("doc_id between 20 and 25").collect()}
    assert got[20]["text"] == "start 0\nend 0" and got[20]["n_chars"] == 13
    assert got[25]["text"].count("\n") == 3


def test_clashing_column(spark, messy):
    out = line_dedup.dedup_lines(messy.withColumnRenamed("x", "drop_runs").fillna("mine", ["drop_runs"]))
    assert {r[0] for r in out.select("drop_runs").collect()} == {"mine"}


def test_runs(spark):
    df = spark.createDataFrame([([0, 1, 4, 6, 7],), ([],)], "p array<int>")
    got = [[tuple(x) for x in r[0]] for r in df.select(line_dedup.drop_runs(df.p)).collect()]
    assert got == [[(0, 2), (4, 1), (6, 2)], []]


def test_empty(empty):
    assert line_dedup.digest(empty).count() == 0
    assert line_dedup.dedup_lines(empty).columns == empty.columns
