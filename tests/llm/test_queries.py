"""Registration, oracle SQL and the pipeline."""
import sys
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline
from terroir.llm import decontaminate, line_dedup, ngram_jaccard, packing, quality_rules
from terroir.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def test_registered():
    found = E.queries()
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
    assert set(QUERIES) <= set(found) and "pipeline" in found


def test_entry_without_the_subpackage(monkeypatch):
    monkeypatch.setitem(sys.modules, "terroir.llm.queries", None)
    assert not set(QUERIES) & set(E.queries()) and "pipeline" not in E.queries()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    res = con.execute(ORACLE[name])
    cols = [d[0] for d in res.description]
    assert Counter(tuple(r) for r in df.select(*cols).collect()) == Counter(res.fetchall())


def test_pipeline_stages(spark):
    """Each stage's decisions, from the operators' own digests over its input."""
    docs = corpus_pipeline.table(spark, SF, "documents")
    a = corpus_pipeline.rule_stage(spark, docs, SF).cache()
    assert {r[0] for r in a.select("doc_id").collect()} == {
        r["doc_id"] for r in quality_rules.digest(docs).collect() if r["kept"]}
    b = corpus_pipeline.line_stage(spark, a, SF).cache()
    assert b.count() == a.count()
    assert line_dedup.digest(a).where("n_dropped > 0").count() == a.select("doc_id", "text").subtract(b.select("doc_id", "text")).count()
    c = corpus_pipeline.near_duplicate_stage(spark, b, SF).cache()
    groups = ngram_jaccard.digest(b).collect()
    assert {r[0] for r in c.select("doc_id").collect()} == {r["component_id"] for r in groups}
    d = corpus_pipeline.benchmark_stage(spark, c, SF).cache()
    bad = {r["doc_id"] for r in decontaminate.digest(c, corpus_pipeline.table(spark, SF, "benchmark")).where("contaminated").collect()}
    assert {r[0] for r in d.select("doc_id").collect()} == {r[0] for r in c.select("doc_id").collect()} - bad
    assert [x.columns for x in (a, b, c, d)] == [docs.columns] * 4
    e = corpus_pipeline.packing_stage(spark, d, SF)
    assert {r[0] for r in e.select("doc_id").distinct().collect()} == {r[0] for r in d.select("doc_id").collect()}
    whole = corpus_pipeline.run(spark, SF)
    key = ["doc_id", "start", "length", "ids_crc32"]
    assert Counter(tuple(r) for r in whole.select(*key).collect()) == Counter(tuple(r) for r in e.select(*key).collect())
    assert packing.digest(d).columns == whole.columns


def words(prefix, n):
    return " ".join(f"{prefix}{i}" for i in range(n))


def test_pipeline_on_messy_documents(spark, tmp_path, messy, messy_rows):
    """Short, repetitive, copied and contaminated texts go; one of each group of copies stays, whatever its columns hold."""
    def row(doc_id, text, lang="en", source="s0"):
        return (doc_id, text, lang, source, len(text), 7, "clash", None)
    passage = words("item", 13)
    rows = [*messy_rows, row(100, words("a", 80)), row(101, words("a", 80)), row(102, words("a", 79) + " changed"),
            row(103, words("b", 60) + " " + passage), row(104, words("c", 70), None, None), row(105, words("d", 70)), row(105, words("d", 70)),
            row(105, words("e", 70)), row(None, words("f", 70), None, None), row(106, words("g", 700) + " " + passage)]
    docs = spark.createDataFrame(rows, messy.schema)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([("q1", passage), (None, None), ("q2", "")], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    got = Counter(r["doc_id"] for r in out.where("start = 0").collect())
    assert got == Counter({100: 1, 104: 1, 105: 2, None: 1, 106: 1})      # 106: 13 of 713 words are under one in twenty
    empty = tmp_path / "empty"
    docs.limit(0).write.parquet(f"{empty}/documents.parquet")
    spark.createDataFrame([], "item_id string, text string").write.parquet(f"{empty}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(empty)).count() == 0
