"""The reviews feed and star over small tables with orphans and repeated keys."""
import datetime as dt
import os

import pytest

from terroir.operators.windows import dedup_by_id
from terroir.plans import reviews as R
from terroir.session import ensure_checkpoint_dir

TS = dt.datetime(1996, 9, 13)
TABLES = {
    "region": ([(0, "R0")], "r_regionkey long, r_name string"),
    "nation": ([(0, "N0", 0)], "n_nationkey long, n_name string, n_regionkey long"),
    "customer": ([(1, 0, "AUTO"), (2, 0, "FOOD")], "c_custkey long, c_nationkey long, c_mktsegment string"),
    "orders": ([(k, 1 + k % 2, "1-URGENT") for k in range(1, 30)] + [(7, 1, "2-HIGH")],      # order 7 twice, 30.. missing
               "o_orderkey long, o_custkey long, o_orderpriority string"),
    "part": ([(1, "red plate", "Brand#1", "SMALL"), (2, "hot gear", "Brand#2", "LARGE")],
             "p_partkey long, p_name string, p_brand string, p_type string"),
    "supplier": ([(1, "Supplier#1")], "s_suppkey long, s_name string"),
    "lineitem": ([(o, n, 1 + o % 3, 1, TS, 10.0 + n, 100.0, 0.1, 0.1, "N", "O") for o in range(1, 41) for n in (1, 2, 3)],
                 "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_shipdate timestamp, l_quantity double, "
                 "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string"),
}


@pytest.fixture()
def tables(spark, tmp):
    for name, (rows, schema) in TABLES.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp}/{name}.parquet")
    return tmp


def _written(spark, name):
    base = f"{ensure_checkpoint_dir(spark).removeprefix('file://').rstrip('/')}/terroir"
    return {f for f in (os.listdir(base) if os.path.isdir(base) else []) if f.startswith(name)}


def test_ids_are_dense_over_the_joined_rows(spark, tables):
    # parts 1 and 2 only, orders 1..29 only, order 7 twice
    n = sum(2 if o == 7 else 1 for o in range(1, 30) for _ in (1, 2, 3) if 1 + o % 3 <= 2)
    ids = sorted(r.ordinal for r in R.feed(spark, tables).select("ordinal").collect())
    assert ids == list(range(1, n + 1))
    assert R.d02_fct_resena(spark, tables).count() == n


def test_each_part_builds_only_what_it_needs(spark, tables):
    dims, facts = _written(spark, "reviews_dims"), _written(spark, "reviews_fact")
    R.feed(spark, tables)
    assert _written(spark, "reviews_dims") == dims
    assert R.d07_dim_pais(spark, tables).count() == 1
    assert _written(spark, "reviews_dims") != dims and _written(spark, "reviews_fact") == facts
    R.d02_fct_resena(spark, tables)
    assert _written(spark, "reviews_fact") != facts and not _written(spark, "reviews_staging")


def test_the_feed_is_ranged_on_what_a_review_shows(spark, tables):
    from terroir.sources.testdata import raw_reviews
    p = raw_reviews(spark, tables, ranged=True)._jdf.queryExecution().executedPlan().toString()
    assert "l_tax" not in p and "l_returnflag" not in p


def test_dedup_moves_no_row_where_no_id_repeats(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (None, "c")], "id int, t string")
    assert "Exchange" not in dedup_by_id(df, "id")._jdf.queryExecution().executedPlan().toString()
    twice = spark.createDataFrame([(1, "b"), (1, "a"), (2, "x"), (None, "d"), (None, "c")], "id int, t string")
    assert sorted(map(str, dedup_by_id(twice, "id").collect())) == sorted(
        ["Row(id=1, t='a')", "Row(id=2, t='x')", "Row(id=None, t='c')"])
