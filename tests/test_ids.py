import random

from pyspark.sql import functions as F

from terroir.operators.ids import global_row_number, rank_within_groups


def test_global_row_number_matches_sort(spark):
    rnd = random.Random(7)
    rows = [(rnd.randint(0, 50), rnd.randint(0, 5), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "a int, b int, c int").repartition(7)
    out = global_row_number(df, ["a", "b", "c"], "rn", num_partitions=5).collect()
    expected = {r: i + 1 for i, r in enumerate(sorted(rows))}
    assert len(out) == len(rows)
    assert all(expected[(r.a, r.b, r.c)] == r.rn for r in out)


def test_rank_within_groups(spark):
    df = spark.createDataFrame([("x", 5), ("x", 1), ("y", 3), ("x", 2), ("y", 9)], "g string, v int")
    out = sorted((r.g, r.v, r.id) for r in rank_within_groups(df, "g", ["v"], "id").collect())
    assert out == [("x", 1, 1), ("x", 2, 2), ("x", 5, 3), ("y", 3, 1), ("y", 9, 2)]
