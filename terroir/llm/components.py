"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terroir.llm.storage import written


def _attached(edges: DataFrame, node: str) -> DataFrame:
    """Each edge with the smallest neighbour of its ``node`` end (a partial aggregate, then a join)."""
    other = "v" if node == "u" else "u"
    least = edges.groupBy(node).agg(F.min(other).alias("m"))
    return edges.join(least.withColumn("m", F.least("m", node)), node)


def connected(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """(id, component): the smallest id reachable, for every end of an edge.

    ``edges`` has u and v.  A round hangs every neighbour below the smallest
    one around it and is written, so lineage stays short; rounds grow with
    the logarithm of the longest chain.  A node with very many neighbours is
    an aggregate and a join that the skew-join rule can split.
    """
    current = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc")
    for _ in range(max_rounds):
        both = current.select("u", "v").unionAll(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _attached(both, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        hung = _attached(large, "u")
        small = hung.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(
            hung.select("u", F.col("m").alias("v"))).distinct()
        after = written(small, "cc")
        changed = after.join(current, ["u", "v"], "left_anti").limit(1).count() + after.count() - current.count()
        current = after
        if not changed:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    stars = current.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return stars.unionAll(current.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
