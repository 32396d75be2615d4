"""Sharding: minimax contiguous partition of atomic groups (law ``bytes``).

Method: rows with equal texts form one atomic group.  The groups are put in
one fixed order: first the oversize groups (more than an average shard;
fewer than ``n_shards`` of them by definition), largest first, then all others
by text hash, which mixes the documents.  Over the running sizes of that
order the smallest feasible shard capacity is found by binary search, each
capacity being checked greedily.  The cuts are then made within that
capacity, each as near as possible to an equal share of what is left.

The running sizes stay distributed.  The search sees at most ``points``
break points per cut, collected by an aggregate: a coarse list bounds the
capacity from both sides (break points only: feasible for certain; any byte:
infeasible for certain), and the windows in which a cut can still lie are
refined until they hold single groups.  Each pass narrows a window by the
factor ``points``, so a handful of passes suffices at any size.

A row's shard follows from its own hash and ``n_shards - 1`` literal cuts, so
no row is joined with its group.  A group's size comes from a partial
aggregate, hence a text that a third of all rows share is one row per task.

Defined results
* null text: no bytes, checksum 0; null and empty texts are one group.
* repeated rows: each is counted and gets its own slot.
* ties (equal hash and doc_id): slots in arbitrary order among equals.
* very long texts: only their size, checksum and hash are taken; one text is never split.
* empty table: empty result.  Shards may be empty when there are fewer
  groups than shards.
* extra columns are not read; the result has the contract's columns.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terroir.llm.storage import shuffle_partitions, written
from terroir.llm.text import text_or_empty
from terroir.operators.ids import attach_row_number, range_local_index

ROW_OVERHEAD = 8
N_SHARDS = 24
POINTS = 1024
N_BUCKETS = 1024


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, __h1, __h2) per row; the 128-bit hash names the group."""
    t = text_or_empty("text")
    return docs.select("doc_id", (F.octet_length(t) + ROW_OVERHEAD).cast("long").alias("size"),
                       F.crc32(F.encode(t, "UTF-8")).cast("long").alias("text_crc32"),
                       F.xxhash64(t).alias("__h1"), F.xxhash64(F.lit(1), t).alias("__h2"))


def running_sizes(groups: DataFrame) -> DataFrame:
    """``groups`` (__h1, __h2, __size) plus ``__cum``, the running size by hash.

    The hash space is cut into ``N_BUCKETS`` equal ranges (one row per group,
    so they are even); each runs its own sum and starts at the total of the
    ranges before it (``N_BUCKETS`` rows).
    """
    bucket = F.floor(F.col("__h1") / F.lit(2.0 ** 64 / N_BUCKETS)).cast("int")
    groups = groups.withColumn("__bucket", bucket)
    totals = groups.groupBy("__bucket").agg(F.sum("__size").alias("__total"))
    before = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("__bucket", F.coalesce(F.sum("__total").over(before), F.lit(0)).alias("__start"))
    in_bucket = (Window.partitionBy("__bucket").orderBy("__h1", "__h2")
                 .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (groups.withColumn("__run", F.sum("__size").over(in_bucket))
            .join(F.broadcast(starts), "__bucket")           # N_BUCKETS rows
            .select("__h1", "__h2", "__size", (F.col("__start") + F.col("__run")).alias("__cum")))


class Borders:
    """Known group borders (running sizes), and which gaps hold just one group."""

    def __init__(self, ends: list[int]):
        self.single = set(ends)                    # borders whose gap to the one before is one group
        self.points = sorted({0, *ends})

    def add(self, groups: list[tuple[int, int]]) -> None:
        """``groups``: (end, size); both its start and its end are borders."""
        self.single.update(end for end, _ in groups)
        self.points = sorted({*self.points, *(end for end, _ in groups), *(end - size for end, size in groups)})

    def greedy(self, capacity: int, n_shards: int, known: bool) -> list[int]:
        """Ends of the greedy shards.  ``known``: cut at known borders only (a
        lower bound of the true cuts); else also at any byte of a gap that may
        hold further borders (an upper bound)."""
        ends, at, last = [], 0, len(self.points) - 1
        for _ in range(n_shards):
            k = bisect_right(self.points, at + capacity) - 1
            if known or k == last or self.points[k + 1] in self.single:
                at = self.points[k]
            else:
                at = min(at + capacity, self.points[k + 1] - 1)
            ends.append(at)
        return ends

    def smallest_capacity(self, n_shards: int, low: int, high: int, known: bool) -> int:
        """Binary search of the smallest capacity whose greedy shards reach the end."""
        while low < high:
            mid = (low + high) // 2
            if self.greedy(mid, n_shards, known)[-1] >= self.points[-1]:
                high = mid
            else:
                low = mid + 1
        return low


def border_groups(sums: DataFrame, windows: list[tuple[int, int]], points: int) -> list[tuple[int, int]]:
    """(end, size) of the last group in each of about ``points`` steps per window.

    One scan and one aggregate for all windows (ascending, disjoint): running sizes
    rise, so the largest end and the largest start of a step are its last group's.
    """
    if not windows:
        return []
    cum = F.col("__cum")
    starts, ends, steps = ([F.lit(x).cast("long") for x in xs] for xs in zip(
        *[(a, b, max(1, (b - a) // points)) for a, b in windows], strict=True))
    window = F.size(F.filter(F.array(*starts), lambda a: a <= cum))

    def of(values):
        return F.element_at(F.array(*values), F.col("__window"))
    inside = (sums.where((cum >= windows[0][0]) & (cum <= windows[-1][1])).withColumn("__window", window)
              .where(cum <= of(ends)))
    found = (inside.groupBy("__window", F.floor((cum - of(starts)) / of(steps)).alias("__step"))
             .agg(F.max("__cum").alias("end"), F.max(cum - F.col("__size")).alias("start")))
    return [(r["end"], r["end"] - r["start"]) for r in found.collect()]        # <= windows * (points + 2) rows


def merged(windows: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(windows):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def minimax_capacity(sums: DataFrame, head: list[int], total: int, largest: int, n_shards: int,
                     points: int = POINTS) -> tuple[int, Borders]:
    """The smallest feasible capacity over the order ``head`` sizes first, then
    the groups of ``sums`` (whose ``__cum`` starts after the head), and the
    borders found on the way."""
    heads = list(accumulate(head))
    after = heads[-1] if heads else 0
    borders = Borders(heads)
    low, high = max(-(-total // n_shards), largest), -(-total // n_shards) + largest
    windows = [(after, total)]
    while True:
        borders.add(border_groups(sums, windows, points))
        high = borders.smallest_capacity(n_shards, low, high, known=True)
        low = borders.smallest_capacity(n_shards, low, high, known=False)
        if low == high:
            return high, borders
        bottoms, tops = borders.greedy(low, n_shards, True), borders.greedy(high, n_shards, False)
        # up to the border behind the top: the group that ends there closes the last gap
        tops = [borders.points[bisect_left(borders.points, b)] for b in tops]
        finer = merged([(max(a, after), b) for a, b in zip(bottoms, tops, strict=True) if b > after])
        points *= 8 if finer == windows else 1               # no narrower windows: smaller steps
        windows = finer


def even_cuts(sums: DataFrame, borders: Borders, after: int, capacity: int, total: int, n_shards: int,
              points: int = POINTS) -> list[int]:
    """Shard ends within ``capacity``, each nearest to an equal share of the rest.

    A cut must leave no more than the remaining shards can hold, and no shard
    may exceed the capacity; inside these limits the known border nearest to
    the equal share wins.  Borders around each share are fetched as needed.
    """
    need, at = [], total                                     # least end of each shard, greedily from behind
    for _ in range(n_shards):
        need.append(at)
        at = borders.points[bisect_left(borders.points, max(0, at - capacity))]
    need.reverse()
    even = max(1, (total - after) // n_shards)
    expected = [(k, k + even // 16) for k in range(after + even - even // 32, total, even)]
    borders.add(border_groups(sums, expected[:n_shards], points))
    ends, at = [], 0
    for j in range(n_shards):
        share = at + -(-(total - at) // (n_shards - j))
        near = max(1, (share - at) // 64)
        around = bisect_right(borders.points, share + near) - bisect_left(borders.points, share - near)
        if share > after and around < 4:                     # nothing known so close
            borders.add(border_groups(sums, [(max(after, share - near), share + near)], points))
        pts = borders.points
        first = max(bisect_right(pts, at), bisect_left(pts, need[j]))    # at least one group, while there are any
        options = pts[first:bisect_right(pts, at + capacity)] or [total]
        i = bisect_left(options, share)
        at = min(options[max(0, i - 1):i + 1], key=lambda x: (abs(x - share), x))
        ends.append(at)
    return ends


def shard_column(sums: DataFrame, big: list, ends: list[int], n_shards: int) -> Column:
    """The shard of a row from its hash: literal cuts, and literal oversize groups."""
    heads, at = [], 0
    for r in big:
        at += r["__size"]
        heads.append((r["__h1"], r["__h2"], bisect_left(ends, at)))
    inner = sorted({e for e in ends[:-1] if e > at})
    cut_rows = sums.where(F.col("__cum").isin(inner)).collect() if inner else []   # <= n_shards rows
    by_cum = {r["__cum"]: (r["__h1"], r["__h2"]) for r in cut_rows}
    shard = F.lit(sum(e <= at for e in ends[:-1])).cast("int")
    for e in ends[:-1]:
        if e > at and e in by_cum:
            h1, h2 = by_cum[e]
            after = (F.col("__h1") > h1) | ((F.col("__h1") == h1) & (F.col("__h2") > h2))
            shard = shard + after.cast("int")
    for h1, h2, s in heads:
        shard = F.when((F.col("__h1") == h1) & (F.col("__h2") == h2), F.lit(s)).otherwise(shard)
    return shard.cast("int")


def assign(docs: DataFrame, n_shards: int = N_SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) per row of ``docs``."""
    spark = docs.sparkSession
    rows = written(measured(docs), "shard-rows")
    groups = written(rows.groupBy("__h1", "__h2").agg(F.sum("size").alias("__size")), "shard-groups")
    facts = groups.agg(F.sum("__size").alias("total"), F.max("__size").alias("largest")).first()
    total, largest = facts["total"] or 0, facts["largest"] or 0
    if not total:
        return rows.select("doc_id", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    oversize = F.col("__size") * n_shards > total              # fewer than n_shards groups
    big = groups.where(oversize).orderBy(F.desc("__size"), "__h1", "__h2").collect()
    head = sum(r["__size"] for r in big)
    sums = written(running_sizes(groups.where(~oversize)).withColumn("__cum", F.col("__cum") + head), "shard-sums")
    capacity, borders = minimax_capacity(sums, [r["__size"] for r in big], total, largest, n_shards)
    ends = even_cuts(sums, borders, head, capacity, total, n_shards)
    sharded = rows.withColumn("shard", shard_column(sums, big, ends, n_shards))
    n = shuffle_partitions(spark)
    ranged = written(range_local_index(sharded.drop("__h1", "__h2"), ["shard", "doc_id"], n), "shard-ranged")
    numbered = attach_row_number(ranged, "__n")
    sizes = ranged.groupBy("shard").agg(F.count(F.lit(1)).alias("__rows"))       # n_shards rows
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__start"))
    return (numbered.join(F.broadcast(starts), "shard")
            .select("doc_id", "size", "text_crc32", "shard", (F.col("__n") - 1 - F.col("__start")).alias("slot")))


def digest(docs: DataFrame, n_shards: int = N_SHARDS) -> DataFrame:
    """The contract's columns."""
    return assign(docs.select("doc_id", "text"), n_shards).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
