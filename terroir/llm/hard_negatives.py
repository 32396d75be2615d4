"""Hard negatives: for every anchor and positive, the best rows of other labels
whose score lies between 80 % and 100 % of the positive's.

Method: vectors become integers, are turned by one random rotation and coded by
their signs, one bit a dimension; what the code leaves over is coded again,
``LEVELS`` times.  With every code its alignment (the projection of what it
codes on the unit code vector) is stored.  An anchor is turned likewise and cut
into ``PLANES`` bit planes, so its product with a code is a weighted sum of
popcounts.  The sum over the levels estimates the score; the error is at most
the length of the residual times that of the anchor's part across the last code
(the residual is orthogonal to that code: Cauchy-Schwarz), plus what the planes
lose.  That interval is certain, not probable: rows whose interval cannot reach
an anchor's present fifth place, or misses the band, are left out level by
level, and the rest are scored exactly in 64-bit integers.

Scale: the anchors are a stated query set (every ``ANCHOR_STEP``-th vec_id).
They are numbered and taken in blocks of ``BLOCK`` anchors, each brought to all
tasks (at most ``BLOCK`` vectors and, in the second pass, ``N_POSITIVES`` scores
each); every task streams its own rows in batches, so memory is bounded by
batch times block, and keeps only the best rows per anchor, which a window then
merges over the tasks.  Rows are dealt once, by their whole contents (repeated
rows), and never by label or vector, hence none of these is hot.  The prepared rows and every block's results are written to the
shared folder, so a lost executor repeats only its own tasks.

Defined results
* null label or vector, null or non-finite component: no part, as the contract
  says.  Vectors of unequal length are filled up with zeros; an empty vector
  scores 0 with all.  Components beyond ``LIMIT`` in magnitude count as ``LIMIT``,
  so that scores fit a long.
* null vec_id: never an anchor; otherwise a row like others, last among ties.
* repeated rows (equal vec_id, label and vector) are one row; rows with one vec_id
  and different contents are each a row, as anchors too (equal vec_ids are then
  ordered by label and vector).
* an anchor without positives, or a positive without rows in its band: no row.
* empty table: empty result.  Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terroir.llm.storage import shared_path, written
from terroir.operators.ids import attach_row_number, range_local_index

ANCHOR_STEP = 100
N_POSITIVES = 5
N_NEGATIVES = 5
LOW_PERCENT = 80
BLOCK = 4096                      # anchors per block (broadcast: bounded by it)
BATCH = 2048                      # rows compared at a time
TILE = 1024                       # anchors compared at a time
LEVELS = 3
PLANES = 8
SEED = 20
LIMIT = 1 << 24
SLACK = 1e-9                      # of the lengths' product: rounding of doubles

PREPARED = ("vec_id long, label int, v array<int>, key long, codes array<long>, alignments array<double>, residual double")
FOUND = "anchor long, place int, row_id long, key long, score long"


def participants(embeddings: DataFrame) -> DataFrame:
    """(vec_id, label, v): the rows that take part, relabelled, as integers; repeated rows once."""
    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))

    def whole(x: Column) -> Column:
        return F.greatest(F.least(F.floor(256 * x.cast("double")), F.lit(LIMIT)), F.lit(-LIMIT)).cast("int")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    valid = F.col("label").isNotNull() & F.col("embedding").isNotNull() & F.forall("embedding", finite)
    return (embeddings.where(valid).select("vec_id", label.cast("int").alias("label"), F.transform("embedding", whole).alias("v"))
            .withColumn("key", F.xxhash64("label", "v")).dropDuplicates(["vec_id", "label", "v"]))


def rotation(width: int) -> np.ndarray:
    """A random orthogonal matrix, the same for the same width."""
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((width, width)))
    return q * np.sign(np.diag(r))


def width_of(dimension: int) -> int:
    return max(64, -(-dimension // 64) * 64)


def matrix(values: pa.Array, width: int) -> np.ndarray:
    """A list column as a matrix, rows filled up with zeros."""
    offsets = values.offsets.to_numpy()
    flat = values.values.to_numpy(zero_copy_only=False)
    lengths = np.diff(offsets)
    out = np.zeros((len(values), width), flat.dtype)
    out[np.repeat(np.arange(len(values)), lengths), np.arange(offsets[0], offsets[-1]) - np.repeat(offsets[:-1], lengths)] = flat[offsets[0]:offsets[-1]]
    return out


def encode(turned: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sign codes (rows, LEVELS, words), alignments (rows, LEVELS) and the last residual's length."""
    n, width = turned.shape
    rest = turned.copy()
    codes, alignments = np.empty((n, LEVELS, width // 64), np.uint64), np.empty((n, LEVELS))
    for k in range(LEVELS):
        bits = rest >= 0
        codes[:, k] = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)
        alignments[:, k] = np.abs(rest).sum(1) / np.sqrt(width)          # product with the unit code vector
        rest -= np.where(bits, 1.0, -1.0) * (alignments[:, k, None] / np.sqrt(width))
    return codes, alignments, np.linalg.norm(rest, axis=1)


def prepared(embeddings: DataFrame) -> DataFrame:
    """Participants with codes, alignments and residual, written once."""
    rows = written(participants(embeddings), "negatives-rows")
    width = width_of(rows.agg(F.max(F.size("v"))).first()[0] or 0)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = rotation(width)
        for b in batches:
            for at in range(0, b.num_rows, BATCH):
                part = pa.Table.from_batches([b.slice(at, BATCH)]).combine_chunks()
                codes, alignments, residual = encode(matrix(part["v"].chunk(0), width).astype(float) @ turn)
                n = part.num_rows
                lists = pa.array(np.arange(n + 1) * codes[0].size, pa.int32())
                levels = pa.array(np.arange(n + 1) * LEVELS, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [*[part[c].chunk(0) for c in ("vec_id", "label", "v", "key")],
                     pa.ListArray.from_arrays(lists, pa.array(codes.reshape(-1).view(np.int64))),
                     pa.ListArray.from_arrays(levels, pa.array(alignments.reshape(-1))), pa.array(residual)],
                    names=["vec_id", "label", "v", "key", "codes", "alignments", "residual"])
    return written(rows.mapInArrow(coded, PREPARED), "negatives-codes")


class Rows:
    """Vectors with their codes, as matrices."""

    def __init__(self, table: pa.Table, width: int):
        def column(name):
            return table[name].combine_chunks() if table.num_rows else table[name]
        n = table.num_rows
        ids = column("vec_id")
        self.null = np.asarray(ids.is_null())
        self.ids = np.asarray(ids.fill_null(0), np.int64)
        self.labels, self.key = np.asarray(column("label"), np.int64), np.asarray(column("key"), np.int64)
        self.v = matrix(column("v"), width).astype(np.int64)
        self.codes = matrix(column("codes"), LEVELS * width // 64).view(np.uint64).reshape(n, LEVELS, width // 64)
        self.alignments = matrix(column("alignments"), LEVELS)
        self.residual = np.asarray(column("residual"))
        self.lengths = np.sqrt((self.v.astype(float) ** 2).sum(1))

    def __len__(self) -> int:
        return len(self.ids)


class Planes:
    """Anchors turned and cut into bit planes, for popcounts."""

    def __init__(self, v: np.ndarray, turn: np.ndarray):
        turned = v.astype(float) @ turn
        self.lengths = np.linalg.norm(turned, axis=1)
        self.low = turned.min(1)
        self.step = (turned.max(1) - self.low) / (2 ** PLANES - 1)
        levels = np.rint((turned - self.low[:, None]) / np.where(self.step > 0, self.step, 1)[:, None]).astype(np.int64)
        self.bits = [np.packbits(levels >> p & 1, axis=1, bitorder="little").view(np.uint64) for p in range(PLANES)]
        kept = self.low[:, None] + self.step[:, None] * levels
        self.total, self.width = kept.sum(1), turned.shape[1]
        self.lost = np.linalg.norm(turned - kept, axis=1)     # error of a product with a unit vector, at most

    def product(self, codes: np.ndarray, anchors: slice) -> np.ndarray:
        """The products (anchors, rows) with the unit code vectors, up to ``lost``."""
        weighted = np.zeros((len(self.total[anchors]), len(codes)), np.int32)
        ones = np.zeros(len(codes), np.int64)
        for w in range(codes.shape[1]):
            ones += np.bitwise_count(codes[:, w])
            for p in range(PLANES):
                weighted += np.bitwise_count(self.bits[p][anchors, w, None] & codes[None, :, w]).astype(np.int32) << p
        inside = self.low[anchors, None] * ones + self.step[anchors, None] * weighted
        return (2 * inside - self.total[anchors, None]) / np.sqrt(self.width)


class Best:
    """The best ``places`` rows of every slot, by score and then id, over batches."""

    def __init__(self, slots: int, places: int):
        self.places = places
        self.slot, self.score = np.empty(0, np.int64), np.empty(0, np.int64)
        self.null, self.row, self.key = np.empty(0, bool), np.empty(0, np.int64), np.empty(0, np.int64)
        self.least = np.full(slots, -np.inf)       # a row below it is not among the best

    def add(self, slot: np.ndarray, score: np.ndarray, rows: Rows, at: np.ndarray) -> None:
        slot, score = np.concatenate([self.slot, slot]), np.concatenate([self.score, score])
        null, row = np.concatenate([self.null, rows.null[at]]), np.concatenate([self.row, rows.ids[at]])
        key = np.concatenate([self.key, rows.key[at]])
        order = np.lexsort((key, row, null, -score, slot))
        sorted_slot = slot[order]
        starts = np.flatnonzero(np.r_[True, sorted_slot[1:] != sorted_slot[:-1]]) if len(order) else np.empty(0, int)
        place = np.arange(len(order)) - np.repeat(starts, np.diff(np.r_[starts, len(order)]))
        keep = order[place < self.places]
        self.slot, self.score, self.null, self.row, self.key = slot[keep], score[keep], null[keep], row[keep], key[keep]
        last = order[place == self.places - 1]
        self.least[slot[last]] = score[last]


def survivors(planes: Planes, anchors: slice, rows: Rows, wanted) -> tuple[np.ndarray, np.ndarray]:
    """(anchor, row) pairs whose certain interval passes ``wanted(low, high)`` at every level."""
    estimate, alive = 0.0, None
    left = rows.lengths ** 2
    lengths, lost = planes.lengths[anchors, None], planes.lost[anchors, None]
    error = SLACK * (1 + lengths * rows.lengths)
    for k in range(LEVELS):
        product, a = planes.product(rows.codes[:, k], anchors), rows.alignments[:, k]
        estimate = estimate + a * product
        error = error + a * lost
        left = np.maximum(left - a * a, 0)
        residual = rows.residual if k == LEVELS - 1 else np.sqrt(left)
        across = np.sqrt(np.maximum(lengths ** 2 - np.maximum(np.abs(product) - lost, 0) ** 2, 0))
        reach = error + (residual + SLACK * rows.lengths) * across
        passed = wanted(estimate - reach, estimate + reach)
        alive = passed if alive is None else alive & passed
        if not alive.any():
            break
    return np.nonzero(alive)


def scores(v: np.ndarray, rows: Rows, anchor: np.ndarray, at: np.ndarray) -> np.ndarray:
    out = np.empty(len(anchor), np.int64)
    for i in range(0, len(anchor), 1 << 16):
        part = slice(i, i + (1 << 16))
        out[part] = np.einsum("ij,ij->i", v[anchor[part]], rows.v[at[part]])
    return out


def scan(codes: DataFrame, width: int, anchors: pa.Table, bands: tuple[np.ndarray, np.ndarray] | None) -> DataFrame:
    """Per task and anchor (and band) the best rows: of the same label, or with
    ``bands`` (anchor number, positive's score) of other labels within the band.

    ``place`` in the result is the number of the band (0 without bands); ``anchor``
    is the anchor's number in ``anchors``.
    """
    shared = codes.sparkSession.sparkContext.broadcast((anchors, bands))         # at most BLOCK vectors

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, bands = shared.value
        mine, turn = Rows(table, width), rotation(width)
        planes = Planes(mine.v, turn)
        # slots: one per anchor, or one per band; bands are in the order of their anchors
        owner, high = bands if bands is not None else (np.arange(len(mine)), None)
        low = None if bands is None else -(-LOW_PERCENT * high // 100)
        found = Best(len(owner), N_POSITIVES if bands is None else N_NEGATIVES)
        for b in batches:
            for at in range(0, b.num_rows, BATCH):
                rows = Rows(pa.Table.from_batches([b.slice(at, BATCH)]), width)
                for start in range(0, len(mine), TILE):
                    tile = slice(start, min(start + TILE, len(mine)))
                    same = mine.labels[tile, None] == rows.labels
                    if bands is None:
                        myself = (mine.ids[tile, None] == rows.ids) & ~rows.null & (mine.key[tile, None] == rows.key)
                        least = found.least[tile, None]
                        a, r = survivors(planes, tile, rows, lambda _, hi: same & ~myself & (hi >= least))  # noqa: B023
                        a += start
                        s = scores(mine.v, rows, a, r)
                        enough = s >= found.least[a]
                        found.add(a[enough], s[enough], rows, r[enough])
                        continue
                    slots = np.flatnonzero((owner >= tile.start) & (owner < tile.stop))
                    if not len(slots):
                        continue
                    # any band of an anchor: from its lowest useful score to its highest
                    bottom, top = np.full(len(mine), np.inf), np.full(len(mine), -np.inf)
                    np.minimum.at(bottom, owner[slots], np.maximum(low[slots], found.least[slots]))
                    np.maximum.at(top, owner[slots], high[slots])
                    a, r = survivors(planes, tile, rows, lambda lo, hi: ~same & (hi >= bottom[tile, None]) & (lo <= top[tile, None]))  # noqa: B023
                    a += start
                    s = scores(mine.v, rows, a, r)
                    first = np.searchsorted(owner, a)
                    for j in range(N_POSITIVES):                       # the j-th band of each pair's anchor
                        slot = np.minimum(first + j, len(owner) - 1)
                        inside = (owner[slot] == a) & (s >= low[slot]) & (s <= high[slot]) & (s >= found.least[slot])
                        found.add(slot[inside], s[inside], rows, r[inside])
        place = found.slot - np.searchsorted(owner, owner[found.slot])
        yield pa.RecordBatch.from_arrays(
            [pa.array(owner[found.slot], pa.int64()), pa.array(place, pa.int32()), pa.array(found.row, mask=found.null),
             pa.array(found.key), pa.array(found.score)], names=["anchor", "place", "row_id", "key", "score"])
    return codes.mapInArrow(best, FOUND)


def merged(found: DataFrame, places: int) -> DataFrame:
    """The best rows over all tasks, with ``rank`` from 1: ``places`` rows per anchor, band and task at most come in."""
    w = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), F.asc_nulls_last("row_id"), "key")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= places)


def mine(embeddings: DataFrame) -> DataFrame:
    """(anchor_id, positive_id, positive_rank, rank, negative_id, positive_score, negative_score)."""
    spark = embeddings.sparkSession
    codes = prepared(embeddings)
    width = width_of(codes.agg(F.max(F.size("v"))).first()[0] or 0)
    queries = written(range_local_index(codes.where(F.col("vec_id") % ANCHOR_STEP == 0), ["vec_id", "key"]), "negatives-anchors")
    numbered = written(attach_row_number(queries, "number"), "negatives-numbered")
    n = numbered.count()
    out = shared_path(spark, "negatives")
    schema = "anchor_id long, positive_id long, positive_rank int, rank int, negative_id long, positive_score long, negative_score long"
    spark.createDataFrame([], schema).write.parquet(f"{out}/block=-1")
    for start in range(0, n, BLOCK):
        block = numbered.where(F.col("number").between(start + 1, start + BLOCK)).orderBy("number").drop("number").toArrow()
        best = merged(scan(codes, width, block, None), N_POSITIVES).toArrow()          # at most BLOCK * N_POSITIVES rows
        best = best.sort_by([("anchor", "ascending"), ("rank", "ascending")])
        bands = (np.asarray(best["anchor"], np.int64), np.asarray(best["score"], np.int64))
        negatives = merged(scan(codes, width, block, bands), N_NEGATIVES)
        ids = block["vec_id"].to_pylist()
        positives = spark.createDataFrame(pa.table({
            "anchor": best["anchor"], "place": pa.array(np.asarray(best["rank"]) - 1, pa.int32()),
            "anchor_id": pa.array([ids[i] for i in best["anchor"].to_pylist()], pa.int64()),
            "positive_id": best["row_id"], "positive_score": best["score"]}))
        (negatives.join(F.broadcast(positives), ["anchor", "place"])
         .select("anchor_id", "positive_id", (F.col("place") + 1).alias("positive_rank"), "rank",
                 F.col("row_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
         .write.parquet(f"{out}/block={start // BLOCK}"))
    return spark.read.schema(schema + ", block long").parquet(out).drop("block")


def digest(embeddings: DataFrame) -> DataFrame:
    """The contract's columns."""
    return mine(embeddings).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


ORACLE_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
         CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) AS INT) AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same
  AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5
"""
