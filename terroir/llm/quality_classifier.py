"""Quality classifier: supervised subword embeddings.

Method: a document's features are its words, its word pairs and the byte 3- and
4-grams inside its words, hashed into ``BUCKETS`` vectors per kind.  The vectors are
averaged per document and a softmax layer on the average gives the label;
vectors and layer are trained together by numpy stochastic gradient descent on
a bounded sample of labelled rows (``MAX_TRAIN`` documents, the smallest by
a hash of doc_id; their whole texts count).

Scoring is linear in the average, so each bucket's vector folds into one
number.  These are kept as fixed-point integers: a document's sum is exact and
does not depend on batches.  Every whole text is scored in one Arrow pass
without a shuffle; a very long text is scored in segments that end at white
space (a single word beyond the segment size counts in pieces).

Only the text is an input.  Labels are read only from rows outside the
held-out fold, and null labels are left out.

Defined results
* null or empty text: no features, the score is the softmax of the bias.
* repeated rows are scored alike; a doc_id with several labels trains on each.
* no labelled row, or an empty labels table: every score is 0.5.
* empty documents table: empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terroir.llm.bytes_text import as_bytes, chunks, mixed, word_bounds, word_hashes

BUCKETS = 1 << 16
GRAMS = (3, 4)
KINDS = 2 + len(GRAMS)            # words, n-grams of each size, word pairs
MAX_TRAIN = 4000
DIM, EPOCHS, RATE, SEED = 16, 8, 0.4, 7
FIXED = 1 << 24
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.7


def features(first: np.ndarray, data: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(byte position, bucket) of the words and word pairs, then of the n-grams of each size.

    ``first``: where each text begins.  A pair is hashed by the difference of its
    words' hashes, so all pairs of equal words share one bucket.
    """
    starts, ends = word_bounds(data)
    words = word_hashes(data, starts, ends)
    yield starts, (words >> np.uint64(48)).astype(np.int64)
    second = np.ones(len(words), dtype=bool)
    second[np.searchsorted(starts, first[first <= starts[-1]] if len(starts) else first[:0])] = False
    pairs = np.flatnonzero(second)
    yield starts[pairs], (mixed(words[pairs] - words[pairs - 1]) >> np.uint64(48)).astype(np.int64) + (KINDS - 1) * BUCKETS
    lengths = ends - starts
    room = np.zeros(len(data) + 1, dtype=np.int32)            # bytes from a position to its word's end
    room[starts] = lengths
    room[ends] -= lengths
    inside = np.cumsum(room[:-1])                             # the word's length, at each of its bytes
    begin = np.zeros(len(data), dtype=np.int64)
    begin[starts] = starts
    left = inside - (np.arange(len(data)) - np.maximum.accumulate(begin))
    wide = data.astype(np.uint32)
    for k, n in enumerate(GRAMS):
        at = np.flatnonzero((left >= n) & (inside > 0))
        code = wide[at].copy()
        for j in range(1, n):
            code |= wide[at + j] << np.uint32(8 * j)
        bucket = ((code * np.uint32(0x9E3779B1)) ^ (code >> np.uint32(15))) * np.uint32(0x85EBCA77) >> np.uint32(16)
        yield at, bucket.astype(np.int64) + (k + 1) * BUCKETS


def bags(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(distinct buckets, counts) per text."""
    parts: list[list[np.ndarray]] = [[] for _ in texts]
    for rows, first, data in chunks(texts):
        for at, bucket in features(first, data):
            cuts = np.searchsorted(at, first[1:])
            for row, part in zip(rows, np.split(bucket, cuts), strict=True):
                parts[row].append(part)
    return [np.unique(np.concatenate(p), return_counts=True) if p else (np.zeros(0, np.int64),) * 2 for p in parts]


def held_out(doc_id: Column | None = None) -> Column:
    c = F.col("doc_id") if doc_id is None else doc_id
    return F.coalesce(F.crc32(c.cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def training_bags(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """Bags and labels of the sample; features are made in the tasks, at most
    ``max_train`` documents reach the driver.

    A repeated row counts once, whatever the number of its copies; of a doc_id with several
    texts each counts, and the sample is cut again after they are known."""
    known = (labels.where(F.col("quality").isNotNull() & ~held_out())
             .select("doc_id", F.col("quality").cast("int").alias("quality"))
             .withColumn("__h", F.xxhash64(F.lit(SEED), "doc_id"))
             .orderBy("__h", "doc_id", "quality").limit(max_train))
    once = ["doc_id", "__th", "quality"]

    def hashed(found: DataFrame) -> DataFrame:
        return found.withColumn("__th", F.xxhash64("text"))
    texts = docs.select("doc_id", "text")
    keys = (hashed(texts.join(F.broadcast(known), "doc_id")).select(*once, "__h").distinct()     # known: <= max_train rows
            .orderBy("__h", *once).limit(max_train).drop("__h"))
    wanted = F.broadcast(keys.select("doc_id").distinct())                                       # <= max_train rows
    sample = hashed(texts.join(wanted, "doc_id", "left_semi")).join(F.broadcast(keys), ["doc_id", "__th"]).dropDuplicates(once)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = bags(as_bytes(batch.column(1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2),
                 pa.array([i.astype("<i4").tobytes() for i, _ in found], pa.binary()),
                 pa.array([c.astype("<i4").tobytes() for _, c in found], pa.binary())],
                ["doc_id", "quality", "ids", "counts"])
    rows = (sample.select("doc_id", "text", "quality")
            .mapInArrow(extract, "doc_id long, quality int, ids binary, counts binary").collect())
    rows.sort(key=lambda r: (r["doc_id"], r["quality"], r["ids"]))
    return [(np.frombuffer(r["ids"], "<i4"), np.frombuffer(r["counts"], "<i4"), r["quality"]) for r in rows]


def train(sample: list[tuple[np.ndarray, np.ndarray, int]], dim: int = DIM, epochs: int = EPOCHS,
          rate: float = RATE, seed: int = SEED) -> tuple[np.ndarray, float]:
    """SGD over the sample; returns (weight per bucket, bias) of the folded model."""
    if len({y for _, _, y in sample}) < 2:
        return np.zeros(KINDS * BUCKETS), 0.0
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dim, 1 / dim, (KINDS * BUCKETS, dim)).astype(np.float32)
    layer, bias = np.zeros((dim, 2), np.float32), np.zeros(2, np.float32)
    steps, done = epochs * len(sample), 0
    for _ in range(epochs):
        for k in rng.permutation(len(sample)):
            ids, counts, label = sample[k]
            lr = rate * (1 - done / steps)
            done += 1
            share = (counts / max(1, counts.sum())).astype(np.float32)
            mean = share @ vectors[ids]
            z = mean @ layer + bias
            p = np.exp(z - z.max())
            grad = p / p.sum()
            grad[label] -= 1
            back = layer @ grad
            layer -= lr * np.outer(mean, grad)
            bias -= lr * grad
            # the average divides a vector's gradient by the text's length; as is usual, it is not divided again
            vectors[ids] -= (lr * np.minimum(1, share * 100))[:, None] * back
    apart = layer[:, 1] - layer[:, 0]
    return (vectors @ apart).astype(np.float64), float(bias[1] - bias[0])


def score(docs: DataFrame, model: tuple[np.ndarray, float]) -> DataFrame:
    """(doc_id, score): the probability of label 1 per row."""
    weights, bias = np.round(model[0] * FIXED).astype(np.int64), model[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = as_bytes(batch.column(1))
            total, count = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
            for rows, first, data in chunks(texts):
                for at, bucket in features(first, data):
                    ends = np.append(np.searchsorted(at, first[1:]), len(at))
                    sums = np.concatenate([[0], np.cumsum(weights[bucket])])[ends]
                    np.add.at(total, rows, np.diff(sums, prepend=0))
                    np.add.at(count, rows, np.diff(ends, prepend=0))
            z = total / (FIXED * np.maximum(count, 1)) + bias
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-z)))], ["doc_id", "score"])
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double")


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's columns."""
    out = score(docs, train(training_bags(docs, labels)))
    return out.select("doc_id", held_out().alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
