"""Mixing sources to target weights.

Method: the words of every source, document after document, are one long run
that is cut into blocks of ``BLOCK_WORDS`` words (the last one may be shorter).
A source's target is its share by weight, but at most ``MAX_EPOCHS`` times its
size.  The mix has as many slots as the targets need blocks, ``SHARD_SLOTS`` to
an output shard.  Each shard draws its source counts from a multinomial
with the targets as probabilities.  A source's draws are numbered over all
shards; those beyond its target (a source drawn too often) go, in order, to the
sources drawn too rarely, so every source gets exactly the slots it needs.
Its slot ``j`` shows block ``p(j mod n)``, where ``p`` is a pseudorandom
permutation of its ``n`` blocks, another one for each epoch ``j // n``; slots and
blocks are joined by that index.  The last slot of a source is cut to the word
at which its target is reached, so no word is taken more than ``MAX_EPOCHS`` times.

Scale: documents are ranged by (source, doc_id, text hash), and running sums are
made per task with one offset per (task, source), so a source with a third of
all rows spans many tasks.  Targets need exact integer sums over the sources
only.  Draws are seeded by shard and are independent of each other; their
probabilities are brought to the tasks in chunks of at most ``CHUNK`` sources,
each chunk's total being drawn first.  Blocks and slots are joined on (source,
block), and no block has more than ``BLOCK_WORDS`` pieces or ``MAX_EPOCHS`` slots.
Texts travel only in ``mixed``, not for the counts.

Defined results
* null, empty or blank text: size 0, no piece, taken 0.
* null source: a source of its own, ordered last; the empty string is another.
* repeated rows: each is a document with words of its own; rows equal in
  source, doc_id and text are interchangeable.  Null doc_ids come first.
* a source without words: source_size 0, target 0.0.  A corpus without words:
  all targets 0.0 and nothing taken.
* very long texts become many pieces; empty table: empty result.
* extra columns are not read; the result has the contract's columns.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terroir.llm.storage import shared_path, written
from terroir.llm.text import SPACED_WORD, text_or_empty, words
from terroir.operators.ids import attach_row_number, range_local_index

WEIGHTS = (5, 2, 1)
SHARE_PERCENT = 150
MAX_EPOCHS = 2
BLOCK_WORDS = 128
SHARD_SLOTS = 4096
CHUNK = 1 << 20                   # sources whose probabilities a task holds at a time
SEED = 13
ROUNDS = 4


def running(df: DataFrame, keys: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """``name``: the sum of ``value`` over the earlier rows with the same ``keys``, by ``order``.

    ``value`` must not be null.  Ranged by (keys, order) and written; each task adds
    up its own rows in order, and the totals of the tasks before follow from one
    row per (task, key), so a key may span any number of tasks.
    """
    ranged = written(range_local_index(df, [*keys, *order]).drop("_local"), "mix-ranged")
    here = Window.partitionBy("_pid", *keys)
    totals = ranged.groupBy("_pid", *keys).agg(F.sum(value).alias("__sum"))
    before = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1) if keys else (
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))                   # one row per task
    starts = totals.select("_pid", *keys, F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__start"))
    local = F.coalesce(F.sum(value).over(here.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    same = [F.col("r._pid") == F.col("s._pid"), *[F.col(f"r.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys]]
    summed = ranged.withColumn("__local", local)
    return (summed.alias("r").join(starts.alias("s"), same)
            .select(*[F.col(f"r.{c}") for c in df.columns], (F.col("r.__local") + F.col("s.__start")).cast("long").alias(name)))


def measured(docs: DataFrame) -> DataFrame:
    """(row, doc_id, source, size, th), written; ``row`` names the document."""
    t = text_or_empty("text")
    rows = written(docs.select("doc_id", "source", F.size(words(t, SPACED_WORD)).cast("long").alias("size"),
                               F.xxhash64(t).alias("th")), "mix-rows")
    return rows.withColumn("row", F.monotonically_increasing_id())


def targets(rows: DataFrame) -> DataFrame:
    """(source, number, weight, source_size, target, n_blocks, last_words, need), written.

    ``need`` is the target as whole words.  Sources above their bound are held there and
    the rest is shared anew by weight until none is above; every round is one aggregate
    with exact integer sums, and holds at least one source more.
    """
    sizes = written(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sizes")
    ranged = written(range_local_index(sizes, [F.asc_nulls_last("source")]), "mix-sources")
    cycle = F.array(*[F.lit(w) for w in WEIGHTS])
    numbered = written(attach_row_number(ranged, "number").withColumn(
        "weight", F.element_at(cycle, ((F.col("number") - 1) % len(WEIGHTS) + 1).cast("int"))), "mix-weights")
    total = numbered.agg(F.sum("source_size")).first()[0] or 0
    bound, held, level = MAX_EPOCHS * F.col("source_size"), F.lit(False), 0.0
    while total:
        left = numbered.where(~held).agg(F.sum("weight")).first()[0]
        kept = numbered.where(held).agg(F.sum(bound)).first()[0] or 0
        if not left:
            break
        share, parts = SHARE_PERCENT * total - 100 * kept, 100 * left          # words per weight, as a fraction
        level = share / parts
        above = held | (bound < F.col("weight") * F.lit(level))
        if numbered.where(above & ~held).isEmpty():
            break
        held = above
    target = F.when(held, bound.cast("double")).otherwise(F.least(bound.cast("double"), F.col("weight") * F.lit(level)))
    need = F.round(target).cast("long")
    return written(numbered.withColumn("target", target).withColumn("need", need)
                   .withColumn("n_blocks", F.ceil(F.col("source_size") / BLOCK_WORDS).cast("long"))
                   .withColumn("last_words", F.col("source_size") - BLOCK_WORDS * F.greatest(F.col("n_blocks") - 1, F.lit(0))), "mix-targets")


def mixed_bits(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (shifts and odd multipliers)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permuted(index: np.ndarray, n: np.ndarray, key: np.ndarray, inverse: bool = False) -> np.ndarray:
    """``index`` (0 to n-1) under the permutation of 0 to n-1 that ``key`` names, or under its inverse.

    A Feistel network over the next even power of two, applied again while a value
    lies outside (fewer than four times on average).
    """
    half = np.maximum(1, np.ceil(np.log2(np.maximum(n, 2)) / 2)).astype(np.uint64)
    low = (np.uint64(1) << half) - np.uint64(1)
    out, todo = index.astype(np.uint64), np.arange(len(index))
    while len(todo):
        h, m, k = half[todo], low[todo], key[todo].astype(np.uint64)
        a, b = out[todo] >> h, out[todo] & m
        for r in reversed(range(ROUNDS)) if inverse else range(ROUNDS):
            turn = mixed_bits((a if inverse else b) + mixed_bits(k + np.uint64(r + 1))) & m
            a, b = (b ^ turn, a) if inverse else (b, a ^ turn)
        out[todo] = a << h | b
        todo = todo[out[todo] >= n[todo].astype(np.uint64)]
    return out.astype(np.int64)


def permutation_key(number: np.ndarray, epoch: np.ndarray) -> np.ndarray:
    return mixed_bits(mixed_bits(number.astype(np.uint64) + np.uint64(SEED << 32)) + epoch.astype(np.uint64))


def slot_counts(sources: DataFrame) -> DataFrame:
    """(number, ..., slots, cut): slots that a source needs, and words to leave out of its last one.

    All blocks but the last have equal lengths, so the words of the first j slots follow
    from the short block's place in its epoch's permutation.
    """
    schema = sources.schema.simpleString()[len("struct<"):-1]

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            number, need, n, size, last = (np.asarray(b[c], np.int64) for c in ("number", "need", "n_blocks", "source_size", "last_words"))
            epoch = np.where(size > 0, need // np.maximum(size, 1), 0)
            rest = need - epoch * size                                    # words of the last, partial epoch
            slots = -(-rest // BLOCK_WORDS)
            place = permuted(np.maximum(n - 1, 0), np.maximum(n, 1), permutation_key(number, epoch), inverse=True)
            shown = slots * BLOCK_WORDS - np.where(place < slots, BLOCK_WORDS - last, 0)
            more = shown < rest                                           # the short block is among them and costs a slot more
            slots, shown = slots + more, shown + np.where(more, BLOCK_WORDS, 0)
            out = {c: b[c] for c in b.schema.names}
            out["slots"], out["cut"] = pa.array(epoch * n + slots), pa.array(shown - rest)
            yield pa.RecordBatch.from_pydict(out)
    return sources.mapInArrow(counted, schema + ", slots long, cut long")


def drawn(sources: DataFrame, n_slots: int) -> DataFrame:
    """(number, shard, n): multinomial source counts per output shard, written."""
    spark = sources.sparkSession
    n_shards = -(-n_slots // SHARD_SLOTS)
    chunk = F.floor((F.col("number") - 1) / CHUNK)
    sums = {r["c"]: r["s"] for r in sources.groupBy(chunk.alias("c")).agg(F.sum("slots").alias("s")).collect()}   # one per CHUNK sources
    chunks = sorted(c for c, s in sums.items() if s)
    chances = np.array([sums[c] for c in chunks], float) / n_slots
    out = shared_path(spark, "mix-draws")
    for i, c in enumerate(chunks):
        part = sources.where((chunk == c) & (F.col("slots") > 0)).select("number", "slots").orderBy("number").toArrow()   # at most CHUNK
        shared = spark.sparkContext.broadcast((np.asarray(part["number"], np.int64), np.asarray(part["slots"], float) / sums[c]))

        def draw(batches: Iterator[pa.RecordBatch], i: int = i, shared=shared) -> Iterator[pa.RecordBatch]:
            numbers, p = shared.value
            for b in batches:
                for shard in b["id"].to_pylist():
                    n = min(SHARD_SLOTS, n_slots - shard * SHARD_SLOTS)
                    of_chunks = np.random.default_rng([SEED, shard]).multinomial(n, chances)
                    counts = np.random.default_rng([SEED, shard, i + 1]).multinomial(of_chunks[i], p)
                    some = np.flatnonzero(counts)
                    yield pa.RecordBatch.from_arrays([pa.array(numbers[some]), pa.array(np.full(len(some), shard)), pa.array(counts[some])],
                                                     names=["number", "shard", "n"])
        spark.range(n_shards).mapInArrow(draw, "number long, shard long, n long").write.parquet(f"{out}/chunk={c}")
    return spark.read.schema("number long, shard long, n long").parquet(*[f"{out}/chunk={c}" for c in chunks])


def slots(sources: DataFrame) -> DataFrame:
    """(shard, number, j, epoch, block, n_words): what every slot of the mix shows, written.

    ``sources`` as ``slot_counts`` returns it.
    """
    spark = sources.sparkSession
    n_slots = sources.agg(F.sum("slots")).first()[0] or 0
    if not n_slots:
        return spark.createDataFrame([], "shard long, number long, j long, epoch long, block long, n_words long")
    counted = running(drawn(sources, n_slots), ["number"], ["shard"], "n", "start")
    known = counted.join(sources.select("number", "slots"), "number")
    kept = F.least(F.col("n"), F.greatest(F.col("slots") - F.col("start"), F.lit(0)))
    known = written(known.withColumn("kept", kept), "mix-kept")
    # slots drawn beyond a source's need, and needs that no draw met, are as many; they pair up in order
    over = running(known.where("kept < n").select("number", "shard", (F.col("n") - F.col("kept")).alias("extra")),
                   [], ["number", "shard"], "extra", "u").select("shard", F.explode(F.expr("sequence(u, u + extra - 1)")).alias("u"))
    met = known.groupBy("number").agg(F.sum("kept").alias("met"))
    lacking = (sources.join(met, "number", "left").withColumn("met", F.coalesce("met", F.lit(0)))
               .select("number", "met", (F.col("slots") - F.col("met")).alias("lack")).where("lack > 0"))
    under = (running(lacking, [], ["number"], "lack", "u")
             .select("number", F.inline(F.expr("transform(sequence(0L, lack - 1), i -> struct(u + i AS u, met + i AS j))"))))
    moved = over.join(under, "u").select("shard", "number", "j")
    stayed = known.where("kept > 0").select("shard", "number", F.explode(F.expr("sequence(start, start + kept - 1)")).alias("j"))
    facts = sources.select("number", "n_blocks", "last_words", F.col("slots").alias("n_slots"), "cut")
    placed = stayed.unionByName(moved).join(facts, "number")

    def shown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            number, j, n, last, n_slots, cut = (np.asarray(b[c], np.int64) for c in ("number", "j", "n_blocks", "last_words", "n_slots", "cut"))
            epoch = j // np.maximum(n, 1)
            block = permuted(j % np.maximum(n, 1), n, permutation_key(number, epoch))
            length = np.where(block == n - 1, last, BLOCK_WORDS) - np.where(j == n_slots - 1, cut, 0)
            yield pa.RecordBatch.from_arrays([b["shard"], b["number"], b["j"], pa.array(epoch), pa.array(block), pa.array(length)],
                                             names=["shard", "number", "j", "epoch", "block", "n_words"])
    return written(placed.mapInArrow(shown, "shard long, number long, j long, epoch long, block long, n_words long"), "mix-slots")


def pieces(placed: DataFrame) -> DataFrame:
    """(number, block, row, at, first, n): the part of a document in each block of its source.

    ``placed`` has (row, number, start, size); ``at`` is the piece's place in the block, ``first`` its first word.
    """
    return (placed.where("size > 0")
            .withColumn("block", F.explode(F.expr(f"sequence(start div {BLOCK_WORDS}, (start + size - 1) div {BLOCK_WORDS})")))
            .withColumn("from", F.greatest(F.col("start"), F.col("block") * BLOCK_WORDS))
            .withColumn("n", F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * BLOCK_WORDS) - F.col("from"))
            .withColumn("at", F.col("from") - F.col("block") * BLOCK_WORDS).withColumn("first", F.col("from") - F.col("start"))
            .drop("from", "start"))


def planned(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents with their place in their source, the sources, and the slots of the mix."""
    rows = measured(docs)
    sources = written(slot_counts(targets(rows)), "mix-slot-counts")
    ordered = running(rows, ["source"], ["doc_id", "th", "row"], "size", "start")
    number = F.col("d.source").eqNullSafe(F.col("s.source"))
    placed = written(ordered.alias("d").join(sources.select("source", "number").alias("s"), number).select("d.*", "s.number"), "mix-placed")
    return placed, sources, slots(sources)


def shown_words(at: Column, n: Column, length: Column) -> Column:
    """Words of a piece inside a slot that shows the block's first ``length`` words (null: no slot)."""
    return F.greatest(F.lit(0), F.least(n, F.coalesce(length, F.lit(0)) - at))


def mixed(docs: DataFrame) -> DataFrame:
    """The mix itself: (shard, position, source, block, epoch, n_words, text), texts of words with one blank between.

    ``position`` shuffles the slots inside each shard.
    """
    placed, sources, mix = planned(docs)
    t = text_or_empty("text")
    by_text = docs.select("doc_id", "source", F.xxhash64(t).alias("th"), words(t, SPACED_WORD).alias("w")).dropDuplicates(["doc_id", "source", "th"])
    texts = by_text.alias("t").join(placed.alias("p"), [F.col(f"t.{c}").eqNullSafe(F.col(f"p.{c}")) for c in ("doc_id", "source", "th")]).select("p.*", "t.w")
    # a block has at most BLOCK_WORDS pieces
    blocks = (pieces(texts).select("number", "block", F.struct("at", F.expr("slice(w, int(first) + 1, int(n))").alias("w")).alias("p"))
              .groupBy("number", "block").agg(F.flatten(F.transform(F.array_sort(F.collect_list("p")), lambda p: p["w"])).alias("w")))
    order = Window.partitionBy("shard").orderBy(F.xxhash64(F.lit(SEED), "number", "j"), "number", "j")     # SHARD_SLOTS rows
    return (mix.withColumn("position", F.row_number().over(order) - 1).join(blocks, ["number", "block"])
            .join(sources.select("number", "source"), "number")
            .select("shard", "position", "source", "block", "epoch", "n_words",
                    F.array_join(F.expr("slice(w, 1, int(n_words))"), " ").alias("text")))


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns."""
    placed, sources, mix = planned(docs)
    shown = pieces(placed).join(mix.select("number", "block", "n_words"), ["number", "block"], "left")
    taken = shown.groupBy("row", "doc_id", "size", "number").agg(
        F.sum(shown_words(F.col("at"), F.col("n"), F.col("n_words"))).cast("long").alias("taken"))
    empty = placed.where("size = 0").select("row", "doc_id", "size", "number", F.lit(0).cast("long").alias("taken"))
    facts = sources.select("number", "source_size", "target")
    return taken.unionByName(empty).join(facts, "number").select("doc_id", "size", "source_size", "target", "taken")
