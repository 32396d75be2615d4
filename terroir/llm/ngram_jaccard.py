"""N-gram Jaccard self-join by vertical partitioning.

Method: equal shingle sets are one class.  The n-grams get one global
order, rarest first (frequency level, then hash).  Two sets that link must
share at least l of their first ``n - ceil(t n) + l`` n-grams in that order,
for any l up to the overlap; l is a twentieth of the set, which gives the
candidate pairs.  Their overlap is then counted vertically: the
order's hash space is cut into ``FRAGMENTS`` ranges, each pair's overlap is
counted separately per fragment, and the partial counts are summed per
pair.  The sums decide exactly.

Scale
* Frequencies: every task packs its n-grams as sorted 32-bit remainders per
  range of the hash space, so the count over the whole corpus moves 4
  bytes per n-gram; the number of ranges follows the number of n-grams.  Only
  frequent n-grams get a level of their own; the list is kept below ``MAX_HOT``
  entries by raising the threshold, which changes the order, never the result.
* Rare n-grams have fewer documents than the threshold, so all their pairs
  are few.  A frequent n-gram never yields all pairs: first its documents are
  compared with one pivot (the one with the most frequent n-grams: the
  likely original), linked ones become one component, and only pairs
  across different components are compared afterwards.  No link between
  components is lost, because every remaining candidate pair is checked.
  That is all the contract's component ids need; ``joined``, the pair join
  itself, also compares the pairs inside a component, in blocks of at most
  ``BLOCK`` documents a side, and returns every link (as many as there are).
* Each set carries a bitmap of 512 bits in which every n-gram flips one bit.
  Bits in which two bitmaps differ are n-grams that the sets do not share, so
  a pair with too many of them is ruled out exactly, before any n-gram moves.
* Only candidate documents ship their n-grams (5 bytes each); a Bloom filter of
  bounded size sorts out most others early, the join decides.

Hashes: a class is named by a 64-bit signature; overlaps compare 42 bits.

Defined results
* null or empty text, or no word: empty set, linked with nothing, its own component.
* fewer than ``size`` words: the whole sequence is the one n-gram.
* repeated rows: equal sets are one class; each row gets its result.  A null
  doc_id takes no part as the smallest id; its component is null if no other row is in its class.
* a word counts once whatever its length, also across the segments of a long text.
* empty table: empty result; extra columns pass through ``one_per_group``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terroir.llm.bytes_text import CHUNK_BYTES, LOWER_TABLE, SegmentWords, as_bytes, chunks, mixed, word_bounds, word_sums
from terroir.llm.components import connected
from terroir.llm.storage import written

SIZE = 4
PERCENT = 85
HOT = 8                           # documents from which an n-gram counts as frequent
MAX_HOT = 2_000_000               # entries of the frequent list (18 MB)
PER_RANGE = 2_000_000             # n-grams a range of the hash space holds on average
FLUSH = 1_000_000                 # n-grams a task gathers before it emits them
SLICE = 500                       # rows that become n-gram sets at once
FRAGMENTS = 4
EXTRA, EXTRA_PER = 1, 20          # l = EXTRA + n / EXTRA_PER
MAPS = [f"b{i}" for i in range(8)]   # a set's parity bitmap: 8 longs
BLOCK = 256                       # documents a side that are compared inside a component at once
STARS = ("hot", "node")           # pivots: most frequent n-grams; smallest name
FACTOR = np.uint64(0xD6E8FEB86659FD93)


def ngram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words (word hashes in, wrapped arithmetic)."""
    n = len(words) - size + 1
    h = words[:n].copy()
    for j in range(1, size):
        h = h * FACTOR + words[j:j + n]
    return mixed(h + np.uint64(size))


def ngram_sets(texts: list[bytes], size: int = SIZE) -> list[np.ndarray]:
    """Sorted distinct n-gram hashes per text."""
    out: list[np.ndarray | None] = [None] * len(texts)
    long: dict[int, SegmentWords] = {}
    for rows, first, data in chunks(texts):
        data = LOWER_TABLE[data]
        starts, ends = word_bounds(data)
        sums = word_sums(data, starts, ends)
        words = mixed(sums)
        grams = ngram_hashes(words, size) if len(words) >= size else words[:0]
        cuts = np.append(np.searchsorted(starts, first), len(starts))
        lasts = np.append(first[1:], len(data)) - 1         # a line break ends every piece
        for k, row in enumerate(rows):
            a, b = cuts[k], cuts[k + 1]
            if len(texts[row]) > CHUNK_BYTES:              # in segments: joined by words below
                long.setdefault(row, SegmentWords()).add(sums[a:b], starts[a:b], ends[a:b], first[k], lasts[k])
            elif b - a >= size:
                out[row] = np.unique(grams[a:b - size + 1])
            else:
                out[row] = ngram_hashes(words[a:b], b - a) if b > a else words[:0]
    for row, parts in long.items():
        words = parts.hashes()
        out[row] = np.unique(ngram_hashes(words, min(size, len(words)))) if len(words) else words
    return [x if x is not None else np.zeros(0, np.uint64) for x in out]


def signature(grams: np.ndarray) -> int:
    """64-bit name of a set, as a signed number."""
    total = mixed(np.array([grams.sum(dtype=np.uint64) + np.uint64(len(grams))], np.uint64))[0] if len(grams) else np.uint64(0)
    return int(total.astype(np.int64))


def least_overlap(n: int, percent: int) -> int:
    return -(-percent * n // 100)


def least_shared(nx: Column, ny: Column, percent: int) -> Column:
    """N-grams that two linked sets of these sizes share inside their prefixes, at least.

    The prefix that ends first in the global order holds every shared n-gram
    up to its end, so the overlap is at most the n-grams shared inside the
    prefixes plus what that set has behind its prefix.
    """
    def behind(n):
        return F.greatest(F.ceil(n * percent / 100) - EXTRA - F.floor(n / EXTRA_PER), F.lit(0))
    return F.ceil((nx + ny) * percent / (100 + percent)) - F.greatest(behind(nx), behind(ny))


def prefix_length(n: int, percent: int) -> int:
    return min(n, n - least_overlap(n, percent) + EXTRA + n // EXTRA_PER)


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            yield batch.slice(at, SLICE)


def parity_map(grams: np.ndarray) -> np.ndarray:
    """512 bits as 8 longs; every n-gram flips the bit of its hash."""
    odd = np.bincount((grams >> np.uint64(55)).astype(np.int64), minlength=512) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def alike(percent: int) -> Column:
    """Whether the bitmaps of x and y leave room for a link (columns nx, ny, x_b*, y_b*)."""
    differ = sum((F.bit_count(F.col(f"x_{m}").bitwiseXOR(F.col(f"y_{m}"))) for m in MAPS[1:]),
                 F.bit_count(F.col(f"x_{MAPS[0]}").bitwiseXOR(F.col(f"y_{MAPS[0]}"))))
    return differ * (100 + percent) <= (F.col("nx") + F.col("ny")) * (100 - percent)


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, text_hash, node, n, bitmap) per row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = ngram_sets(as_bytes(batch.column(1)), size)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([signature(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                 *(pa.array(c) for c in np.array([parity_map(s) for s in sets]).reshape(-1, len(MAPS)).T)],
                ["doc_id", "text_hash", "node", "n", *MAPS])
    return docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_hash")).mapInArrow(
        run, "doc_id long, text_hash long, node long, n long, " + ", ".join(f"{m} long" for m in MAPS))


def distinct_sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[int, np.ndarray]]:
    """(node, set) of a task's rows, most repeated sets once."""
    seen: set[int] = set()
    for batch in slices(batches):
        for grams in ngram_sets(as_bytes(batch.column(0)), size):
            node = signature(grams)
            if len(grams) and node not in seen:
                if len(seen) > 100_000:
                    seen.clear()
                seen.add(node)
                yield node, grams


def place(grams: np.ndarray, ranges: int) -> tuple[np.ndarray, np.ndarray]:
    """(range, 32-bit remainder) of n-gram hashes."""
    top = (grams >> np.uint64(32)) * np.uint64(ranges)
    return (top >> np.uint64(32)).astype(np.int64), ((top & np.uint64(0xFFFFFFFF)).astype(np.uint32)
                                                     ^ (grams & np.uint64(0xFFFFFFFF)).astype(np.uint32))


def keyed(grams: np.ndarray, ranges: int) -> np.ndarray:
    r, rest = place(grams, ranges)
    return (r << 32) | rest.astype(np.int64)


def packed(range_of: np.ndarray, values: list[np.ndarray]) -> Iterator[tuple[int, list[bytes]]]:
    order = np.argsort(range_of, kind="stable")
    ids, starts = np.unique(range_of[order], return_index=True)
    ends = np.append(starts[1:], len(order))
    for i, a, b in zip(ids, starts, ends, strict=True):
        yield int(i), [v[order[a:b]].tobytes() for v in values]


def frequent(docs: DataFrame, size: int, ranges: int, hot: int, max_hot: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted keys, levels) of the frequent n-grams: all from some level on, at most ``max_hot``."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush():
            r, rest = place(np.concatenate(kept), ranges)
            rows = [(i, b[0]) for i, b in packed(r, [rest])]
            return pa.RecordBatch.from_arrays([pa.array([x[0] for x in rows], pa.int32()),
                                               pa.array([x[1] for x in rows], pa.binary())], ["range", "rests"])
        kept, n = [], 0
        for _, grams in distinct_sets(batches, size):
            kept.append(grams)
            n += len(grams)
            if n >= FLUSH:
                yield flush()
                kept, n = [], 0
        if kept:
            yield flush()

    def count(table: pa.Table) -> pa.Table:
        i = table.column("range")[0].as_py()
        rests = np.concatenate([np.frombuffer(b.as_py(), np.uint32) for b in table.column("rests")])
        value, n = np.unique(rests, return_counts=True)
        value, n = value[n >= hot], n[n >= hot]
        return pa.table({"key": pa.array((i << 32) | value.astype(np.int64)),
                         "level": pa.array(np.log2(n).astype(np.int32), pa.int32())})
    found = written(docs.select("text").mapInArrow(emit, "range int, rests binary")
                    .groupBy("range").applyInArrow(count, "key long, level int"), "frequent")
    sizes = sorted(((r["level"], r["n"]) for r in found.groupBy("level").agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)
    total, lowest = 0, 64                                   # at most 64 levels
    for level, n in sizes:
        if total + n > max_hot:
            break
        total, lowest = total + n, level
    if not total:
        return np.zeros(0, np.int64), np.zeros(0, np.int8)
    rows = found.where(F.col("level") >= lowest).toPandas()      # <= max_hot rows
    order = np.argsort(rows["key"].to_numpy())
    return rows["key"].to_numpy()[order], rows["level"].to_numpy().astype(np.int8)[order]


def prefixes(docs: DataFrame, size: int, percent: int, ranges: int, keys: np.ndarray, levels: np.ndarray) -> DataFrame:
    """Prefix n-grams: rare ones packed per range (range, rests, nodes), frequent
    ones as rows (token, node, hot)."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((keys, levels))   # <= MAX_HOT entries

    names = ["range", "rests", "nodes", "token", "node", "hot"]
    kinds = [pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int32()]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        all_keys, all_levels = shared.value
        rare, often, n = [], [], 0

        def flush():
            if rare:
                key, node = (np.concatenate(c) for c in zip(*rare, strict=True))
                packs = [(i, *b) for i, b in packed(key >> 32, [(key & 0xFFFFFFFF).astype(np.uint32), node])]
                cols = list(zip(*packs, strict=True)) if packs else [[], [], []]
                yield pa.RecordBatch.from_arrays([*(pa.array(c, t) for c, t in zip(cols, kinds[:3], strict=True)),
                                                  *(pa.nulls(len(packs), t) for t in kinds[3:])], names)
            if often:
                cols = [np.concatenate(c) for c in zip(*often, strict=True)]
                yield pa.RecordBatch.from_arrays([*(pa.nulls(len(cols[0]), t) for t in kinds[:3]),
                                                  *(pa.array(c, t) for c, t in zip(cols, kinds[3:], strict=True))], names)
        for node, grams in distinct_sets(batches, size):
            key = keyed(grams, ranges)
            level = np.zeros(len(key), np.int8)
            if len(all_keys):
                at = np.minimum(np.searchsorted(all_keys, key), len(all_keys) - 1)
                found = all_keys[at] == key
                level[found] = all_levels[at[found]]
            take = np.lexsort((grams, level))[:prefix_length(len(grams), percent)]
            seldom, common = key[take[level[take] == 0]], key[take[level[take] > 0]]
            rare.append((seldom, np.full(len(seldom), node, np.int64)))
            if len(common):
                often.append((common, np.full(len(common), node, np.int64), np.full(len(common), (level > 0).sum(), np.int32)))
            n += len(take)
            if n >= FLUSH:
                yield from flush()
                rare, often, n = [], [], 0
        yield from flush()
    return written(docs.select("text").mapInArrow(
        emit, "range int, rests binary, nodes binary, token long, node long, hot int"), "prefixes")


def rare_pairs(packs: DataFrame) -> DataFrame:
    """(x, y, shared) of documents that share rare prefix n-grams: few documents have
    each, so all pairs are few; ``shared`` counts one range's n-grams."""
    def pairs(table: pa.Table) -> pa.Table:
        rests = np.concatenate([np.frombuffer(b.as_py(), np.uint32) for b in table.column("rests")])
        nodes = np.concatenate([np.frombuffer(b.as_py(), np.int64) for b in table.column("nodes")])
        order = np.lexsort((nodes, rests))
        rests, nodes = rests[order], nodes[order]
        new = np.ones(len(rests), bool)
        new[1:] = (rests[1:] != rests[:-1]) | (nodes[1:] != nodes[:-1])
        rests, nodes = rests[new], nodes[new]
        found, step = [], 1
        while step < len(rests):                            # neighbours at distance 1, 2, ... within equal n-grams
            same = np.flatnonzero(rests[step:] == rests[:-step])
            if not len(same):
                break
            found.append(np.stack([nodes[same], nodes[same + step]], 1))
            step += 1
        both = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
        both.sort(axis=1)
        both = both[np.lexsort((both[:, 1], both[:, 0]))]
        first = np.flatnonzero(np.append(True, (both[1:] != both[:-1]).any(1))) if len(both) else np.zeros(0, np.int64)
        return pa.table({"x": pa.array(both[first, 0]), "y": pa.array(both[first, 1]),
                         "shared": pa.array(np.diff(np.append(first, len(both))).astype(np.int64))})
    return packs.groupBy("range").applyInArrow(pairs, "x long, y long, shared long")


def bloom_bits(count: int) -> int:
    """Bits for ``count`` ids at 16 each, at most 2^27 (16 MB)."""
    return 1 << min(27, max(20, (16 * count).bit_length()))


def bloom_places(doc_id: Column, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(s), doc_id), F.lit(bits)).cast("long") for s in (1, 2)]


def bloom(ids: DataFrame, bits: int) -> np.ndarray:
    """The filter as 32-bit words; at most 2^22 of them reach the driver."""
    at = ids.select(F.explode(F.array(*bloom_places(F.col("doc_id"), bits))).alias("b"))
    words = at.groupBy(F.expr("b >> 5").alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(b & 31 as int)))").alias("v")).toPandas()
    out = np.zeros(bits // 32, np.uint32)
    out[words["w"].to_numpy()] = words["v"].to_numpy().astype(np.uint32)
    return out


def fragments(docs: DataFrame, size: int, wanted: DataFrame) -> DataFrame:
    """(node, doc_id, fragment, grams) of the documents ``wanted`` (doc_id) and few
    others: 5 bytes per n-gram, sorted."""
    spark = docs.sparkSession
    bits = bloom_bits(wanted.count())
    shared = spark.sparkContext.broadcast(bloom(wanted, bits))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sieve = shared.value
        for batch in slices(batches):
            inside = np.ones(batch.num_rows, bool)
            for c in (2, 3):
                at = batch.column(c).to_numpy()
                inside &= (sieve[at >> 5] >> (at & 31).astype(np.uint32)) & 1 == 1
            batch = batch.filter(pa.array(inside))
            rows = []
            for doc_id, grams in zip(batch.column(0).to_pylist(), ngram_sets(as_bytes(batch.column(1)), size), strict=True):
                part = (grams >> np.uint64(62)).astype(np.int64)
                cuts = np.searchsorted(part, np.arange(FRAGMENTS + 1))
                raw = ((grams >> np.uint64(22)) & np.uint64(0xFFFFFFFFFF)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
                node = signature(grams)
                rows += [(node, doc_id, f, raw[cuts[f]:cuts[f + 1]].tobytes()) for f in range(FRAGMENTS) if cuts[f + 1] > cuts[f]]
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.binary()), strict=True)],
                ["node", "doc_id", "fragment", "grams"])
    key = F.col("doc_id").cast("long")
    return (docs.where(F.col("doc_id").isNotNull()).select(key.alias("doc_id"), "text", *bloom_places(key, bits))
            .mapInArrow(emit, "node long, doc_id long, fragment int, grams binary"))


def unpacked(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(raw, np.uint8).reshape(-1, 5)
    return out.view("<u8")[:, 0]


def linked(pairs: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """The pairs (x, y) whose summed fragment overlaps reach the threshold."""
    out = "x long, y long, nx long, ny long, fragment int, overlap long"

    def overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column(5), batch.column(6)
            got = [len(np.intersect1d(unpacked(p.as_py()), unpacked(q.as_py()), assume_unique=True)) for p, q in zip(a, b, strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(5)), pa.array(got, pa.int64())],
                                             [c.split()[0] for c in out.split(", ")])
    left = parts.select(F.col("node").alias("x"), F.col("doc_id").alias("dx"), "fragment", F.col("grams").alias("gx"))
    right = parts.select(F.col("node").alias("y"), F.col("doc_id").alias("dy"), "fragment", F.col("grams").alias("gy"))
    both = pairs.join(left, ["x", "dx"]).join(right, ["y", "dy", "fragment"])
    partial = both.select("x", "y", "nx", "ny", "fragment", "gx", "gy").mapInArrow(overlaps, out).distinct()
    total = partial.groupBy("x", "y", "nx", "ny").agg(F.sum("overlap").alias("i"))
    return total.where(100 * F.col("i") >= percent * (F.col("nx") + F.col("ny") - F.col("i"))).select("x", "y")


def end_of(classes: DataFrame, side: str) -> DataFrame:
    """``classes`` under the column names of one side of a pair."""
    return classes.select(F.col("node").alias(side), F.col("n").alias(f"n{side}"), F.col("doc_id").alias(f"d{side}"),
                          *[F.col(m).alias(f"{side}_{m}") for m in MAPS])


def may_link(percent: int) -> Column:
    """Whether the sizes and the bitmaps of a pair allow a link."""
    return (100 * F.least("nx", "ny") >= percent * F.greatest("nx", "ny")) & alike(percent)


def sized(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs with sizes and documents, if sizes and bitmaps allow a link."""
    p = pairs.join(end_of(classes, "x"), "x").join(end_of(classes, "y"), "y")
    return p.where(may_link(percent)).drop(*[f"{s}_{m}" for s in "xy" for m in MAPS])


def enough_shared(pairs: DataFrame, tokens: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (x, y, shared) of rare n-grams that share enough for a link, even if
    all frequent n-grams of the smaller prefix were shared as well."""
    often = tokens.groupBy("node").agg(F.count(F.lit(1)).alias("h"))
    p = sized(pairs.groupBy("x", "y").agg(F.sum("shared").alias("shared")), classes, percent)
    p = (p.join(often.select(F.col("node").alias("x"), F.col("h").alias("hx")), "x", "left")
         .join(often.select(F.col("node").alias("y"), F.col("h").alias("hy")), "y", "left"))
    frequent_too = F.least(F.coalesce("hx", F.lit(0)), F.coalesce("hy", F.lit(0)))
    need = least_shared(F.col("nx"), F.col("ny"), percent)
    return p.where(F.col("shared") + frequent_too >= need).drop("shared", "hx", "hy")


def star_pairs(tokens: DataFrame, rule: str) -> DataFrame:
    """Each document of a frequent n-gram with that n-gram's pivot."""
    best = F.struct(F.col("hot") if rule == "hot" else -F.col("node"), F.col("node"))
    # written, so that the join deals both sides anew and can split a hot n-gram
    pivots = written(tokens.groupBy("token").agg(F.max(best).getField("node").alias("x")), "pivots")
    pairs = tokens.join(pivots, "token").where("x <> node")
    return pairs.select(F.least("x", "node").alias("x"), F.greatest("x", "node").alias("y")).distinct()


def components_of(classes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, component) for the nodes with links."""
    return connected(links.select(F.col("x").alias("u"), F.col("y").alias("v"))).withColumnsRenamed({"id": "node", "component": "c"})


def similar(docs: DataFrame, size: int = SIZE, percent: int = PERCENT, hot: int = HOT, max_hot: int = MAX_HOT) -> tuple[DataFrame, DataFrame]:
    """((doc_id, text_hash, node, n) per row, links (x, y) that connect every component of classes).

    The links span the components and are not all there are; ``joined`` returns all.
    """
    rows, _, _, _, links, across = compared(docs, size, percent, hot, max_hot)
    return rows, written(links.unionAll(across), "links")


def joined(docs: DataFrame, size: int = SIZE, percent: int = PERCENT, hot: int = HOT, max_hot: int = MAX_HOT) -> tuple[DataFrame, DataFrame]:
    """The pair join: ((doc_id, node, n, n_links) per row, every link (x, y) between classes).

    Rows of one class (equal sets) share their node and are linked without an
    entry of their own; ``n_links`` counts the other rows with a doc_id that a row
    is linked with, in its class and in others (null without a doc_id or a set).
    """
    rows, classes, tokens, parts, links, across = compared(docs, size, percent, hot, max_hot)
    tried = written(links.unionAll(across), "links")
    inner = inner_pairs(tokens, links, classes, percent).join(tried, ["x", "y"], "left_anti")
    every = written(tried.unionAll(linked(inner, parts, percent)), "all-links")
    of = rows.where("n > 0 and doc_id is not null").groupBy("node").agg(F.count(F.lit(1)).alias("k"))
    ends = every.unionAll(every.select(F.col("y").alias("x"), F.col("x").alias("y")))
    others = ends.join(of, F.col("y") == F.col("node")).groupBy("x").agg(F.sum("k").alias("o"))
    counts = of.join(others, F.col("x") == F.col("node"), "left").select(
        "node", (F.col("k") - 1 + F.coalesce("o", F.lit(0))).alias("n_links"))
    n_links = F.when(F.col("doc_id").isNotNull() & (F.col("n") > 0), F.col("n_links")).alias("n_links")
    return rows.join(counts, "node", "left").select("doc_id", "node", "n", n_links), every


def compared(docs: DataFrame, size: int, percent: int, hot: int, max_hot: int) -> tuple[DataFrame, ...]:
    """(rows, classes, frequent tokens, fragments, links of the first pairs, links across their components)."""
    rows = written(signatures(docs, size), "signatures")
    classes = written(rows.where("n > 0 and doc_id is not null").groupBy("node", "n", *MAPS).agg(F.min("doc_id").alias("doc_id")), "classes")
    total = classes.agg(F.sum("n")).first()[0] or 0
    ranges = max(16, -(-total // PER_RANGE))
    keys, levels = frequent(docs, size, ranges, hot, max_hot)
    found = prefixes(docs, size, percent, ranges, keys, levels)
    tokens = written(found.where(F.col("token").isNotNull()).groupBy("token", "node").agg(F.max("hot").alias("hot")), "tokens")
    # rare n-grams: every pair; frequent ones: every document with the pivots
    rare = rare_pairs(found.where(F.col("range").isNotNull()).select("range", "rests", "nodes"))
    stars = reduce(DataFrame.unionAll, [star_pairs(tokens, rule) for rule in STARS]).distinct()
    pairs = written(enough_shared(rare, tokens, classes, percent).unionByName(sized(stars, classes, percent)).distinct(), "pairs")
    ends = pairs.select(F.col("x").alias("node")).unionAll(pairs.select(F.col("y").alias("node"))).unionAll(tokens.select("node"))
    wanted = classes.join(ends.distinct(), "node").select("doc_id")
    parts = written(fragments(docs, size, wanted), "fragments")
    links = written(linked(pairs, parts, percent), "links")
    across = open_pairs(tokens, links, classes, percent).join(pairs.select("x", "y"), ["x", "y"], "left_anti")
    return rows, classes, tokens, parts, links, linked(across, parts, percent)


def open_pairs(tokens: DataFrame, links: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs that share a frequent prefix n-gram, are in different components so
    far, and share enough if all frequent n-grams of the smaller prefix agree.
    (Pairs with a rare prefix n-gram in common have been decided before.)"""
    comp = connected(links.select(F.col("x").alias("u"), F.col("y").alias("v"))).withColumnsRenamed({"id": "node", "component": "c"})
    named = tokens.join(comp, "node", "left").withColumn("c", F.coalesce("c", "node")).select("token", "node", "c")
    named = written(named, "named")
    several = written(named.groupBy("token").agg(F.min("c").alias("a"), F.max("c").alias("b")).where("a <> b").select("token"), "several")
    often = tokens.groupBy("node").agg(F.count(F.lit(1)).alias("h"))
    one = written(named.join(several, "token").join(classes, "node").join(often, "node"), "open")
    def side(s):
        return one.select("token", *[F.col(a).alias(b) for a, b in (
            ("node", s), ("c", f"c{s}"), ("n", f"n{s}"), ("doc_id", f"d{s}"), ("h", f"h{s}"))], *[F.col(m).alias(f"{s}_{m}") for m in MAPS])
    apart = ((F.col("x") < F.col("y")) & (F.col("cx") != F.col("cy")) & may_link(percent)
             & (F.least("hx", "hy") >= least_shared(F.col("nx"), F.col("ny"), percent)))
    return side("x").join(side("y"), "token").where(apart).select("x", "y", "nx", "ny", "dx", "dy").distinct()


def inner_pairs(tokens: DataFrame, links: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs inside one component of ``links`` that may link by frequent prefix n-grams.

    A component is cut into blocks, and a task's key is a pair of blocks, so no
    key holds more than about twice ``BLOCK`` documents whatever the component's size.
    """
    often = tokens.groupBy("node").agg(F.count(F.lit(1)).alias("h"))
    named = written(components_of(classes, links).join(classes, "node").join(often, "node"), "inner")
    cut = named.groupBy("c").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    # written, so that the join deals both sides anew and can split a large component
    one = written(named.join(written(cut, "blocks"), "c").withColumn("at", F.pmod(F.xxhash64("node"), "blocks").cast("int")), "inner")

    def side(s, low, high):
        return one.select("c", low.alias("low"), high.alias("high"), *[F.col(a).alias(b) for a, b in (
            ("node", s), ("n", f"n{s}"), ("doc_id", f"d{s}"), ("h", f"h{s}"))], *[F.col(m).alias(f"{s}_{m}") for m in MAPS])
    x = side("x", F.col("at"), F.explode(F.sequence("at", F.col("blocks") - 1)))
    y = side("y", F.explode(F.sequence(F.lit(0), "at")), F.col("at"))
    apart = (((F.col("low") < F.col("high")) | (F.col("x") < F.col("y"))) & may_link(percent)
             & (F.least("hx", "hy") >= least_shared(F.col("nx"), F.col("ny"), percent)))
    swap = F.col("x") > F.col("y")
    both = x.join(y, ["c", "low", "high"]).where(apart)
    return both.select(*[F.when(swap, F.col(q)).otherwise(F.col(p)).alias(p) for p, q in (("x", "y"), ("y", "x"), ("nx", "ny"), ("ny", "nx"), ("dx", "dy"), ("dy", "dx"))])


def labelled(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """(doc_id, text_hash, n, least) per row; ``least`` is the smallest (doc_id, text_hash)
    of the row's component (null without a set, or without a doc_id in its class)."""
    rows, links = similar(docs.select("doc_id", "text"), size, percent)
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "text_hash")))
    classes = rows.where("n > 0").groupBy("node").agg(first.alias("rep"))
    comp = connected(links.select(F.col("x").alias("u"), F.col("y").alias("v"))).withColumnsRenamed({"id": "node"})
    named = classes.join(comp, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("rep").alias("least"))
    labels = named.join(least, "component").select("node", "least")
    return rows.join(labels, "node", "left").select("doc_id", "text_hash", "n", "least")


def grouped(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row."""
    return labelled(docs, size, percent).select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("least.doc_id", "doc_id").alias("component_id"))


def one_per_group(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """One document of each group of linked documents (columns unchanged): the smallest
    doc_id, of its texts in the group the one with the smallest hash, and of
    repeated rows (same doc_id and text) the one that comes first as JSON.

    Rows with a null doc_id or without a set all stay.
    """
    rows = written(labelled(docs, size, percent).where("n > 0 and doc_id is not null"), "labelled")
    stays = F.struct("doc_id", "text_hash") == F.col("least")
    key = [F.col("doc_id").alias("__gone"), F.col("text_hash").alias("__gone_hash")]
    gone = rows.where(~stays).select(*key).distinct()
    again = written(rows.where(stays).groupBy(*key).count().where("count > 1").drop("count"), "repeated")
    hashed = docs.withColumn("__text_hash", F.xxhash64("text"))
    same = (F.col("doc_id").cast("long") == F.col("__gone")) & (F.col("__text_hash") == F.col("__gone_hash"))
    kept = hashed.join(gone.unionAll(again), same, "left_anti").select(*docs.columns)
    whole = F.struct(*[F.col(c) for c in docs.columns])
    once = (hashed.join(again, same, "left_semi").groupBy("doc_id", "__text_hash")
            .agg(F.min_by(whole, F.to_json(whole)).alias("__row")).select("__row.*"))
    return kept.unionAll(once)


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns."""
    return grouped(docs)


ORACLE_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 4 THEN array_to_string(w, ' ')
                          ELSE array_to_string(list_slice(w, i, i + 3), ' ') END AS g
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 3, 1))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id),
link AS (
  SELECT x, y FROM p JOIN n nx ON x = nx.doc_id JOIN n ny ON y = ny.doc_id
  WHERE 100 * i >= 85 * (nx.n + ny.n - i)),
reach(doc_id, c) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT l.y, r.c FROM reach r JOIN link l ON l.x = r.doc_id)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, r.c AS component_id
FROM documents d LEFT JOIN n ON d.doc_id = n.doc_id
JOIN (SELECT doc_id, min(c) AS c FROM reach GROUP BY doc_id) r ON d.doc_id = r.doc_id
"""
