"""Benchmark decontamination by a broadcast set of test n-grams.

Method: every item's windows (13 consecutive normalised words; a shorter item
is one window) are keyed by the hash of their leading words.  That set is
broadcast behind a check of its rows and bytes; a larger benchmark is scanned in
several blocks of the allowed size.  A window of more than ``MAX_WINDOW_BYTES``
is held as the SHA-256 of its words, and one of more than ``MAX_ITEMS`` items as
several rows, so no row outgrows a block.  Each document's words are scanned once per
block: the hash of the leading words at every position probes the set, and a
hit is verified word by word against the whole window, inside the join.  Only
verified hits and one row per document leave the scan, so a passage that many
documents share costs no shuffle of its own.  Hits give word spans, and
spans or whole documents are removed.

Defined results
* null or empty text, or no word: no hit, not contaminated.
* items without words have no window; equal windows of several items are one
  window that counts for each of them; a null item_id still hits but is not
  counted.  Empty benchmark: nothing is hit.
* repeated document rows: one result row each.
* very long texts: all words of a row are held at once, as one array, and every window of them is probed.
* empty documents table: empty result.
* extra columns pass through ``remove``; internal columns start with ``__``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terroir.llm.storage import written
from terroir.llm.text import ALNUM_WORD, ascii_lower, let, text_or_empty, words

N = 13
LEAD = 4
SHARE = 20                        # contaminated: SHARE * n_hit >= n_words
MAX_BROADCAST_WINDOWS = 200_000
MAX_BROADCAST_BYTES = 64 << 20
MAX_WINDOW_BYTES = 1024
MAX_ITEMS = 1000                  # of one window, in one row
# The contract's word class before lower-casing.
ANY_CASE_WORD = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"


def normalised_words(text: Column) -> Column:
    return words(ascii_lower(text_or_empty(text)), ALNUM_WORD)


def lead_hash(w: Column, i: Column | int, g: int) -> Column:
    """Hash of the ``g`` words from position ``i`` (missing ones are skipped)."""
    return F.xxhash64(*[F.get(w, F.lit(i) + j if isinstance(i, int) else i + j) for j in range(g)])


def joined(w: Column) -> Column:
    """The words as one string (no word holds a blank)."""
    return F.array_join(w, " ")


def item_windows(benchmark: DataFrame, n: int = N) -> DataFrame:
    """One row per distinct window and ``MAX_ITEMS`` of its items: __window words (null: too long) or __sha of them,
    __k words, __g lead length, __head hash, __items ids, __bytes in memory, __part a hash to cut blocks by."""
    w = F.col("__w")
    items = (benchmark.select("item_id", normalised_words(F.col("text")).alias("__w"))
             .where(F.size("__w") > 0).withColumn("__k", F.least(F.size("__w"), F.lit(n))))
    cut = items.select("item_id", "__k", F.explode(F.transform(
        F.sequence(F.lit(1), F.size(w) - F.col("__k") + 1), lambda i: F.slice(w, i, F.col("__k")))).alias("__window"))
    one = cut.groupBy("__window").agg(F.first("__k").alias("__k"), F.collect_set("item_id").alias("__items"))
    head = F.coalesce(*[F.when(F.col("__k") == g, lead_hash(F.col("__window"), 0, g)) for g in range(1, LEAD)],
                      lead_hash(F.col("__window"), 0, LEAD))
    n_parts = F.greatest(F.ceil(F.size("__items") / MAX_ITEMS), F.lit(1)).cast("int")
    one = one.withColumns({"__g": F.least(F.col("__k"), F.lit(LEAD)), "__head": head}).select(
        "*", F.explode(F.sequence(F.lit(0), n_parts - 1)).alias("__n"))
    long = F.octet_length(joined(F.col("__window"))) > MAX_WINDOW_BYTES
    one = one.withColumns({
        "__items": F.slice("__items", F.col("__n") * MAX_ITEMS + 1, MAX_ITEMS),
        "__part": F.xxhash64("__window", "__n"),
        "__sha": F.when(long, F.sha2(joined(F.col("__window")), 256)),
        "__window": F.when(~long, F.col("__window"))}).drop("__n")
    text = [F.coalesce(F.octet_length(joined(F.col(c).cast("array<string>"))), F.lit(0)) + 16 * F.greatest(F.size(c), F.lit(0))
            for c in ("__window", "__items")]
    return one.withColumn("__bytes", (text[0] + text[1] + 128).cast("long"))


def scan(docs: DataFrame, windows: DataFrame, leads: list[int]) -> DataFrame:
    """Verified hits (doc_id, __th, __row, n_words, __pos, __k, __items), and per
    document one row without a hit."""
    rows = docs.select("doc_id", F.xxhash64("text").alias("__th"), F.monotonically_increasing_id().alias("__row"),
                       normalised_words(F.col("text")).alias("__w"))

    def heads(w):
        at = F.when(F.size(w) > 0, F.sequence(F.lit(0), F.size(w) - 1)).otherwise(F.array().cast("array<int>"))
        def of_length(g):
            return F.transform(at, lambda i: lead_hash(w, i, g))
        parts = [of_length(g) for g in leads]
        return F.concat(*parts, F.array(F.lit(0).cast("long")))     # the last entry stands for the document
    n = F.size("__w")
    rows = rows.withColumn("__heads", let(F.col("__w"), heads)).withColumn("n_words", n.cast("long"))
    probes = rows.select("doc_id", "__th", "__row", "n_words", "__w", F.posexplode("__heads").alias("__at", "__h"))
    last = F.col("__at") == F.col("n_words") * len(leads)
    lead = F.element_at(F.array(*[F.lit(g) for g in [*leads, 0]]),
                        F.when(last, len(leads)).otherwise(F.expr("__at div n_words")).cast("int") + 1)
    probes = probes.withColumns({"__last": last, "__lead": lead,
                                 "__pos": F.when(last, F.lit(-1)).otherwise(F.expr("__at % n_words")).cast("int")})
    found = F.slice("__w", F.greatest(F.col("__pos"), F.lit(0)) + 1, F.col("__k"))
    same = F.coalesce(found == F.col("__window"), F.sha2(joined(found), 256) == F.col("__sha"))
    hit = (F.col("__h") == F.col("__head")) & (F.col("__lead") == F.col("__g")) & same
    block = windows.select("__head", "__g", "__k", "__window", "__sha", "__items")
    return (probes.join(F.broadcast(block), hit, "left")            # about MAX_BROADCAST_BYTES at most
            .where(F.col("__last") | F.col("__head").isNotNull())
            .select("doc_id", "__th", "__row", "n_words", "__pos", "__k", "__items"))


def covered(spans: Column) -> Column:
    """Positions covered by spans (pos, k) sorted by pos."""
    start = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("total"))

    def step(a, s):
        end = (s["pos"] + s["k"]).cast("long")
        new = F.greatest(end - F.greatest(a["end"], s["pos"].cast("long")), F.lit(0).cast("long"))
        return F.struct(F.greatest(a["end"], end).alias("end"), (a["total"] + new).alias("total"))
    return F.aggregate(spans, start, step, lambda a: a["total"])


def hits(docs: DataFrame, benchmark: DataFrame, n: int = N, max_windows: int = MAX_BROADCAST_WINDOWS,
         max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Per document row: doc_id, __th, n_words, spans (pos, k sorted), items (sorted id strings), n_hit."""
    windows = written(item_windows(benchmark, n), "windows")
    size = windows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("__bytes"), F.lit(0)).alias("bytes"),
                       F.sort_array(F.collect_set("__g")).alias("g")).first()
    blocks = max(1, -(-size["n"] // max_windows), -(-size["bytes"] // max_bytes))
    leads = size["g"] or [LEAD]
    found = None
    for b in range(blocks):
        part = windows if blocks == 1 else windows.where(F.pmod(F.col("__part"), F.lit(blocks)) == b)
        found = scan(docs, part, leads) if found is None else found.unionAll(scan(docs, part, leads))
    span = F.when(F.col("__pos") >= 0, F.struct(F.col("__pos").alias("pos"), F.col("__k").alias("k")))
    per_doc = found.groupBy("doc_id", "__th", "__row", "n_words").agg(
        F.sort_array(F.collect_set(span)).alias("spans"),
        F.array_distinct(F.flatten(F.collect_set("__items"))).alias("__ids"))
    ids = F.sort_array(F.transform("__ids", lambda x: x.cast("string")))
    return per_doc.select("doc_id", "__th", "n_words", "spans", ids.alias("items"), covered(F.col("spans")).alias("n_hit"))


def contaminated(share: int = SHARE) -> Column:
    return (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words"))


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The contract's columns."""
    return hits(docs, benchmark).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), contaminated().alias("contaminated"))


def without_spans(text: Column, spans: Column) -> Column:
    """The text without the words of the spans and what follows each of them up to the next word."""
    between = ANY_CASE_WORD.replace("[^", "[").replace("+", "*")
    lead = F.regexp_extract(text, "^" + between, 0)
    pieces = words(text, ANY_CASE_WORD + between)
    kept = F.filter(pieces, lambda _, i: ~F.exists(spans, lambda s: (s["pos"] <= i) & (i < s["pos"] + s["k"])))
    return F.concat(lead, F.array_join(kept, ""))


def remove(docs: DataFrame, benchmark: DataFrame, mode: str = "documents") -> DataFrame:
    """``docs`` without contaminated documents (``documents``), or with the hit
    spans of contaminated documents cut out of ``text`` (``spans``)."""
    bad = (hits(docs.select("doc_id", "text"), benchmark).where(contaminated())
           .select(F.col("doc_id").alias("__bid"), F.col("__th").alias("__bth"), F.col("spans").alias("__spans"))
           .dropDuplicates(["__bid", "__bth"]))
    same = F.col("doc_id").eqNullSafe(F.col("__bid")) & (F.col("__th") == F.col("__bth"))
    left = docs.withColumn("__th", F.xxhash64("text"))
    if mode == "documents":
        return left.join(bad, same, "left_anti").select(*docs.columns)
    if mode != "spans":
        raise ValueError(f"mode must be 'documents' or 'spans', not {mode!r}")
    out = left.join(bad, same, "left")
    text = F.when(F.col("__spans").isNull(), F.col("text")).otherwise(without_spans(F.col("text"), F.col("__spans")))
    return out.withColumn("text", text).select(*docs.columns)


ORACLE_SQL = r"""
WITH iw AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL),
ik AS (SELECT item_id, w, least(len(w), 13) AS k FROM iw WHERE len(w) > 0),
win AS (
  SELECT DISTINCT item_id, k, array_to_string(list_slice(w, s, s + k - 1), ' ') AS win
  FROM (SELECT item_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS s FROM ik)),
dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
pos AS (
  SELECT doc_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS s
  FROM dw, (SELECT DISTINCT k FROM win) WHERE len(w) >= k),
hit AS (
  SELECT p.doc_id, p.s, p.k, n.item_id
  FROM (SELECT doc_id, s, k, array_to_string(list_slice(w, s, s + k - 1), ' ') AS win FROM pos) p
  JOIN win n ON p.win = n.win AND p.k = n.k),
cov AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(s, s + k - 1)) AS q FROM hit) GROUP BY doc_id),
its AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hit WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(c.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(i.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(i.ids, '')) AS items_sha256,
       coalesce(c.n_hit, 0) > 0 AND 20 * coalesce(c.n_hit, 0) >= len(d.w) AS contaminated
FROM dw d LEFT JOIN cov c ON d.doc_id = c.doc_id LEFT JOIN its i ON d.doc_id = i.doc_id
"""
