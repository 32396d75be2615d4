"""Packing by power-of-two decomposition.

Method: a document of n tokens is split into pieces whose lengths are the
binary digits of n (largest first, none above ``max_len``), so every piece
is a full sequence of a power-of-two length: no padding, and no sequence
crosses documents.  Pieces of equal length form a bucket; sequence ids run
without gaps through the buckets, longest first, so a loader takes a batch
of one length as an id range.

Tokens come from the 50k byte-level BPE ranks and the added tokens of the
``tokenizers`` file of the same name (the same vocabulary and the same ids,
which the tests compare; several times faster), plus the end id.  Tokenising is one Arrow pass over the documents;
only piece headers (no ids) are numbered, in two passes over a range
partitioning, so a hot bucket is spread over many tasks.

Defined results
* null or empty text: one piece of one token (the end id).
* the strings of added tokens in a text get the ids of these tokens in the
  contract's columns, as the named file does; ``pieces`` and ``pack`` take them as
  ordinary text unless called with ``added_tokens``.
* long texts: any length, also long runs of white space or of one word.
* repeated rows: each is packed; ties in (length, doc_id, start) are numbered
  in arbitrary order among equal pieces.
* empty table: empty result; extra columns are not read.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terroir.llm.storage import written
from terroir.operators.ids import attach_row_number, range_local_index

MAX_LEN = 2048
END_ID = 1
VOCABULARY = "byte_bpe_50k.tiktoken"
LONG_RUN = 100_000                # characters of white space from which a run is a piece of its own
WHITE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")   # \s of the pattern
PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary")


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def added(path: str) -> dict[str, int]:
    """The added tokens of the ``tokenizers`` file beside a rank file (none without one)."""
    beside = os.path.splitext(path)[0] + ".json"
    if not os.path.exists(beside):
        return {}
    with open(beside, encoding="utf-8") as f:
        tokens = json.load(f)["added_tokens"]
    for t in tokens:
        if t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]:
            raise ValueError(f"added token {t['content']!r} is not matched as plain text")
    return {t["content"]: t["id"] for t in tokens}


_ENCODERS: dict[str, object] = {}


def encoder(path: str):
    """The tokenizer of a rank file, loaded once per Python worker."""
    if path not in _ENCODERS:
        import base64

        import public_tokenizers
        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f)}
        _ENCODERS[path] = tiktoken.Encoding("bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                            special_tokens=added(path))
    return _ENCODERS[path]


def plain_ids(enc, text: str) -> list[int]:
    r"""Ids of a text without added tokens, whatever its runs of white space.

    The pattern's ``\s+(?!\S)`` backtracks over a whole run and fails on about a
    million characters, so a long run is handed over as the piece that the
    pattern would find: all of it at the end, else all but its last character.
    """
    if len(text) < LONG_RUN:
        return enc.encode_ordinary(text)
    ids, at = [], 0
    for run in WHITE.finditer(text):
        if run.end() - run.start() >= LONG_RUN:
            end = run.end() if run.end() == len(text) else run.end() - 1
            ids += enc.encode_ordinary(text[at:run.start()])
            ids += enc._encode_single_piece(text[run.start():end])
            at = end
    return ids + enc.encode_ordinary(text[at:])


def token_ids(enc, text: str, added_tokens: bool) -> list[int]:
    """Ids of a text; strings of added tokens are these tokens or ordinary text."""
    if not added_tokens or not enc.special_tokens_set:
        return plain_ids(enc, text)
    if len(text) < LONG_RUN:
        return enc.encode(text, allowed_special="all")
    names = sorted(enc.special_tokens_set, key=len, reverse=True)
    ids: list[int] = []
    for part in re.split(f"({'|'.join(map(re.escape, names))})", text):
        if part in enc.special_tokens_set:
            ids.append(enc.encode_single_token(part))
        else:
            ids += plain_ids(enc, part)
    return ids


def piece_lengths(n: int, max_len: int = MAX_LEN) -> list[int]:
    """``n`` as powers of two up to ``max_len``, largest first."""
    out = [max_len] * (n // max_len)
    rest, size = n % max_len, max_len
    while size > 1:
        size //= 2
        if rest & size:
            out.append(size)
    return out


def pieces(docs: DataFrame, vocabulary: str | None = None, max_len: int = MAX_LEN, end_id: int = END_ID,
           with_ids: bool = False, added_tokens: bool = False) -> DataFrame:
    """One row per piece; ``ids`` (little-endian unsigned 32 bit) only if asked for."""
    path = vocabulary or vocabulary_path()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = token_ids(enc, text.as_py() or "", added_tokens)
                ids.append(end_id)
                raw = np.array(ids, dtype="<u4").tobytes()
                start = 0
                for size in piece_lengths(len(ids), max_len):
                    part = raw[4 * start:4 * (start + size)]
                    rows.append((doc_id, start, size, zlib.crc32(part), len(ids), part if with_ids else None))
                    start += size
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 5 + [pa.binary()], strict=True)],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"])
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, PIECES)


def pack(docs: DataFrame, vocabulary: str | None = None, max_len: int = MAX_LEN, end_id: int = END_ID,
         with_ids: bool = False, added_tokens: bool = False) -> DataFrame:
    """Pieces with sequence_id and offset; each piece is a sequence of its own.

    ``with_ids`` keeps the token ids, for writing the training sequences;
    ``added_tokens`` gives strings of added tokens their ids, as the contract does.
    """
    cut = written(pieces(docs, vocabulary, max_len, end_id, with_ids, added_tokens), "pieces")
    ranged = written(range_local_index(cut, [F.desc("length"), F.col("doc_id"), F.col("start")]), "ranged-pieces")
    out = attach_row_number(ranged, "__n").withColumns(
        {"sequence_id": F.col("__n") - 1, "offset": F.lit(0).cast("long")}).drop("__n")
    return out if with_ids else out.drop("ids")


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns."""
    return pack(docs, added_tokens=True).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
