import random
import zlib
from collections import defaultdict
from functools import lru_cache

import numpy as np
from hypothesis import given
from hypothesis import strategies as st

from terroir.llm import packing


@given(st.integers(1, 100_000))
def test_piece_lengths(n):
    got = packing.piece_lengths(n)
    assert sum(got) == n and all(x & (x - 1) == 0 and 0 < x <= 2048 for x in got)
    assert got == sorted(got, reverse=True) and len({x for x in got if x < 2048}) == len([x for x in got if x < 2048])


def test_round_trip_and_vocabulary(spark, messy, messy_rows):
    import public_tokenizers
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    extra = [(900, "a <|endoftext|> b", "", "", 0, 0, "", "")]
    rows = [r for r in messy_rows if r[0] not in (30,)] + extra
    docs = messy.where("doc_id is null or doc_id <> 30").unionAll(spark.createDataFrame(extra, messy.schema))
    got = packing.pack(docs, with_ids=True).collect()
    want = sorted((str(r[0]), t.encode(r[1] or "", add_special_tokens=False).ids + [1]) for r in rows)
    by_doc = defaultdict(list)
    for r in got:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert len(ids) == r["length"] and zlib.crc32(r["ids"]) == r["ids_crc32"] and r["offset"] == 0
        by_doc[r["doc_id"], r["doc_tokens"]].append((r["start"], ids))
    assert sorted(r["sequence_id"] for r in got) == list(range(len(got)))
    by_seq = sorted(got, key=lambda r: r["sequence_id"])
    assert [r["length"] for r in by_seq] == sorted((r["length"] for r in got), reverse=True)
    singles = {k: v for k, v in by_doc.items() if k[0] not in (9,)}
    texts = dict((k, v) for k, v in want if k not in ("9",))
    for (doc, n), parts in singles.items():
        joined = [x for _, ids in sorted(parts) for x in ids]
        assert joined == texts[str(doc)] and len(joined) == n


def test_long_word(spark):
    docs = spark.createDataFrame([(1, "ab" * 20_000)], "doc_id long, text string")
    got = packing.digest(docs).collect()
    assert sum(r["length"] for r in got) == got[0]["doc_tokens"]


def test_empty(empty):
    assert packing.digest(empty).count() == 0


@lru_cache
def named_tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def named_ids(text):
    """Ids by the tokenizer file that the contract names, with its own settings."""
    return named_tokenizer().encode(text, add_special_tokens=False).ids


def digest_of(ids):
    """(start, length, ids_crc32, doc_tokens) of a document's pieces."""
    raw, start, out = np.array([*ids, 1], "<u4").tobytes(), 0, []
    for size in packing.piece_lengths(len(ids) + 1):
        out.append((start, size, zlib.crc32(raw[4 * start:4 * (start + size)]), len(ids) + 1))
        start += size
    return out


def check_digest(spark, texts):
    got = defaultdict(list)
    for r in packing.digest(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect():
        got[r["doc_id"]].append((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]))
    assert {k: sorted(v) for k, v in got.items()} == {i: digest_of(named_ids(t)) for i, t in enumerate(texts)}


def test_digest_has_ids_of_added_tokens(spark):
    end = "<|endoftext|>"
    assert named_ids(f"a {end} b") == [64, 220, 50256, 275]
    check_digest(spark, [f"a {end} b", end, end * 2, f"a  {end}\n\n", f"x{end}y", "<|endoftext|", "plain", ""])


def test_long_white_space(spark):
    many = 2_000_000
    check_digest(spark, [" " * many, f"a{' ' * many}b  c", "\n" * many + "<|endoftext|>" + " " * many + "x",
                         f"x {chr(0x3000) * many}\u2003", "a" * many])


def test_white_space_runs_equal_named_tokenizer(monkeypatch):
    monkeypatch.setattr(packing, "LONG_RUN", 3)
    enc, rnd = packing.encoder(packing.vocabulary_path()), random.Random(3)
    signs = [" ", " ", "\n", "\t", "\r", "\x0b", "\x1c", "\x85", "\xa0", "\u2003", "\u3000", "\u200b", "a", "'s", "7", "!", "\u00e9",
             "<|endoftext|>"]
    for _ in range(5000):
        text = "".join(rnd.choice(signs) for _ in range(rnd.randint(0, 30)))
        assert packing.token_ids(enc, text, True) == named_ids(text)


def test_white_is_the_space_of_the_pattern():
    import regex
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    assert "".join(packing.WHITE.findall(every)) == "".join(regex.findall(r"\s", every))
