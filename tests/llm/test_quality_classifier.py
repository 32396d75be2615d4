import random
import zlib

import numpy as np

from terroir.llm import quality_classifier as q
from terroir.llm.bytes_text import chunks, cut, word_bounds, word_hashes


def corpus(n=600):
    rnd = random.Random(2)
    word = lambda: "".join(rnd.choices("abcdefgh", k=rnd.randint(2, 7)))
    rows, labels = [], []
    for i in range(n):
        good = i % 3 > 0
        w = [word() for _ in range(rnd.randint(5, 120))]
        if not good:
            w = [x.upper() + "!!" for x in w] if i % 2 else [x for x in w for _ in range(6)]
        rows.append((i, " ".join(w)))
        labels.append((i, int(good), 0))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, score double")
    labels_df = spark.createDataFrame(labels + [(None, 1, 0), (3, None, None)], "doc_id long, quality int, text int")
    got = q.digest(docs, labels_df).collect()
    assert len(got) == len(rows)
    truth = {i: y for i, y, _ in labels}
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1
        assert r["predicted"] == int(r["score"] >= 0.7)
    out = [r for r in got if r["held_out"]]
    assert len(out) > 50 and np.mean([r["predicted"] == truth[r["doc_id"]] for r in out]) > 0.95


def test_held_out_labels_are_never_read(spark):
    rows, labels = corpus(200)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    schema = "doc_id long, quality int, toxic int"
    flipped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 4 == 2 else y, t) for i, y, t in labels]
    a = q.digest(docs, spark.createDataFrame(labels, schema)).collect()
    assert sorted(a) == sorted(q.digest(docs, spark.createDataFrame(flipped, schema)).collect())


def test_sample_is_bounded(spark):
    """Copies of a labelled row, and many texts of one doc_id, stay within max_train."""
    rows, labels = corpus(60)
    docs = spark.createDataFrame(rows + [rows[1]] * 50 + [(2, f"text {i}") for i in range(50)], "doc_id long, text string")
    labels_df = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    plain = spark.createDataFrame(rows, "doc_id long, text string")
    assert len(q.training_bags(docs, labels_df, 20)) == 20
    open_ids = sum(zlib.crc32(str(i).encode()) % 4 != 2 for i, _ in rows)
    assert len(q.training_bags(plain, labels_df)) == open_ids
    assert len(q.training_bags(docs, labels_df)) == open_ids + 50


def brute_score(text, model):
    """The mean weight of a text's word, word-pair and byte-gram buckets, bucket by bucket."""
    weights, bias = model
    (ids, counts), = q.bags([text.encode()])
    total = sum(float(weights[i]) * int(c) for i, c in zip(ids, counts, strict=True))
    return 1 / (1 + np.exp(-(total / max(1, int(counts.sum())) + bias)))


def test_scores_equal_the_formula(spark):
    rows, labels = corpus(150)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = q.train(q.training_bags(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")))
    got = {r["doc_id"]: r["score"] for r in q.score(docs, model).collect()}
    assert all(abs(got[i] - brute_score(t, model)) < 1e-4 for i, t in rows)


def test_messy(spark, messy, empty):
    rows, labels = corpus(120)
    docs = messy.select("doc_id", "text").unionAll(spark.createDataFrame(rows, "doc_id long, text string"))
    got = q.digest(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert len(got) == docs.count() and all(r["score"] is not None for r in got)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in q.digest(messy, none).collect()} == {0.5}
    assert q.digest(empty, none).count() == 0


def test_features_do_not_depend_on_chunks(monkeypatch):
    texts = [" ".join(f"wörd{i % 37}" for i in range(500)).encode(), b"", b"one", b"a b"]
    whole = q.bags(texts)
    alone = [q.bags([t])[0] for t in texts]
    for (i, c), (j, d) in zip(whole, alone):
        assert (i == j).all() and (c == d).all()


def test_bytes_text():
    assert b"".join(cut(b"aa bb cc dd", 4)) == b"aa bb cc dd" and list(cut(b"xxxxxx", 4)) == [b"xxxx", b"xx"]
    texts = [b"one two", b"", b"two\tthree one"]
    rows, first, data = next(chunks(texts))
    s, e = word_bounds(data)
    words = [bytes(data[a:b]) for a, b in zip(s, e)]
    assert words == [b"one", b"two", b"two", b"three", b"one"]
    h = word_hashes(data, s, e)
    assert h[0] == h[4] and h[1] == h[2] and len(set(h.tolist())) == 3
