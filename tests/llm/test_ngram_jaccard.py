import random
import re
from collections import Counter

import pytest

from terroir.llm import ngram_jaccard as nj
from terroir.llm.components import connected

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(t):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    if len(w) < 4:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + 4]) for i in range(len(w) - 3)}


def brute(rows):
    sets = [shingles(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                parent[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(r[0], least.get(find(i), r[0]))
    return Counter((r[0], len(sets[i]), least.get(find(i), r[0])) for i, r in enumerate(rows))


def near_copies():
    rnd = random.Random(6)
    word = lambda: rnd.choice("abcdefghijklmnop") + str(rnd.randint(0, 300))
    rows, passage = [], [word() for _ in range(60)]
    for i in range(60):
        rows.append([word() for _ in range(rnd.randint(1, 150))])
    original = [word() for _ in range(200)]
    for i in range(80):                        # a star: copies near the original, less so among themselves
        copy = list(original)
        for _ in range(rnd.choice([1, 3, 5, 6])):
            copy[rnd.randrange(200)] = word()
        rows.append(copy)
    chain = [word() for _ in range(100)]
    for i in range(25):                        # a chain: neighbours link, the ends do not
        chain = chain[2:] + [word(), word()]
        rows.append(list(chain))
    for i in range(40):                        # mostly one shared passage, not near
        rows.append(passage + [word() for _ in range(rnd.randint(10, 25))])
    rnd.shuffle(rows)
    return [(i, " ".join(r)) for i, r in enumerate(rows)]


@pytest.mark.parametrize(("hot", "max_hot"), [(8, 2_000_000), (4, 300)])
def test_near_copies_equal_brute_force(spark, hot, max_hot, monkeypatch):
    rows = near_copies()
    similar = nj.similar
    monkeypatch.setattr(nj, "similar", lambda d, s, p: similar(d, s, p, hot, max_hot))
    got = nj.digest(spark.createDataFrame(rows, "doc_id long, text string"))
    assert Counter(tuple(r) for r in got.collect()) == brute(rows)


def test_messy(messy, messy_rows):
    got = Counter(tuple(r) for r in nj.digest(messy).collect())
    want = brute(messy_rows)
    assert {r for r in got if r[0] is not None} == {r for r in want if r[0] is not None}
    out = nj.one_per_group(messy)
    assert out.columns == messy.columns
    assert sorted(r[0] for r in out.where("doc_id in (7, 8)").collect()) == [7]
    assert out.where("doc_id is null or text is null or doc_id = 2").count() == 3


def test_segmented_text_equals_whole(monkeypatch):
    text = " ".join(f"w{i % 997}x{i % 13}" for i in range(5000)).encode()
    whole = nj.ngram_sets([text])[0]
    monkeypatch.setattr(nj, "CHUNK_BYTES", 1000)
    real = nj.chunks
    monkeypatch.setattr(nj, "chunks", lambda t: real(t, 1000))
    assert (nj.ngram_sets([text])[0] == whole).all()


def test_components(spark):
    rnd = random.Random(1)
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(200)] + [(rnd.randrange(2000, 2200),) * 2 for _ in range(9)]
    rnd.shuffle(edges)
    got = dict(tuple(r) for r in connected(spark.createDataFrame(edges, "u long, v long")).collect())
    assert got == {**{i: 0 for i in range(301)}, **{1000 + i: 1000 for i in range(200)}}


def test_empty(empty):
    assert nj.digest(empty).count() == 0 and nj.one_per_group(empty).columns == empty.columns


def all_links(rows):
    """({row pairs that link}, the number of links per row) of rows with a doc_id."""
    sets = {r[0]: frozenset(shingles(r[1])) for r in rows}
    pairs = {(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])}
    return pairs, Counter(x for p in pairs for x in p)


@pytest.mark.parametrize(("hot", "block"), [(8, 256), (4, 7)])
def test_joined_returns_every_link(spark, hot, block, monkeypatch):
    monkeypatch.setattr(nj, "BLOCK", block)
    tight = [[f"t{j}" if j != 3 * i else f"u{i}" for j in range(200)] for i in range(60)]   # all pairs link
    rows = [*near_copies(), *((2000 + i, " ".join(w)) for i, w in enumerate(tight)), (1000, "a b c d e"), (1001, "A b c d e"), (1002, ""), (1003, None)]
    got, links = nj.joined(spark.createDataFrame(rows, "doc_id long, text string"), hot=hot)
    got = got.collect()
    links = [tuple(r) for r in links.collect()]
    assert len(links) == len({frozenset(p) for p in links})
    of = {}
    for r in got:
        of.setdefault(r["node"], []).append(r["doc_id"])
    pairs = {tuple(sorted((a, b))) for x, y in links for a in of[x] for b in of[y]}
    pairs |= {tuple(sorted((a, b))) for r in got if r["n"] for a in of[r["node"]] for b in of[r["node"]] if a != b}
    want, counts = all_links(rows)
    assert pairs == want and len(want) > 1000
    assert {r["doc_id"]: r["n_links"] for r in got} == {r[0]: counts[r[0]] if shingles(r[1]) else None for r in rows}


def test_long_words_count_once_across_segments(monkeypatch):
    rnd = random.Random(4)
    texts = [" ".join("".join(rnd.choice("aBc") for _ in range(rnd.choice([1, 3, 9, 40, 130]))) for _ in range(rnd.randint(1, 40)))
             + " " * rnd.randint(0, 30) for _ in range(400)]
    texts = [(" " * rnd.randint(0, 12) + t).encode() for t in texts] + [b"a" * 500, b"x " + b"a" * 500, b"a" * 20 + b" b", b" " * 99]
    whole = nj.ngram_sets(texts)
    real = nj.chunks
    for limit in (10, 11, 64):
        monkeypatch.setattr(nj, "CHUNK_BYTES", limit)
        monkeypatch.setattr(nj, "chunks", lambda t, limit=limit: real(t, limit))
        assert [x.tolist() for x in nj.ngram_sets(texts)] == [x.tolist() for x in whole]


def test_word_of_many_megabytes():
    big = b"a" * (5 << 20)
    one, two, other, three = nj.ngram_sets([big, b"x y z w " + big, big[:-1] + b"b", b"x y " + big + b" z w"])
    assert len(one) == len(other) == 1 and one[0] != other[0]
    assert len(two) == len(three) == 2


def test_one_per_group_matches_doc_id_and_text(spark):
    words = [f"w{i}" for i in range(100)]
    near, clean = " ".join([*words[:99], "end"]), "a clean row whose doc_id occurs with another text as well"
    rows = [(1, " ".join(words), "a"), (2, near, "b"), (2, clean, "c"),
            (5, "twice the same row of text", "z"), (5, "twice the same row of text", "d"), (6, "Twice the same row of text", "e"),
            (7, "", "f"), (7, "", "g"), (None, near, "h"), (None, near, "i")]
    out = nj.one_per_group(spark.createDataFrame(rows, "doc_id long, text string, x string"))
    assert out.columns == ["doc_id", "text", "x"]
    assert sorted(r["x"] for r in out.collect()) == ["a", "c", "d", "f", "g", "h", "i"]
