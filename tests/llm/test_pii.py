import hashlib
import random
import re
import time
from collections import Counter

from terroir.llm import pii

KINDS = ("email", "ip", "card", "phone")


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def brute(text):
    d = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text if "@" in text else "")]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m.group().split("."))]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
            if 16 <= len(d(m.group())) <= 19 and luhn(d(m.group()))]
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(d(m.group())) <= 15]
    return out


def test_base_equals_brute_force():
    rnd = random.Random(4)
    pieces = ["a@b.c", "x.y@z", "@", "..", "1.2.3.4", "256.1.1.1", "001.02.3.4.5", "4111111111111111", "4111 1111-1111 1111",
              "+1 (555) 123-4567", "+1", "+12 ", "99", " ", "é", "-", "+", "(", "\n", "0000000000000000000000", "a%b@c-d.e.f.", "5"]
    for _ in range(3000):
        text = "".join(rnd.choices(pieces, k=rnd.randint(1, 12)))
        assert pii.base_spans(text) == brute(text), text


def test_digest(spark, messy, messy_rows):
    more = [(1000, "mail a@b.com, call +1 (555) 123-4567; ip 1.2.3.4; card 4111 1111 1111 1111", "", "", 0, 0, "", ""),
            (1001, "é a@b.com", "", "", 0, 0, "", "")]
    rows = messy_rows + more
    got = pii.digest(messy.unionAll(spark.createDataFrame(more, messy.schema))).collect()
    want = Counter()
    for r in rows:
        spans = brute(r[1] or "")
        n = Counter(k for k, _, _ in spans)
        text = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        want[(r[0], *(n[k] for k in KINDS), hashlib.sha256(text.encode()).hexdigest())] += 1
    assert Counter(tuple(r)[:6] for r in got) == want
    assert next(r["spans"] for r in got if r["doc_id"] == 1001) == "email:2:9"


def test_added_spans(spark):
    rnd = random.Random(8)
    rows = []
    for i in range(300):
        area, end = rnd.randint(200, 999), rnd.randint(1000, 9999)
        rows.append((i, f"please call +1 ({area}) 555-{end} or write to joe{i}@site{i}.org from 10.{i % 250}.0.1"))
    rows += [(1000, "phone: 0049 30 123 4567 89 thanks"), (1001, "order no. 1234567890123 and version 1.2.3"),
             (1002, "plain words only"), (1003, "contact joe [at] site [dot] org soon")]
    got = {r["doc_id"]: r["spans"] for r in pii.digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1000] == "phone:7:26" and got[1001] == "" and got[1002] == "" and got[1003].startswith("email:8:")


def test_em_orders_patterns():
    post = pii.expectation_maximisation(Counter({"1112": 900, "1122": 300, "0022": 400, "0020": 200, "2222": 20}))
    assert post["1112"] > 0.95 and post["1122"] > 0.9 and post["0022"] < 0.1 and post["0020"] < 0.1


def test_redact(spark):
    docs = spark.createDataFrame([(1, "write a@b.com now", "c"), (2, None, "d"), (3, "é 1.2.3.4", "e")], "doc_id long, text string, spans string")
    out = pii.redact(docs)
    assert out.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {1: "write <email> now", 2: None, 3: "é <ip>"}


def test_empty(empty):
    assert pii.digest(empty).count() == 0


WIDE_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+ ?[(\[{] ?at ?[)\]}] ?[A-Za-z0-9-]+(?: ?(?:\.|[(\[{] ?dot ?[)\]}]) ?[A-Za-z0-9-]+)+", re.I)


def test_linear_patterns_find_the_same():
    """The wide e-mail and ip searches, and the spans they may take, by the plain patterns."""
    rnd = random.Random(6)
    pieces = ["a.b", "[at]", " [at] ", "{ AT }", "(at)", "x", " ", "  ", ".", "[dot]", " (dot) ", "org", "1.2.3.4", "300.1.2.3", "7", "a@b.cd",
              "+1 (555) 123-4567", "0049 30 1234567", "é", "-"]
    for _ in range(4000):
        text = "".join(rnd.choices(pieces, k=rnd.randint(1, 14)))
        assert list(pii.spelled_emails(text)) == [m.span() for m in WIDE_EMAIL.finditer(text)], text
        assert [m.span() for m in pii.WHOLE_IP.finditer(text)] == [m.span() for m in pii.IP.finditer(text)], text
        base = sorted(pii.base_spans(text), key=lambda x: x[1])
        want = []
        for k, s, e in sorted(pii.wide_spans(text), key=lambda x: (x[1], -x[2])):
            if all(e <= a or b <= s for _, a, b in base) and (not want or want[-1][2] <= s):
                want.append((k, s, e))
        assert [c[:3] for c in pii.candidates(text) if not c[3]] == want, text


def test_long_runs():
    """A megabyte of one kind takes about as long as any other; zeros of any number are an ip's part."""
    zeros = "x " + "0" * 5000 + ".1.1.1 y"
    assert [c[:3] for c in pii.candidates(zeros) if c[3]] == [("ip", 2, 5008)]
    mega = 1_000_000
    many = " ".join(f"joe{i}@site{i}.org 10.0.{i % 250}.1" for i in range(50_000))
    texts = ["7" * mega, "1." * (mega // 2), "a" * mega + " [at]", "a" * mega + "[at]b", "a" * mega + "@", "+1" + " " * mega, "1 " * (mega // 2),
             "1" + " " * mega, "[at]" * (mega // 4), "(at) a " * (mega // 7), many, "a@" * (mega // 2), "1.2." + "3" * mega, "a@b" + ".c" * (mega // 2)]
    for text in texts:
        began = time.time()
        found = pii.candidates(text)
        assert time.time() - began < 12, text[:20]          # quadratic searches take minutes
        assert text is not many or len([c for c in found if c[3]]) == 100_000


def test_recall_of_added_spans(spark):
    """Planted spans beyond the base patterns, and look-alikes that are none."""
    rnd = random.Random(12)
    rows, planted, alike = [], {}, {}
    for i in range(600):
        kind = i % 4
        span = [f"joe{i} [at] site{i} [dot] org", f"00{rnd.choice([49, 44, 33])} 30 {rnd.randint(100, 999)} {rnd.randint(1000, 9999)}",
                f"({rnd.randint(200, 999)}) 555-{rnd.randint(1000, 9999)}", f"order no. {rnd.randint(10 ** 12, 10 ** 13 - 1)}"][kind]
        before = ["please write to ", "call me on tel ", "my phone is ", "your "][kind]
        text = f"word {i} {before}{span} and more words"
        at = text.index(span)
        (alike if kind == 3 else planted)[i] = (["email", "phone", "phone", "card"][kind], at, at + len(span))
        rows.append((i, text))
    rows += [(1000 + i, f"base a{i}@b.org, +1 (555) 123-{1000 + i}, 10.0.0.{i % 250}") for i in range(300)]
    got = {r["doc_id"]: r["spans"] for r in pii.digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    caught = sum(f"{k}:{s}:{e}" in got[i].split(",") for i, (k, s, e) in planted.items())
    assert caught >= 0.9 * len(planted)
    assert sum(bool(got[i]) for i in alike) <= 0.02 * len(alike)
