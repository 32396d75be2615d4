"""PII spans by weak supervision.

Method: wide patterns propose candidate spans of four kinds.  Labelers vote
on each (for, against, abstain): a strict regex, a gazetteer (top-level
domains, country codes, reserved networks, issuer prefixes), and the words
before the span for and against.  Expectation-maximisation estimates each
labeler's reliability per kind without any labels; its posteriors train the
final span classifier, a logistic regression on the votes and the span's
shape.  Candidates it accepts are added; the contract's base spans stay.

Scale: one Arrow pass over the whole texts makes the candidates.  What EM and
the classifier see are counts per (kind, votes, shape) over all documents;
there are fewer than ``4 * 3**4 * 2**3`` such cells, whatever the corpus, so
they may reach the driver.  The decisions go back as one such table.

Defined results
* null or empty text: no span (the digest of an empty list).
* spans of one kind never overlap; an added span that touches any base span
  is left out; among overlapping added spans the leftmost, then longest stays.
* very long texts are searched whole, in time in proportion to their length, also where one
  run of digits, letters or separators fills them.
* repeated rows: one result row each.  No candidate anywhere: nothing is added.
* empty table: empty result; extra columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terroir.llm.storage import written

KINDS = ("email", "ip", "card", "phone")
ACCEPT = 0.8
BEFORE = 40                       # characters of context before a span
EM_ROUNDS = 50
N_LABELERS, N_SHAPES = 4, 3

# The contract's base patterns.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")         # see WHOLE_IP
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# IP's matches in linear time: a run of digits is tried once, and never shorter than it is.
WHOLE_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
# A stretch of digits and separators; every ip, card or national phone lies inside one.
ZONE = re.compile(r"[0-9][0-9 ().+-]{5,}[0-9]")
# What follows the name in a spelled-out address.
SPELLED_AT = re.compile(r"[(\[{] ?at ?[)\]}] ?[A-Za-z0-9-]++(?: ?(?:\.|[(\[{] ?dot ?[)\]}]) ?[A-Za-z0-9-]++)+", re.I)
WIDE_PHONE = re.compile(r"(?<![0-9.-])(?:00[1-9][0-9]{0,2}[ .-][0-9 ().-]{5,16}[0-9]"
                        r"|(?:\+[1-9][0-9]{0,2}[ .-]?)?\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4})(?![0-9.-])")
WIDE_CARD = re.compile(r"(?<![0-9.+-])[0-9](?:[ .-]?[0-9]){12,18}(?![0-9.-])")

# Gazetteers: common top-level domains, calling codes and card issuer prefixes.
DOMAINS = frozenset("com org net edu gov info io de es fr uk eu it nl pt at ch be ca us test example".split())
CALLING = tuple("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 60 61 62 63 64 65 66 81 82 84 "
                "86 90 91 92 351 352 353 358 380 420".split())
ISSUERS = {"34": (15,), "37": (15,), "4": (13, 16, 19), "51": (16,), "52": (16,), "53": (16,), "54": (16,), "55": (16,),
           "6011": (16, 19), "65": (16, 19), "35": (16, 19), "36": (14, 19), "30": (14, 16)}
CONTEXT = {
    "email": re.compile(r"\b(e-?mail|mail|contact|write|correo|courriel|schreib\w*|kontakt)\b", re.I),
    "ip": re.compile(r"\b(ip|host|server|ping|address|servidor|serveur|adresse)\b", re.I),
    "card": re.compile(r"\b(card|visa|mastercard|amex|credit|payment|tarjeta|carte|karte)\b", re.I),
    "phone": re.compile(r"\b(tel|phone|call|mobile|fax|telefon\w*|tel[eé]fono|t[eé]l[eé]phone|whatsapp)\b", re.I),
}
AGAINST = {
    "email": re.compile(r"\b(example|placeholder|template)\b", re.I),
    "ip": re.compile(r"\b(version|release|v|section|chapter|build|kapitel)\W*$", re.I),
    "card": re.compile(r"\b(isbn|ean|order|tracking|serial|id|ref\w*)\W*(no\W*)?$", re.I),
    "phone": re.compile(r"\b(isbn|issn|order|version|page|id|ref\w*|part)\W*(no\W*)?$", re.I),
}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def digits_of(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """EMAIL's leftmost non-overlapping matches, looking only around each @."""
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        m = EMAIL.match(text, start) if start < at else None
        if m:
            done = m.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The contract's base spans, by kind and then start."""
    out = [("email", s, e) for s, e in emails(text)] if "@" in text else []
    zones = [m.span() for m in ZONE.finditer(text)]
    out += [("ip", m.start(), m.end()) for a, b in zones for m in WHOLE_IP.finditer(text, a, b)
            if all(len(p) <= 3 and int(p or 0) <= 255 for p in (x.lstrip("0") for x in m.group().split(".")))]
    for a, b in zones:
        for m in CARD.finditer(text, a, b):
            d = digits_of(m.group())
            if 16 <= len(d) <= 19 and luhn(d):
                out.append(("card", m.start(), m.end()))
    if "+" in text:
        out += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 8 <= len(digits_of(m.group())) <= 15]
    return out


def spelled_emails(text: str) -> Iterator[tuple[int, int]]:
    """Names before a spelled-out at sign, with what follows; leftmost, non-overlapping."""
    done = 0
    for m in SPELLED_AT.finditer(text):
        start = m.start() - (m.start() > done and text[m.start() - 1] == " ")
        name_end = start
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < name_end:
            done = m.end()
            yield start, done


def wide_spans(text: str) -> Iterator[tuple[str, int, int]]:
    """Candidates beyond the base patterns."""
    yield from (("email", s, e) for s, e in spelled_emails(text))
    for z in ZONE.finditer(text):
        a, b = z.span()
        yield from (("phone", *m.span()) for m in WIDE_PHONE.finditer(text, max(0, a - 1), b))
        yield from (("card", *m.span()) for m in WIDE_CARD.finditer(text, a, b))
        yield from (("ip", *m.span()) for m in WHOLE_IP.finditer(text, a, b))


def votes(kind: str, text: str, start: int, end: int, base: bool) -> tuple[int, ...]:
    """One vote per labeler: 1 for, 0 against, 2 abstain."""
    span, before = text[start:end], text[max(0, start - BEFORE):start]
    d = digits_of(span)
    if kind == "email":
        strict = 1 if base else 2
        known = 1 if re.split(r"[^a-z]+", span.lower())[-1] in DOMAINS else 0
    elif kind == "ip":
        strict = 1 if base else 0
        parts = span.split(".")
        known = 0 if parts[0].lstrip("0") in ("", "255") or any(len(p) > 1 and p[0] == "0" for p in parts) else 1
    elif kind == "card":
        strict = 1 if luhn(d) else 0
        known = 1 if any(d.startswith(p) and len(d) in n for p, n in ISSUERS.items()) else 0
    else:
        abroad = span.startswith(("+", "00"))
        strict = 1 if abroad and 8 <= len(d) <= 15 else 2
        number = d[2:] if span.startswith("00") else d
        known = (1 if number.startswith(CALLING) else 0) if abroad else 2
    return (strict, known, 1 if CONTEXT[kind].search(before) else 2, 0 if AGAINST[kind].search(before) else 2)


def shape(kind: str, text: str, start: int, end: int) -> tuple[int, ...]:
    span = text[start:end]
    return (int(any(c in " -()" for c in span)), int(end - start > 18),
            int(end < len(text) and (text[end].isalnum() or (start > 0 and text[start - 1].isalnum()))))


def candidates(text: str) -> list[tuple[str, int, int, bool, str]]:
    """(kind, start, end, base, cell): all base spans, and the wide spans that
    touch none of them; the cell holds votes and shape as digits."""
    base = base_spans(text)
    taken: list[list[int]] = []                    # base spans as disjoint stretches
    for s, e in sorted((s, e) for _, s, e in base):
        if taken and s <= taken[-1][1]:
            taken[-1][1] = max(taken[-1][1], e)
        else:
            taken.append([s, e])
    found = [(k, s, e, True) for k, s, e in base]
    added: list[tuple[str, int, int, bool]] = []
    i = 0
    for k, s, e in sorted(wide_spans(text), key=lambda x: (x[1], -x[2])):
        while i < len(taken) and taken[i][1] <= s:
            i += 1
        if (i == len(taken) or e <= taken[i][0]) and (not added or added[-1][2] <= s):
            added.append((k, s, e, False))
    return [(k, s, e, b, "".join(map(str, (*votes(k, text, s, e, b), *shape(k, text, s, e))))) for k, s, e, b in found + added]


SPANS = "array<struct<kind:string,start:long,end:long,base:boolean,cell:string>>"
SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                ("base", pa.bool_()), ("cell", pa.string())]))


def candidate_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, spans) per document: all candidates of its whole text."""
    names = [f.name for f in SPAN_TYPE.value_type]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[dict(zip(names, c, strict=True)) for c in candidates(t.as_py() or "")] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, SPAN_TYPE)], ["doc_id", "spans"])
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, f"doc_id long, spans {SPANS}")


def expectation_maximisation(cells: Counter, rounds: int = EM_ROUNDS) -> dict[str, float]:
    """Posterior of each vote pattern of one kind (Dawid-Skene with two classes).

    Labelers are independent given the class; ``rate[v]`` is the chance that
    labeler j, if it votes, votes v on class y.  Starts from the vote majority.
    """
    keys = sorted(cells)
    v = np.array([[int(c) for c in k] for k in keys])
    n = np.array([cells[k] for k in keys], float)
    score = (v == 1).sum(1) - (v == 0).sum(1)
    post = 1 / (1 + np.exp(-score.astype(float)))
    for _ in range(rounds):
        prior = np.clip((n * post).sum() / n.sum(), 0.01, 0.99)
        like = np.log(np.array([1 - prior, prior]))[:, None].repeat(len(keys), 1)
        for y, weight in enumerate((n * (1 - post), n * post)):
            for j in range(v.shape[1]):
                # add-one smoothing, with one more vote for right than for wrong: class 1 stays "is personal data"
                rate = np.array([(weight[v[:, j] == x]).sum() for x in range(2)]) + np.array([2 - y, 1 + y])
                like[y] += np.append(np.log(rate / rate.sum()), 0)[v[:, j]]          # abstaining says nothing
        post = 1 / (1 + np.exp(np.clip(like[0] - like[1], -50, 50)))
    return dict(zip(keys, post.tolist(), strict=True))


def encoded(kind: str, cell: str) -> np.ndarray:
    """Classifier input: bias and kind; votes per kind; shape."""
    x = np.zeros(1 + len(KINDS) * (1 + 3 * N_LABELERS) + N_SHAPES)
    k = KINDS.index(kind)
    x[0] = 1
    x[1 + k] = 1
    for j in range(N_LABELERS):
        x[1 + len(KINDS) + (k * N_LABELERS + j) * 3 + int(cell[j])] = 1
    x[len(x) - N_SHAPES:] = [int(c) for c in cell[N_LABELERS:]]
    return x


def train_classifier(counts: dict[tuple[str, str], int], rounds: int = 400, ridge: float = 1e-3) -> dict[tuple[str, str], float]:
    """Probability per (kind, cell): EM posteriors by kind, then the logistic regression fitted to them."""
    if not counts:
        return {}
    keys = sorted(counts)
    target = np.zeros(len(keys))
    for kind in KINDS:
        cells: Counter = Counter()
        for k, c in keys:
            if k == kind:
                cells[c[:N_LABELERS]] += counts[k, c]
        if cells:
            post = expectation_maximisation(cells)
            for i, (k, c) in enumerate(keys):
                if k == kind:
                    target[i] = post[c[:N_LABELERS]]
    x = np.array([encoded(*k) for k in keys])
    n = np.array([counts[k] for k in keys], float)
    n = np.sqrt(n / n.sum())                       # frequent cells count more, but do not drown the rest
    n /= n.sum()
    w = np.zeros(x.shape[1])
    for _ in range(rounds):                        # damped Newton steps
        p = 1 / (1 + np.exp(-x @ w))
        grad = x.T @ (n * (p - target)) + ridge * w
        hess = (x * (n * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step / max(1, np.abs(step).max())
        if np.abs(step).max() < 1e-9:
            break
    return dict(zip(keys, (1 / (1 + np.exp(-x @ w))).tolist(), strict=True))


def find(docs: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """(doc_id, spans) per document: base spans, and the accepted candidates."""
    rows = written(candidate_rows(docs), "pii-candidates")
    each = rows.select(F.explode("spans").alias("s")).groupBy("s.kind", "s.cell").agg(F.count(F.lit(1)).alias("n"))
    counts = {(r["kind"], r["cell"]): r["n"] for r in each.collect()}       # < 4 * 3^4 * 2^3 rows
    good = sorted(f"{k}:{c}" for (k, c), p in train_classifier(counts).items() if p >= accept)
    key = lambda s: F.concat(s["kind"], F.lit(":"), s["cell"])
    keep = F.filter("spans", lambda s: s["base"] | key(s).isin(good)) if good else F.filter("spans", lambda s: s["base"])
    return rows.select("doc_id", keep.alias("spans"))


def redact(docs: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """``docs`` with every found span replaced by ``<kind>`` (one row per doc_id and text is assumed to share spans)."""
    key = F.struct("doc_id", F.xxhash64("text"))
    keyed = docs.withColumn("__row", F.xxhash64(F.to_json(key)))
    spans = (find(keyed.select(F.col("__row").alias("doc_id"), "text"), accept)
             .dropDuplicates(["doc_id"]).select(F.col("doc_id").alias("__row"), F.col("spans").alias("__spans")))
    ordered = F.array_sort(F.transform("__spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))

    def step(a, s):
        piece = F.substring(F.col("text"), (a["at"] + 1).cast("int"), F.greatest(s["start"] - a["at"], F.lit(0)).cast("int"))
        new = F.when(s["start"] >= a["at"], F.concat(a["out"], piece, F.lit("<"), s["kind"], F.lit(">"))).otherwise(a["out"])
        return F.struct(new.alias("out"), F.greatest(a["at"], s["end"]).alias("at"))
    text = F.aggregate(ordered, start, step, lambda a: F.concat(a["out"], F.substring(
        F.col("text"), (a["at"] + 1).cast("int"), F.char_length(F.col("text")))))
    return keyed.join(spans, "__row", "left").withColumn("text", F.coalesce(text, F.col("text"))).select(*docs.columns)


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns."""
    def listed(spans):
        ranked = F.array_sort(F.transform(spans, lambda s: F.struct(
            F.array_position(F.array(*[F.lit(k) for k in KINDS]), s["kind"]).alias("r"), s["start"].alias("start"),
            s["end"].alias("end"), s["kind"].alias("kind"))))
        return F.array_join(F.transform(ranked, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["base"])

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")
    return find(docs).select("doc_id", *[count(k) for k in KINDS],
                             F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))

