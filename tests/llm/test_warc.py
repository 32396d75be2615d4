import hashlib
import struct

import zstandard

from terroir.llm import warc

PAGES = [(1, "http://a/", "x" * 100), (2, "http://b/", "x" * 100), (3, "http://c/", "x" * 99), (4, None, "x" * 99),
         (5, "http://d/\r\nEvil: 1", None), (6, "http://é/", ""), (0, "http://z/", "é" * 50), (7, "u", "é" * 50),
         (7, "u", "é" * 50), (None, "n", "x" * 100), (9, "http://long/", "WARC/1.1\r\n\r\n" * 200_000)]
SCHEMA = "page_id long, url string, html string, digest string"


def pages(spark):
    return spark.createDataFrame([(*p, "clash") for p in PAGES], SCHEMA)


def test_digest_equals_brute_force(spark):
    first = {}
    for i, _, h in PAGES:
        if i is not None and len((h or "").encode()) >= 100:
            first[h] = min(i, first.get(h, i))
    want = []
    for i, _, h in PAGES:
        raw = (h or "").encode()
        other = first.get(h) if len(raw) >= 100 and first.get(h) != i else None
        want.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "response" if other is None else "revisit", other))
    assert sorted((tuple(r) for r in warc.digest(pages(spark)).collect()), key=str) == sorted(want, key=str)


def test_bundles_are_seekable(spark, tmp):
    folder = f"file://{tmp}/warc"
    index = warc.write(pages(spark), folder, frame_bytes=300, bundle_bytes=700).collect()
    assert len(index) == len(PAGES)
    payload = {f"urn:page:{'' if i is None else i}": (h or "").encode() for i, _, h in PAGES}
    for r in index:
        head, body = warc.fetch(folder, r["bundle"], r["frame"], r["offset"])
        assert head["WARC-Record-ID"] == f"<{r['record_id']}>" and "Evil" not in head
        assert body == (payload[r["record_id"]] if head["WARC-Type"] == "response" else b"")
    for name in {r["bundle"] for r in index}:
        raw = open(f"{tmp}/warc/{name}", "rb").read()
        assert struct.unpack("<I", raw[-4:])[0] == warc.SEEKABLE_MAGIC
        whole = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read()   # one plain stream
        n, end = 0, 0
        while end < len(whole):
            _, _, end = warc.parse_record(whole, end)
            n += 1
        assert n == sum(r["bundle"] == name for r in index)


def test_payloads_round_trip(spark, tmp):
    folder = f"file://{tmp}/warc2"
    index = warc.write(pages(spark), folder)
    got = warc.read(spark, folder, index, with_payload=True).where("record_type = 'response'").collect()
    assert all(hashlib.sha256(r["payload"]).hexdigest() == r["payload_digest"] for r in got)


def test_empty(spark):
    assert warc.digest(spark.createDataFrame([], SCHEMA)).count() == 0
