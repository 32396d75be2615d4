"""WARC archives as seekable Zstandard bundles.

Method: each page becomes one WARC/1.1 record; among equal payloads of at
least ``MIN_SHARED`` bytes the page with the smallest id is the response and the
others are revisits without a payload.  A task packs its records into
independent Zstandard frames of about ``FRAME_BYTES`` and appends the frames'
seek table as a skippable footer frame (the public seekable format), so
any standard decoder reads the bundle as one stream and a reader can fetch
a single frame.  The index maps every record id to its bundle, frame and
offset inside the decompressed frame.

Reading back plans by frame: the frames of the index are dealt over tasks;
each opens its bundle, takes the frame's place from the footer seek table,
decompresses just that frame and parses its records.

Durability: a bundle is written under a fresh name and renamed when complete;
the index is written by Spark's commit protocol and names only bundles of
successful tasks, so a lost or repeated task leaves an unreferenced file at
worst.  Bundles go to the shared folder through ``pyarrow.fs``.

Equal payloads are found by their digests only: groups are partial
aggregates, so a payload that a third of all pages share is a row per task.

Defined results
* null html: empty payload; null url: an empty target address; control
  characters of a url are percent-encoded.
* rows that repeat a page_id: each has its record; rows of the smallest id
  of a group are all responses.  A null page_id never becomes a group's
  smallest id unless it is the only one.
* very long payloads are one record, in a frame of their own if need be, held whole by one task.
* empty table: no bundle, empty result; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terroir.llm.storage import shared_path, written
from terroir.llm.text import text_or_empty

MIN_SHARED = 100
FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 256 << 20
LEVEL = 3
DATE = "2024-01-01T00:00:00Z"
# Magic numbers of the seekable Zstandard format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
INDEX = "record_id string, bundle string, frame int, offset long, length long"
RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def classified(pages: DataFrame, min_shared: int = MIN_SHARED) -> DataFrame:
    """(page_id, url, payload, digest, refers_to): refers_to is null for responses."""
    payload = F.encode(text_or_empty("html"), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    narrow = rows.where(F.octet_length("payload") >= min_shared).select("page_id", "digest")
    shared = (narrow.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("__n"))
              .where("__n > 1").drop("__n"))
    joined = rows.join(shared, "digest", "left")
    refers = F.when((F.octet_length("payload") >= min_shared) & F.col("first").isNotNull()
                    & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return joined.select("page_id", "url", "payload", "digest", refers.alias("refers_to"))


def target(url: str | None) -> str:
    return "".join(c if " " < c != "\x7f" else f"%{ord(c):02X}" for c in url or "")


def record_id(page_id: int | None) -> str:
    return f"urn:page:{'' if page_id is None else page_id}"


def record_bytes(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    revisit = refers_to is not None
    body = b"" if revisit else payload
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", f"<{record_id(page_id)}>"),
            ("WARC-Date", DATE), ("WARC-Target-URI", target(url)), ("WARC-Payload-Digest", f"sha256:{digest}"),
            ("X-Payload-Length", str(len(payload)))]
    if revisit:
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                 ("WARC-Refers-To", f"<{record_id(refers_to)}>")]
    head += [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(body)))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head)
    return f"WARC/1.1\r\n{lines}\r\n".encode() + body + b"\r\n\r\n"


def parse_record(data: bytes, offset: int) -> tuple[dict[str, str], bytes, int]:
    """(headers, body, end) of the record at ``offset`` of a decompressed frame."""
    stop = data.index(b"\r\n\r\n", offset)
    lines = data[offset:stop].decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"no record at offset {offset}")
    head = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    size = int(head["Content-Length"])
    return head, data[stop + 4:stop + 4 + size], stop + 4 + size + 4


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    """The skippable footer frame for (compressed, decompressed) frame sizes."""
    entries = b"".join(struct.pack("<II", *s) for s in sizes)
    return (struct.pack("<II", SKIPPABLE_MAGIC, len(entries) + 9) + entries
            + struct.pack("<IBI", len(sizes), 0, SEEKABLE_MAGIC))


def read_seek_table(f, size: int) -> list[tuple[int, int]]:
    """(position, compressed size) per frame, from a bundle's footer."""
    f.seek(size - 9)
    n, _, magic = struct.unpack("<IBI", f.read(9))
    if magic != SEEKABLE_MAGIC:
        raise ValueError("no seek table at the end of the bundle")
    f.seek(size - 9 - 8 * n)
    entries = struct.unpack(f"<{2 * n}I", f.read(8 * n))
    out, at = [], 0
    for c in entries[::2]:
        out.append((at, c))
        at += c
    return out


class Bundle:
    """One seekable bundle in the making."""

    def __init__(self, folder: str, frame_bytes: int):
        import zstandard
        from pyarrow import fs
        self.fs, base = fs.FileSystem.from_uri(folder)
        self.name = f"part-{uuid.uuid4().hex}.warc.zst"
        self.path, self.frame_bytes = f"{base}/{self.name}", frame_bytes
        self.out = self.fs.open_output_stream(self.path + ".tmp")
        self.zip = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)
        self.sizes, self.buffer, self.filled, self.total = [], [], 0, 0

    def add(self, record: bytes) -> tuple[int, int]:
        """(frame, offset in the decompressed frame) of the record."""
        place = (len(self.sizes), self.filled)
        self.buffer.append(record)
        self.filled += len(record)
        if self.filled >= self.frame_bytes:
            self.flush()
        return place

    def flush(self) -> None:
        if self.filled:
            frame = self.zip.compress(b"".join(self.buffer))
            self.out.write(frame)
            self.sizes.append((len(frame), self.filled))
            self.total += len(frame)
            self.buffer, self.filled = [], 0

    def close(self) -> None:
        self.flush()
        self.out.write(seek_table(self.sizes))
        self.out.close()
        self.fs.move(self.path + ".tmp", self.path)


def write(pages: DataFrame, folder: str, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES,
          min_shared: int = MIN_SHARED) -> DataFrame:
    """Write the bundles below ``folder`` (a URI all executors share); returns the index."""
    spark = pages.sparkSession
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(folder)
    root.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(root)
    uri = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"

    def bundles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle, rows = None, []

        def done():
            bundle.close()
            cols = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.string()), pa.array([bundle.name] * len(rows), pa.string()),
                 pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64())],
                ["record_id", "bundle", "frame", "offset", "length"])
        for batch in batches:
            for row in zip(*(batch.column(i) for i in range(5)), strict=True):
                page_id, url, payload, digest, refers_to = (x.as_py() for x in row)
                if bundle is None:
                    bundle, rows = Bundle(uri, frame_bytes), []
                record = record_bytes(page_id, url, payload, digest, refers_to)
                frame, offset = bundle.add(record)
                rows.append((record_id(page_id), frame, offset, len(record)))
                if bundle.total >= bundle_bytes:
                    yield done()
                    bundle = None
        if bundle is not None:
            yield done()
    return written(classified(pages, min_shared).mapInArrow(bundles, INDEX), "warc-index")


def parsed(head: dict[str, str], body: bytes) -> tuple:
    kind = head["WARC-Type"]
    digest = head["WARC-Payload-Digest"].removeprefix("sha256:")
    if kind == "response" and hashlib.sha256(body).hexdigest() != digest:
        raise ValueError(f"digest mismatch in {head['WARC-Record-ID']}")
    to_id = lambda x: int(v) if (v := x[1:-1].removeprefix("urn:page:")) else None
    return (to_id(head["WARC-Record-ID"]), int(head["X-Payload-Length"]), digest, kind,
            to_id(head["WARC-Refers-To"]) if kind == "revisit" else None, body)


def read(spark: SparkSession, folder: str, index: DataFrame, with_payload: bool = False) -> DataFrame:
    """All records of the index's bundles, frame by frame."""
    uri = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    frames = index.groupBy("bundle", "frame").agg(F.count(F.lit(1)).cast("long").alias("n"))

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyarrow import fs
        store, base = fs.FileSystem.from_uri(uri)
        unzip, tables = zstandard.ZstdDecompressor(), {}
        for batch in batches:
            for bundle, frame, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                path = f"{base}/{bundle}"
                with store.open_input_file(path) as f:
                    if bundle not in tables:
                        tables = {bundle: read_seek_table(f, f.size())}
                    at, size = tables[bundle][frame]
                    f.seek(at)
                    data = unzip.decompress(f.read(size))
                rows, end = [], 0
                while end < len(data):
                    head, body, end = parse_record(data, end)
                    rows.append(parsed(head, body))
                if len(rows) != n:
                    raise ValueError(f"{len(rows)} records in frame {frame} of {bundle}; the index has {n}")
                cols = list(zip(*rows, strict=True))
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
                cols[5] = cols[5] if with_payload else [None] * n
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                                                 [c.split()[0] for c in RECORD.split(", ")])
    return frames.mapInArrow(records, RECORD)


def fetch(folder: str, bundle: str, frame: int, offset: int) -> tuple[dict[str, str], bytes]:
    """One record by its index entry: only its frame is read."""
    import zstandard
    from pyarrow import fs
    store, base = fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
    with store.open_input_file(f"{base}/{bundle}") as f:
        at, size = read_seek_table(f, f.size())[frame]
        f.seek(at)
        return parse_record(zstandard.ZstdDecompressor().decompress(f.read(size)), offset)[:2]


def digest(pages: DataFrame) -> DataFrame:
    """Write all pages, read the archives back; the contract's columns."""
    spark = pages.sparkSession
    folder = shared_path(spark, "warc")
    return read(spark, folder, write(pages, folder)).drop("payload")


ORACLE_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
g AS (SELECT page_id, n, sha256(html) AS d, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY html) END AS first FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
       CASE WHEN first IS NOT NULL AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first IS NOT NULL AND first <> page_id THEN first END AS refers_to
FROM g
"""
