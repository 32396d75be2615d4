"""Written intermediate tables under the shared checkpoint folder.

The warehouse star is built once per input snapshot and read back by every
serving query (the reference materialises its star the same way).  The
table name carries a fingerprint of the input files (name, size, mtime) and
of the code version, so a changed input never reads a stale table.  All file
system calls go through Hadoop's FileSystem API, so the folder may be HDFS,
S3 or a local path alike.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from terroir.session import ensure_checkpoint_dir

def _code_version() -> str:
    """Hash of this package's sources: any code change invalidates the
    written tables (no stale star after an operator change)."""
    import os
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    h = hashlib.sha1()
    for d, _, files in sorted(os.walk(root)):
        for f in sorted(files):
            if f.endswith(".py"):
                with open(os.path.join(d, f), "rb") as fh:
                    h.update(fh.read())
    return h.hexdigest()[:12]


CODE_VERSION = _code_version()


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def _snapshot(spark: SparkSession, fs, path) -> str:
    """One token for all files below ``path``: a single JVM call returns the
    tree's file count and bytes, then only directories are visited, for their
    newest change (a file added, replaced or removed anywhere moves one of them)."""
    summary = fs.getContentSummary(path)
    marks = [f"{summary.getFileCount()}:{summary.getDirectoryCount()}:{summary.getLength()}"]
    folders = [fs.getFileStatus(path)]
    while folders:
        st = folders.pop()
        marks.append(f"{st.getPath().toString()}:{st.getModificationTime()}")
        if st.isDirectory() and summary.getDirectoryCount() > 1:
            folders += [x for x in fs.listStatus(st.getPath()) if x.isDirectory()]
    return "|".join(sorted(marks))


def fingerprint(spark: SparkSession, sf_dir: str, names: list[str]) -> str:
    import os
    h = hashlib.sha1((CODE_VERSION + os.environ.get("TERROIR_BUILD_SALT", "")).encode())
    for n in sorted(names):
        path = f"{sf_dir.rstrip('/')}/{n}.parquet"
        fs, p = _fs(spark, path)
        if not fs.exists(p):
            h.update(f"{n}:missing".encode())
            continue
        h.update(_snapshot(spark, fs, p).encode())
    h.update(sf_dir.encode())
    return h.hexdigest()[:16]


def materialized(spark: SparkSession, name: str, key: str, build: Callable[[], DataFrame],
                 sort_by: list[str] | None = None) -> DataFrame:
    """Write ``build()`` once to <checkpoint dir>/terroir/<name>-<key> and read
    it back.  ``sort_by`` sorts each file by those columns, so Parquet
    row-group min/max statistics let pushed filters (e.g. one period) skip
    row groups — no extra shuffle and no small-file partition directories."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    final = f"{base}/terroir/{name}-{key}"
    if not exists(spark, f"{final}/_SUCCESS"):
        tmp = f"{final}.tmp-{uuid.uuid4().hex[:8]}"
        df = build()
        if sort_by:
            df = df.sortWithinPartitions(*sort_by)
        df.write.mode("overwrite").parquet(tmp)
        fs, src = _fs(spark, tmp)
        _, dst = _fs(spark, final)
        if not fs.exists(dst):
            fs.rename(src, dst)
        else:  # another writer won the race; its table is identical
            fs.delete(src, True)
    return spark.read.parquet(final)


def complete_children(spark: SparkSession, path: str) -> list[str]:
    """Names of the written tables (folders with a success marker) below ``path``, sorted."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()]
    return sorted(n for n in names if exists(spark, f"{path.rstrip('/')}/{n}/_SUCCESS"))


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)
