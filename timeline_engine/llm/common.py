"""Shared helpers: input tables, durable intermediate tables, numeric hashing."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, the only separators of words in every operator here.
WS_CLASS = r"\x20\x09-\x0D"
WORD_PATTERN = rf"[^{WS_CLASS}]+"
WS_CHARS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

_LOCAL_DIR: dict[str, str] = {}


def own(df: DataFrame, *without: str, at: str = "") -> list[Column]:
    """The columns of ``df`` whatever their names hold, without some (in any
    case); ``at`` is an alias before them."""
    gone = {w.lower() for w in without}
    return [F.col(f"{at + '.' if at else ''}`{c.replace('`', '``')}`") for c in df.columns if c.lower() not in gone]


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores as make it new to ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme of the file system that Spark takes it for."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    full = system.makeQualified(where).toString()
    return "file://" + full.removeprefix("file:") if full.startswith("file:/") and not full.startswith("file://") else full


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``.

    Where the setting is absent, a temporary folder serves a local master
    only; on a cluster a missing setting is an error, since executors could
    not see each other's files.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return _qualified(spark, named.rstrip("/"))
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
    if "dir" not in _LOCAL_DIR:
        _LOCAL_DIR["dir"] = tempfile.mkdtemp(prefix="timeline_engine_")
        atexit.register(shutil.rmtree, _LOCAL_DIR["dir"], ignore_errors=True)
    return "file://" + _LOCAL_DIR["dir"]


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def delete_at_end(spark: SparkSession, path: str) -> None:
    """Marks an existing path for deletion when the driver's JVM ends."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)


def delete_now(spark: SparkSession, path: str) -> None:
    """Deletes a table that no later plan reads."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: lineage ends there, lost
    executors cost a reread, and the planner knows the table's real size."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    delete_at_end(df.sparkSession, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def by_ranges(df: DataFrame, rows: int, most: int, *columns: str) -> DataFrame:
    """``df`` range-partitioned by ``columns``: into the session's number of
    partitions, or more where its ``rows`` would fill them beyond ``most``."""
    wanted = -(-rows // most)
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(wanted, *columns) if wanted > usual else df.repartitionByRange(*columns)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int):
    """Queries run inside use Arrow batches of at most ``rows`` rows."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser over an array of unsigned 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_IS_WORD = np.ones(256, bool)
_IS_WORD[[32, *range(9, 14)]] = False
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64)) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    """The first n powers of an odd base and of its inverse, modulo 2^64."""
    if len(_POWERS[0]) < n:
        size = max(1 << 14, 2 * n)
        for k, x in enumerate((_BASE, pow(_BASE, -1, 2**64))):
            steps = np.full(size, x, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS


def word_hashes(text: bytes) -> np.ndarray:
    """Unsigned 64-bit hashes of a text's words, in order.

    A word's hash is a polynomial in random values of its bytes, read off one
    running sum over the text, then mixed with its length.
    """
    a = np.frombuffer(text, np.uint8)
    edge = np.diff(_IS_WORD[a].view(np.int8), prepend=np.int8(0), append=np.int8(0))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = _powers(len(a) + 1)
    total = np.zeros(len(a) + 1, np.uint64)
    np.cumsum(_BYTE[a] * up[: len(a)], out=total[1:])
    return mix64((total[end] - total[start]) * down[start] ^ (end - start).astype(np.uint64))


def ngram_hashes(word_hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n-word windows, in order (none if there are fewer words)."""
    size = len(word_hashes) - n + 1
    if size <= 0:
        return np.empty(0, np.uint64)
    acc = word_hashes[:size].copy()
    for k in range(1, n):
        acc *= np.uint64(0x9E3779B97F4A7C15)
        acc += word_hashes[k : k + size]
        acc ^= acc >> np.uint64(29)
    return mix64(acc)
