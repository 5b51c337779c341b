"""Shared helpers: table reading, shared-folder staging and vectorised words.

The word helpers work on the UTF-8 bytes of a whole Arrow batch at once: word
separators are ASCII, so byte positions are enough and no Python loop runs per
word or per document.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from strata.session import cut_lineage, ship_package, shared_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back (cuts lineage).
    Whoever gives the path may ``discard`` it later."""
    path = path or shared_dir(df.sparkSession, "llm", name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a staged folder that no frame reads any more."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def free_unused(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files and checkpoints of frames that are gone: it
    does so once the driver's JVM has collected them, which takes long where the
    driver makes little garbage."""
    spark.sparkContext._jvm.System.gc()


BATCH_BYTES = 4 << 20       # of the Arrow batches that tasks get, if the session names no other bound
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def map_arrow(df: DataFrame, run, schema) -> DataFrame:
    """``df.mapInArrow(run, schema)`` with this package on the executors, batches
    bounded by bytes, and the worker's free memory given back after each task."""
    spark = df.sparkSession
    ship_package(spark)
    if spark.conf.get(_BATCH_CONF, None) is None:
        spark.conf.set(_BATCH_CONF, str(BATCH_BYTES))

    def task(batches):
        try:
            yield from run(batches)
        finally:
            release()

    return df.mapInArrow(task, schema)


def release() -> None:
    """Give freed memory of this Python worker back to the system, so that
    workers kept for the next task don't hold the peak of the last one."""
    import ctypes
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


# -- vectorised words ---------------------------------------------------------
_SEP = np.zeros(256, bool)
_SEP[[9, 10, 11, 12, 13, 32]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_BASE = 0x9E3779B97F4A7C15 | 1          # odd, so invertible modulo 2**64
_INV = pow(_BASE, -1, 1 << 64)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes (every input bit reaches every output bit)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POWERS.get("b")
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        for name, base in (("b", _BASE), ("i", _INV)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _POWERS[name] = np.multiply.accumulate(p)
    return _POWERS["b"], _POWERS["i"]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    column = column.cast(pa.large_string()).fill_null("")
    off = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    buf = column.buffers()[2]
    data = np.frombuffer(buf, np.uint8) if buf is not None and buf.size else np.zeros(0, np.uint8)
    if not len(off):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    return data[off[0]:off[-1]], off - off[0]


def text_groups(off: np.ndarray, size: int = 1 << 20):
    """Cut documents into runs (first, last) of about ``size`` bytes; a longer
    document is a run of its own.  Keeps the work arrays small."""
    n, a = len(off) - 1, 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + size, "right")) - 1)
        yield a, min(b, n)
        a = min(b, n)


def span_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of every ``data[start:end]``, from one running sum."""
    power, inverse = _powers(len(data) + 1)
    run = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * power[:len(data)], out=run[1:])
    h = (run[end] - run[start]) * inverse[start]
    return mix64(h + (end - start).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))


def word_spans(data: np.ndarray, off: np.ndarray):
    """Words of documents: (document of each word, start, end), byte positions."""
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = ~_SEP[data]
    begin = inside[:-1].copy()
    begin[1:] &= ~inside[:-2]
    cut = off[1:-1]
    cut = cut[cut < len(data)]
    begin[cut] = inside[cut]
    finish = inside[:-1] & ~inside[1:]
    last = off[1:-1][off[1:-1] > 0] - 1
    finish[last] = inside[last]
    start, end = np.flatnonzero(begin), np.flatnonzero(finish) + 1
    return np.searchsorted(off, start, "right") - 1, start, end


def fold(data: np.ndarray) -> np.ndarray:
    """Lower-case A-Z, byte by byte."""
    return _FOLD[data]


__all__ = ["DataFrame", "LOWER", "SparkSession", "UPPER", "WORD", "cut_lineage", "discard", "fold", "free_unused", "map_arrow", "mix64", "release",
           "shared_dir", "span_hash", "staged", "table", "text_bytes", "text_groups", "word_spans"]
