"""CSV folders whose files have unlike headers.

The first line of every file is read once; files with the same header are one
scan, and the scans are aligned by column name into one plan.  Nothing else of
the files is read before the query runs.  The driver holds one header per file,
as it holds the file list of any scan.
"""
from __future__ import annotations

import csv
import re
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .files import CORRUPT, IngestError, read_raw
from .schema import column_names

READERS = 16        # headers read at a time


def data_files(spark: SparkSession, path: str) -> list[str]:
    """Files below ``path`` in order of their names; hidden ones and markers left out."""
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    found, it = [], p.getFileSystem(sc._jsc.hadoopConfiguration()).listFiles(p, True)
    root = len(path.rstrip("/").split("/"))
    while it.hasNext():
        f = it.next().getPath().toString()
        if not any(x.startswith((".", "_")) for x in f.rstrip("/").split("/")[root:]):
            found.append(f)
    return sorted(found)


def first_line(spark: SparkSession, path: str) -> str | None:
    """First line of a (maybe compressed) text file; ``None`` if it is empty."""
    sc = spark.sparkContext
    jvm, conf = sc._jvm, sc._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    stream = p.getFileSystem(conf).open(p)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(p)
        if codec is not None:
            stream = codec.createInputStream(stream)
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
    finally:
        stream.close()


def file_headers(spark: SparkSession, path: str, sep: str = ",") -> dict[str, list[str]]:
    """File -> its column names as written (none for an empty file)."""
    files = data_files(spark, path)
    with ThreadPoolExecutor(READERS) as pool:
        lines = list(pool.map(lambda f: first_line(spark, f), files))
    # a byte order mark is not part of the first name
    return {f: next(csv.reader([x.removeprefix("\ufeff")], delimiter=sep), []) if x else [] for f, x in zip(files, lines)}


def read_mixed(spark: SparkSession, path: str, sep: str = ",", on_reject=None) -> DataFrame:
    """All CSV files below ``path`` as one frame of strings, aligned by name.

    Column names are normalised first (``column_names``), so ``Unit Price`` and
    ``unit_price`` of two files are one column; the order is that of first
    appearance.  A file lacks a column: null.  ``source_file`` names each row's
    file, ``_corrupt_record`` holds rows that don't fit their own file's header.
    Files without a first line, or whose header names a column twice, go to
    ``on_reject(file, reason)``; without any usable file, IngestError.
    """
    layouts: dict[tuple[str, ...], list[str]] = {}
    for f, names in file_headers(spark, path, sep).items():
        reason = None if names else "no header"
        try:
            column_names(names)
        except ValueError as e:
            reason = str(e)
        if reason is None:
            layouts.setdefault(tuple(names), []).append(f)
        elif on_reject:
            on_reject(f, reason)
    if not layouts:
        raise IngestError(f"{path} holds no file with a header")
    out = None
    for names, files in layouts.items():
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
        plain = [re.sub(r"([\\\[\]{}*?])", r"\\\1", f) for f in files]         # names, not patterns
        raw = read_raw(spark, plain, "csv", schema=schema, sep=sep)
        columns = [F.col(f"`{n}`").alias(c) for n, c in zip(names, column_names(names))]
        part = raw.select(*columns, CORRUPT, F.col("_metadata.file_path").alias("source_file"))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out.select(*[c for c in out.columns if c not in (CORRUPT, "source_file")], CORRUPT, "source_file")
