"""Partial re-clustering: only files whose ranges overlap too deeply are rewritten.

A table's files are intervals of its clustering curve (the least and greatest
Z-order key of their rows).  The curve's bounds are sampled once and kept beside
the table (``<name>__curve``), so keys mean the same in every load; the intervals
are kept too (``<name>__ranges``), so a run reads the clustering columns of new
files alone - files never change.  The depth at a place of the curve is the
number of files over it.  Files over a place deeper than the limit are read,
clustered and written again; all others keep their names and are not opened.

Defined cases: an interval of one key covers no place between keys, so files full
of one hot key, which no rewrite can tell apart, are not chosen again and again;
files without rows are never chosen; nulls come first on the curve; an empty
table, or one no deeper than the limit, is left as it is; repeated rows stay.
A partitioned table is refused.  The driver holds the list of files, as the
table's pointer does.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import functions as F
from pyspark.sql import types as T

from .layout import FILE_BYTES, cluster_by, files_for, range_bounds, zorder_key

BITS = 6
DEPTH = 2       # files over one place that are left alone


def depths(ranges: Mapping[str, tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(from, to, files) of the stretches between neighbouring ends of intervals,
    by one pass over the sorted ends."""
    change: dict[int, int] = {}
    for lo, hi in ranges.values():
        if lo < hi:
            change[lo] = change.get(lo, 0) + 1
            change[hi] = change.get(hi, 0) - 1
    out, over, ends = [], 0, sorted(change)
    for a, b in zip(ends, ends[1:]):
        over += change[a]
        out.append((a, b, over))
    return out


def too_deep(ranges: Mapping[str, tuple[int, int]], depth: int) -> set[str]:
    """Files over a stretch that more than ``depth`` files share."""
    deep: list[list[int]] = []
    for a, b, n in depths(ranges):
        if n > depth:
            if deep and deep[-1][1] == a:
                deep[-1][1] = b
            else:
                deep.append([a, b])
    hit, at = set(), 0
    # both sides in order of their starts; a stretch is passed once no later file can reach it
    for name, (lo, hi) in sorted(((f, r) for f, r in ranges.items() if r[0] < r[1]), key=lambda x: x[1]):
        while at < len(deep) and deep[at][1] <= lo:
            at += 1
        if at < len(deep) and deep[at][0] < hi:
            hit.add(name)
    return hit


def _curve(store, name: str, table, cols: Sequence[str], bits: int) -> list[list]:
    """Bounds of the clustering columns, sampled at the first run and kept."""
    kept = f"{name}__curve"
    want = f"{bits}:{','.join(cols)}"
    if store.exists(kept):
        rows = sorted(store.read(kept).collect(), key=lambda r: r["place"])       # columns x 2^bits
        if rows and rows[0]["curve"] == want:
            return [[r["bound"] for r in rows if r["col"] == i] for i in range(len(cols))]
    spark = store.spark
    frame = spark.createDataFrame([(want, -1, -1, None)], "curve string, col int, place int, bound string")
    for i, cuts in enumerate(range_bounds(table, cols, bits)):      # values become text as Spark writes them
        kind = T.StructType([T.StructField("place", T.IntegerType()), T.StructField("bound", table.schema[cols[i]].dataType)])
        part = spark.createDataFrame(list(enumerate(cuts)), kind)
        frame = frame.unionByName(part.select(F.lit(want).alias("curve"), F.lit(i).alias("col"), "place",
                                              F.col("bound").cast("string").alias("bound")))
    store.publish(frame, kept)
    return _curve(store, name, table, cols, bits)


def file_ranges(store, name: str, cols: Sequence[str], bits: int = BITS) -> dict[str, tuple[int, int]]:
    """(least, greatest) key of every file; only files not seen before are read."""
    entry = store._entry(name)
    if entry is None:
        raise ValueError(f"table {name!r} does not exist in {store.root}")
    if entry["partition_by"]:
        raise ValueError(f"table {name!r} is partitioned; its files are clustered per partition")
    files = [f for d in entry["folders"] for f in store._files(d)]
    bounds = _curve(store, name, store._frame(name, entry, files), cols, bits)
    kept = f"{name}__ranges"
    want = f"{bits}:{','.join(cols)}"
    known = {}
    if store.exists(kept):
        known = {r["file"]: (r["lo"], r["hi"]) for r in store.read(kept).filter(F.col("curve") == want).collect()}     # files
    fresh = [f for f in files if store._plain(f) not in known]
    if fresh:
        df = store._frame(name, entry, fresh)
        seen = (df.select(zorder_key(df, cols, bits, bounds).alias("z"), F.col("_metadata.file_path").alias("file"))
                  .groupBy("file").agg(F.min("z").alias("lo"), F.max("z").alias("hi")).collect())       # files
        known |= {store._plain(f): (0, 0) for f in fresh} | {store._plain(r["file"]): (r["lo"], r["hi"]) for r in seen}
    mine = {store._plain(f): known[store._plain(f)] for f in files}
    if fresh:
        store.publish(store.spark.createDataFrame([(want, f, *r) for f, r in mine.items()],
                                                  "curve string, file string, lo long, hi long"), kept)
    return mine


def recluster(store, name: str, cols: Sequence[str], *, depth: int = DEPTH, bits: int = BITS,
              file_bytes: int = FILE_BYTES) -> dict[str, int]:
    """Rewrite the files that overlap deeper than ``depth``.  Gives the number of
    files, of rewritten ones, and the greatest depth before."""
    ranges = file_ranges(store, name, cols, bits)
    deepest = max((n for _, _, n in depths(ranges)), default=0)
    hit = too_deep(ranges, depth)
    if hit:
        entry = store._entry(name)
        files = [f for d in entry["folders"] for f in store._files(d)]
        old = [f for f in files if store._plain(f) in hit]
        df = store._frame(name, entry, old)
        key = zorder_key(df, cols, bits, _curve(store, name, df, cols, bits))
        size = sum(store._folder(f)[1] for f in old)
        new = store._write(cluster_by(df, cols, files_for(size, file_bytes), key), name, [])
        store._switch(name, df.schema, [f for f in files if store._plain(f) not in hit] + new, [])
    return {"files": len(ranges), "rewritten": len(hit), "depth": deepest}
