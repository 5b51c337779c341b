"""Layout rewrites: small-file compaction and multi-column (Z-order) clustering."""
from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FILE_BYTES = 128 << 20      # aimed size of a file
SAMPLE_ROWS = 4096          # rows (a uniform sample) that range bounds are taken from


def files_for(size: int, file_bytes: int = FILE_BYTES) -> int:
    return max(1, math.ceil(size / file_bytes))


def compact(df: DataFrame, num_files: int) -> DataFrame:
    """Rewrite into evenly sized files (round-robin shuffle, no skew)."""
    return df.repartition(num_files)


def range_bounds(df: DataFrame, cols: Sequence[str], bits: int) -> list[list]:
    """Per column, values that cut a uniform sample into up to 2^bits even parts."""
    rows = df.select(*cols).orderBy(F.rand(seed=42)).limit(SAMPLE_ROWS).collect()
    out, n = [], 1 << bits
    for i in range(len(cols)):
        seen = sorted(r[i] for r in rows if r[i] is not None)
        out.append(sorted({seen[len(seen) * k // n] for k in range(1, n)}) if seen else [])
    return out


def spread(number: int, bits: int, step: int, place: int) -> int:
    """``number`` with its bits ``step`` apart, the lowest one at ``place``."""
    return sum((number >> b & 1) << (b * step + place) for b in range(bits))


def zorder_key(df: DataFrame, cols: Sequence[str], bits: int = 6, bounds: Sequence[Sequence] | None = None) -> Column:
    """Morton order of the columns' places among their bounds: order-preserving
    for columns of any type, so outliers and common prefixes don't matter; nulls
    come first.  A place is found by halving: each step compares with one element
    of the column's array of bounds, so the expression grows with ``bits`` and its
    compiled method stays small enough to be compiled to machine code (a tree of
    all bounds, nested in one method, is interpreted).  ``bounds`` of an earlier
    ``range_bounds`` keep the key the same over loads."""
    bounds = range_bounds(df, cols, bits) if bounds is None else bounds
    z = F.lit(0).cast("long")
    for i, (c, cuts) in enumerate(zip(cols, bounds)):
        if not cuts:
            continue
        kind, halvings = df.schema[c].dataType, len(cuts).bit_length()
        # as many bounds as places less one; comparing with a null one is not true
        at = F.array(*[F.lit(x).cast(kind) for x in [*cuts, *[None] * ((1 << halvings) - 1 - len(cuts))]])
        place = F.lit(0)
        for step in (1 << h for h in reversed(range(halvings))):
            above = F.coalesce(F.col(c) >= F.get(at, place + F.lit(step - 1)), F.lit(False))
            place = place + above.cast("int") * F.lit(step)
        leaves = F.array(*[F.lit(spread(n, bits, len(cols), i)).cast("long") for n in range(1 << halvings)])
        z = z.bitwiseOR(F.get(leaves, place))
    return z


def free_name(df: DataFrame, name: str) -> str:
    """``name``, longer by underscores until no column has it."""
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


def cluster_by(df: DataFrame, cols: Sequence[str], num_files: int, key: Column | None = None) -> DataFrame:
    """Range-partition and sort by the Z-order key so each output file covers
    a compact box of the clustering columns (tight Parquet min/max stats for
    data skipping).  A row hash as second range column splits rows that share
    one key over files.  ``key`` is a Z-order key already at hand.  Neither helper
    column is kept."""
    z, h = free_name(df, "__z"), free_name(df, "__h")
    keyed = df.withColumn(z, zorder_key(df, cols) if key is None else key).withColumn(h, F.xxhash64(*df.columns))
    return keyed.repartitionByRange(num_files, z, h).sortWithinPartitions(z, *cols).drop(z, h)
