"""Key conditions and the unique-key guard of merges.

Join strategies are left to the optimiser: it broadcasts a side by its measured
bytes and splits skewed partitions, at every size by the same plan.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keys_match(left: Sequence[Column], right: Sequence[Column], null_safe: bool = True) -> Column:
    """All key pairs equal; null keys match each other only if ``null_safe``."""
    out = None
    for a, b in zip(left, right, strict=True):
        same = a.eqNullSafe(b) if null_safe else a == b
        out = same if out is None else out & same
    return out


def require_unique(batch: DataFrame, keys: Sequence[str], what: str = "batch") -> None:
    """Raise if a key occurs twice: which row wins would be open."""
    twice = batch.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    row = twice.first()
    if row is not None:
        raise ValueError(f"the {what} holds key {[row[k] for k in keys]} {row['n']} times; deduplicate it first")
