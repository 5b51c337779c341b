"""Key-based upsert (update-all / insert-all merge) without a table format.

One full outer join on the keys reads the target and the batch once each; the
optimiser picks the strategy from their sizes.  Schema evolves both ways:
columns new in the source appear (null in kept target rows); target-only columns
keep their old value on updated rows.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import keys_match, require_unique


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], *, null_safe_keys: bool = True) -> DataFrame:
    """Rows of ``source`` replace target rows with equal ``keys``; other
    source rows are inserted; other target rows are kept.

    ``source`` must hold each key once, else ``ValueError``.  Null keys match
    each other when ``null_safe_keys`` (re-running a load never duplicates
    them); with ``False`` they never match, like SQL ``=``.
    """
    keys = list(keys)
    unique = source if null_safe_keys else source.dropna(subset=keys)
    require_unique(unique, keys, "source")
    t = target.select(F.struct(*target.columns).alias("__t"))
    s = source.select(F.struct(*source.columns).alias("__s"))
    on = keys_match([F.col(f"__t.`{k}`") for k in keys], [F.col(f"__s.`{k}`") for k in keys], null_safe_keys)
    both = t.join(s, on, "full_outer")
    hit = F.col("__s").isNotNull()
    cols = target.columns + [c for c in source.columns if c not in target.columns]

    def value(c):
        if c not in source.columns:
            return F.col(f"__t.`{c}`")
        if c not in target.columns:
            return F.col(f"__s.`{c}`")
        return F.when(hit, F.col(f"__s.`{c}`")).otherwise(F.col(f"__t.`{c}`"))
    return both.select(*[value(c).alias(c) for c in cols])
