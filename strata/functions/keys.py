"""Deterministic surrogate keys."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .cleanse import as_col


def hash_key(*cols) -> Column:
    """64-bit key from the business key columns, computed row-locally.

    ``xxhash64`` skips null inputs, so ``(null, 'a')`` and ``('a', null)`` would
    collide; each value is therefore tagged with its null-ness first.  No
    shuffle, no dependence on partitioning: the same row gets the same key in
    every run and in every table that computes it.
    """
    return F.xxhash64(*_tagged(cols))


def wide_key(*cols) -> Column:
    """128-bit key (32 hex digits) from the business key columns, row-locally.

    Two 64-bit hashes that start from different seeds.  Of 10**10 keys two meet
    with a chance of 10**-19; with ``hash_key`` about three pairs would."""
    tagged = _tagged(cols)
    parts = [F.xxhash64(*tagged), F.xxhash64(F.lit("second seed"), *tagged)]
    return F.concat(*[F.lpad(F.hex(h), 16, "0") for h in parts])


def _tagged(cols) -> list[Column]:
    tagged = []
    for c in cols:
        c = as_col(c)
        tagged += [c.isNull(), F.coalesce(c.cast("string"), F.lit(""))]
    return tagged
