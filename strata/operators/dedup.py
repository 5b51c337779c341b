"""Deduplication: full rows, any survivor per key, latest row per key."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup_rows(df: DataFrame) -> DataFrame:
    """Distinct full rows (hash aggregate with map-side combine)."""
    return df.dropDuplicates()


def dedup_any(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One arbitrary survivor per key (what ``dropDuplicates(keys)`` gives).

    Use :func:`latest_per_key` when the survivor must be reproducible.
    """
    return df.dropDuplicates(list(keys))


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                   ascending: bool = False) -> DataFrame:
    """Keep one row per ``keys``: the greatest by ``order`` (or least with
    ``ascending``), ties broken by all remaining columns, so the survivor is
    fully deterministic.

    Written as ``max(struct(order..., rest...))`` grouped by the key rather than
    ``row_number()`` over a window: the aggregate combines map-side, so a key
    holding a third of all rows is reduced to one row per map task before the
    shuffle, while a window would sort that whole key inside one task.
    Semantics equal ``row_number() over (partition by keys order by order
    desc nulls last, rest desc nulls last) = 1`` (``asc nulls first`` when
    ``ascending``).
    """
    keys, order = list(keys), list(order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c) for c in order + rest])
    pick = F.min(packed) if ascending else F.max(packed)
    r = F.col("__pick")
    return (df.groupBy(*keys).agg(pick.alias("__pick"))
              .select(*[F.col(k) for k in keys], *[r.getField(c).alias(c) for c in order + rest])
              .select(*df.columns))
