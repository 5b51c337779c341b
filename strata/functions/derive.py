"""Derived columns: day differences, banding, calendar parts."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .cleanse import as_col

_UNSET = object()


def day_diff(end, start) -> Column:
    """Whole days from ``start`` to ``end`` (negative when end precedes start)."""
    return F.datediff(as_col(end), as_col(start))


def band(c, bounds: Sequence, labels: Sequence[str], null_label=_UNSET) -> Column:
    """Label by ascending upper bounds: ``v < bounds[i] -> labels[i]``, else the
    last label.  ``len(labels) == len(bounds) + 1``.

    A null input gets ``null_label`` (default ``'Unknown'``); pass
    ``null_label=None`` to let nulls fall through to the last label the way a
    bare ``when`` chain does.
    """
    if len(labels) != len(bounds) + 1:
        raise ValueError("band needs exactly one more label than bounds")
    c = as_col(c)
    expr = None
    if null_label is _UNSET:
        null_label = "Unknown"
    if null_label is not None:
        expr = F.when(c.isNull(), F.lit(null_label))
    for b, lab in zip(bounds, labels):
        expr = F.when(c < F.lit(b), F.lit(lab)) if expr is None else expr.when(c < F.lit(b), F.lit(lab))
    return expr.otherwise(F.lit(labels[-1]))
