"""Type coercion, range checks, dates, text case and category whitelists.

Dirty input must never fail a job: every parse is a ``try_*`` form, so an
unparseable value becomes null (the intent of the source pipeline) under the
ANSI mode that Spark 4 enables by default.
"""
from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(c) -> Column:
    """Null, or only whitespace once rendered as text.

    References ``c`` once: filters do not share subexpressions, and Catalyst
    inlines a derived column into every predicate that mentions it.
    """
    return F.coalesce(F.trim(as_col(c).cast("string")), F.lit("")) == F.lit("")


def try_int(c) -> Column:
    """Whole-number text -> int; anything else (``45.7``, ``abc``) -> null."""
    return as_col(c).try_cast("int")


def try_double(c) -> Column:
    return as_col(c).try_cast("double")


def null_out_of_range(c, lo=None, hi=None, lo_inclusive: bool = False,
                      hi_inclusive: bool = True) -> Column:
    """Null out values outside (lo, hi].  Defaults follow the age rule
    ``<= 0 or > 120 -> null``; use ``lo_inclusive`` for ``< 0 -> null``."""
    c = as_col(c)
    bad = F.lit(False)
    if lo is not None:
        bad = bad | ((c < F.lit(lo)) if lo_inclusive else (c <= F.lit(lo)))
    if hi is not None:
        bad = bad | ((c > F.lit(hi)) if hi_inclusive else (c >= F.lit(hi)))
    return F.when(bad, None).otherwise(c)


def parse_date(c, fmt: str = "yyyy-MM-dd") -> Column:
    """Strict date parse; impossible dates (Feb 30) and other layouts -> null."""
    return F.try_to_date(as_col(c).cast("string"), fmt)


def title_case(c) -> Column:
    """``cHaRlEs rOdGeRs`` -> ``Charles Rodgers`` (word starts upper-cased)."""
    return F.initcap(as_col(c))


def canonical(c, allowed: Iterable[str], fold: str | None = "initcap") -> Column:
    """Fold the value (``initcap``/``upper``/``lower``/None) and keep it only
    when it is in the whitelist; otherwise null (to be imputed later)."""
    c = as_col(c)
    folded = {"initcap": F.initcap, "upper": F.upper, "lower": F.lower}.get(fold, lambda x: x)(c) \
        if fold else c
    return F.when(folded.isin(list(allowed)), folded)


def coerce(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast several string columns at once with ``try_cast`` (one projection)."""
    return df.withColumns({name: F.col(name).try_cast(t) for name, t in types.items()})
