"""Row null ratio, threshold split and critical not-null filter."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.cleanse import is_blank


def null_ratio(df: DataFrame, cols: Sequence[str] | None = None,
               count_col: str = "_null_count", pct_col: str = "_null_pct") -> DataFrame:
    """Add the number of null-or-blank values among ``cols`` and its share.

    ``cols`` should name the business columns; metadata columns that are
    never null would dilute the ratio.
    """
    cols = list(cols or df.columns)
    n = None
    for c in cols:
        t = F.when(is_blank(c), 1).otherwise(0)
        n = t if n is None else n + t
    return df.withColumns({count_col: n, pct_col: n / F.lit(len(cols))})


def split_by_null_ratio(df: DataFrame, threshold: float = 0.30,
                        cols: Sequence[str] | None = None,
                        reason: str | None = None,
                        keep_scores: bool = False) -> tuple[DataFrame, DataFrame]:
    """Return ``(clean, quarantined)``.  Rows whose ratio exceeds ``threshold``
    are quarantined with a reason; the rest continue without helper columns.
    Both come from one projection, so callers persist ``df`` once when they
    materialise both sides."""
    scored = null_ratio(df, cols)
    bad = F.col("_null_pct") > F.lit(threshold)
    quarantined = scored.filter(bad).withColumn(
        "quarantine_reason", F.lit(reason or f"null_pct_exceeds_{threshold}"))
    clean = scored.filter(~bad)
    if not keep_scores:
        clean = clean.drop("_null_count", "_null_pct")
    return clean, quarantined


def split_critical(df: DataFrame, cols: Sequence[str],
                   reason: str = "critical_null") -> tuple[DataFrame, DataFrame]:
    """Rows with a null in any critical column go to ``rejected`` with a
    reason instead of vanishing; the others are ``kept``."""
    cols = list(cols)
    any_null = None
    for c in cols:
        t = F.col(c).isNull()
        any_null = t if any_null is None else any_null | t
    kept = df.filter(~any_null)
    rejected = df.filter(any_null).withColumn("quarantine_reason", F.lit(reason))
    return kept, rejected
