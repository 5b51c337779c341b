"""Views for readers without access to restricted rows."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def public_view(df: DataFrame, flag: str = "_is_restricted",
                drop: Sequence[str] = ()) -> DataFrame:
    """Rows not restricted, without the flag and any raw-PII columns."""
    return df.filter(~F.coalesce(F.col(flag), F.lit(True))).drop(flag, *drop)


def not_null_view(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNotNull())
