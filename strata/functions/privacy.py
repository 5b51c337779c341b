"""Column masking and row restriction flags."""
from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .cleanse import as_col, is_blank


def mask(c, salt: str | None = None) -> Column:
    """SHA-256 hex digest of the value (optionally salted); null stays null."""
    c = as_col(c).cast("string")
    if salt:
        c = F.concat(F.lit(salt), c)
    return F.sha2(c, 256)


def restricted_flag(c, values: Iterable[str] = ("No Insurance",)) -> Column:
    """True when the value is null, blank or one of ``values``; never null."""
    c = as_col(c)
    return F.coalesce(is_blank(c) | c.isin(list(values)), F.lit(True))
