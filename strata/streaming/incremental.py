"""High-water-mark incremental loads (batch CDC by load time).

The mark is kept in an append-only Parquet dataset with one row per successful
load: ``(scope, mark, processed_at)``.  The mark has the load column's own type
and goes from the batch to the dataset and from there into the next load's
filter inside Spark plans: no Python value, so no driver time zone, touches it.
An empty batch leaves the mark as it is.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import path_exists


def read_watermark(spark: SparkSession, path: str, scope: str = "all") -> DataFrame | None:
    """One row ``mark`` of the latest load of ``scope`` (null if it has none);
    ``None`` if nothing was ever saved at ``path``."""
    if not path_exists(spark, path):
        return None
    marks = spark.read.parquet(path).filter(F.col("scope") == F.lit(scope))
    return marks.agg(F.max_by("mark", "processed_at").alias("mark"))


def save_watermark(batch: DataFrame, ts_col: str, path: str, scope: str = "all") -> None:
    """Append the greatest ``ts_col`` of ``batch``; an empty batch appends no row."""
    (batch.agg(F.max(ts_col).alias("mark")).filter("mark is not null")
          .select(F.lit(scope).alias("scope"), "mark", F.current_timestamp().alias("processed_at"))
          .write.mode("append").parquet(path))


def incremental_batch(df: DataFrame, ts_col: str, mark: DataFrame | None,
                      exclude: dict[str, str] | None = None) -> DataFrame:
    """Rows loaded after the mark (all, without one), minus excluded sources.

    The filter is a plain comparison with one scalar subquery, so it reaches the
    scan; whether there is a mark is asked first (one row)."""
    out = df
    if mark is not None and not mark.filter("mark is not null").isEmpty():
        out = out.filter(F.col(ts_col) > mark.select("mark").scalar())
    for c, v in (exclude or {}).items():
        out = out.filter(~F.col(c).eqNullSafe(F.lit(v)))
    return out


def slice_filter(df: DataFrame, col: str, value: str | None, all_value: str = "All") -> DataFrame:
    """Case-insensitive equality slice; ``All`` (or None) switches it off."""
    if value is None or value == all_value:
        return df
    return df.filter(F.upper(F.col(col)) == F.lit(value.upper()))
