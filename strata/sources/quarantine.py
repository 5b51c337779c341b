"""Quarantine sink with one fixed envelope for every kind of rejected row."""
from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import path_exists

ENVELOPE = T.StructType([
    T.StructField("stage", T.StringType()),
    T.StructField("source_file", T.StringType()),
    T.StructField("reason", T.StringType()),
    T.StructField("row_json", T.StringType()),
    T.StructField("batch_id", T.StringType()),
])
STORED = T.StructType(ENVELOPE.fields + [T.StructField("logged_at", T.TimestampType())])


def envelope(df: DataFrame, stage: str, reason, source_file=None, batch_id: str | None = None) -> DataFrame:
    """Rows of any shape -> ``(stage, source_file, reason, row_json, batch_id,
    logged_at)``; the original row survives as JSON."""
    rsn = reason if not isinstance(reason, str) else F.lit(reason)
    src = F.lit(source_file) if isinstance(source_file, (str, type(None))) else source_file
    return df.select(
        F.lit(stage).alias("stage"), src.cast("string").alias("source_file"), rsn.alias("reason"),
        F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("row_json"),
        F.lit(batch_id).cast("string").alias("batch_id"),
        F.current_timestamp().alias("logged_at"))


def file_event(spark: SparkSession, stage: str, source_file: str, reason: str,
               batch_id: str | None = None) -> DataFrame:
    """A one-row envelope for file-level failures (bad format, empty file)."""
    return (spark.createDataFrame([(stage, source_file, reason, None, batch_id)], ENVELOPE)
                 .withColumn("logged_at", F.current_timestamp()))


def quarantine(rows: DataFrame, root: str, batch_id: str, part: str) -> None:
    """Keep a batch's rejected rows (``part``: which step rejected them).  A
    repeated batch replaces its own rows."""
    rows.write.mode("overwrite").parquet(f"{root}/quarantine/batch={quote(batch_id, safe='')}/part={quote(part, safe='')}")


def read_quarantine(spark: SparkSession, root: str) -> DataFrame:
    if not path_exists(spark, f"{root}/quarantine"):
        return spark.createDataFrame([], STORED)
    return spark.read.schema(STORED).parquet(f"{root}/quarantine").select(*STORED.fieldNames())
