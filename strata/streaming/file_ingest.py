"""Incremental file ingestion with Structured Streaming.

A file-source stream remembers in its checkpoint which files it has read, so
running the job again picks up only files that arrived since - each file is
ingested exactly once, with no bookkeeping of our own.  ``availableNow``
processes everything pending in bounded micro-batches and stops, which suits
scheduled batch jobs.  Each micro-batch is split into good and corrupt rows,
deduplicated on the business key and upserted into the table; replaying a
batch after a failure upserts the same rows again and replaces its own rejected
rows, so the result is the same.
"""
from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.dedup import latest_per_key
from ..sources.files import CORRUPT, split_corrupt
from ..sources.quarantine import envelope, quarantine
from ..sources.tables import TableStore, create_or_upsert


def ingest_files(spark: SparkSession, source_dir: str, schema: T.StructType, store: TableStore,
                 table: str, keys: Sequence[str], checkpoint: str, *, fmt: str = "csv",
                 max_files_per_trigger: int | None = None,
                 transform: Callable[[DataFrame], DataFrame] | None = None,
                 options: dict | None = None,
                 partition: Callable[[], Column] | None = None) -> int:
    """Ingest every file not seen before under ``source_dir``; returns the
    number of micro-batches that carried rows.  With ``partition`` (an
    expression of the key) each micro-batch rewrites only the partitions it
    touches; without it the table is rewritten per batch."""
    if CORRUPT not in schema.fieldNames() and fmt in ("csv", "json"):
        schema = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    reader = (spark.readStream.schema(schema).format(fmt)
                   .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT))
    if fmt == "csv":
        reader = reader.option("header", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    stream = reader.load(source_dir).withColumn("source_file", F.col("_metadata.file_path"))
    batches = []

    def upsert_batch(df: DataFrame, epoch_id: int) -> None:
        good, bad = split_corrupt(df)
        batch = f"{table}-epoch-{epoch_id}"
        quarantine(envelope(bad, "bronze", "parse_error", F.col("source_file"), batch), store.root, batch, "parse")
        if transform is not None:
            good = transform(good)
        if not good.take(1):
            return
        rest = [c for c in good.columns if c not in keys]
        deduped = latest_per_key(good, list(keys), ["source_file"] if "source_file" in rest else [])
        create_or_upsert(store, table, deduped, list(keys), partition() if partition is not None else None)
        batches.append(epoch_id)

    q = (stream.writeStream.foreachBatch(upsert_batch)
               .option("checkpointLocation", checkpoint)
               .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return len(batches)
