"""Corpus pipeline over ``documents``: every stage works on all its predecessor kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet in the shared folder and read again as the next stage's docs.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import line_crf, mixing, ngram_join, piece_codec, secret_scan
from strata.llm.common import staged, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier accepts (score of 0.5 or more)."""
    fitted = line_crf.fit(docs, table(spark, sf_dir, "labels"))
    return line_crf.score(docs, fitted).filter("score >= 0.5").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones; documents without words stay."""
    return ngram_join.one_per_component(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret in their texts replaced."""
    out = secret_scan.scan_documents(docs, redact=True)
    chars = F.when(F.size("spans") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", chars).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in the words that the mix gives them, a row per epoch."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document and the text that they decode to."""
    out = piece_codec.round_trip(docs.drop("n_chars"), piece_codec.tokenizer_path())
    return out.withColumn("n_tokens", F.size("piece_ids").cast("bigint"))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("mix_sources", mix_sources),
    ("encode", encode),
]

# The line labels, the similarity join and the decoding worklist have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
