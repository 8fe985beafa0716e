"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on every row of ``docs``; all
but the last return the columns of ``docs``.  ``n_chars`` follows the text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlake.llm import ngram_join, packing, pii, quality, substring_dedup
from flightlake.session import configure, materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _recounted(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the base rules or the outlier test reject."""
    return quality.keep_good(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, Jaccard 0.8) stays."""
    return ngram_join.one_of_each(docs, size=5, percent=80)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of sequences that occur again are removed; other texts stay as they are."""
    cleaned = substring_dedup.remove_repeats(docs)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    return _recounted(cleaned.withColumn("text", text).select(*docs.columns))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes the name of its kind in brackets."""
    return _recounted(pii.mask_pii(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the training sequences."""
    return packing.pack(docs)


def _configured(stage: Stage) -> Stage:
    """A stage that may be called by itself, under the session settings it needs."""
    return lambda spark, docs, sf_dir: stage(configure(spark), docs, sf_dir)


STAGES = [
    (name, _configured(stage))
    for name, stage in (
        ("quality rules", keep_good),
        ("near duplicates", drop_near_duplicates),
        ("substring dedup", drop_repeats),
        ("personal data", mask_personal_data),
        ("packing", pack),
    )
]

# SQL has no loopy message passing, best-fit packing or components to a fixed point.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = configure(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        if number:
            docs = materialize(docs, "stage")
        docs = stage(spark, docs, sf_dir)
    return docs
