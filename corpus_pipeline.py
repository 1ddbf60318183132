"""The corpus pipeline: documents that have a language, one of each near-duplicate group, repeated passages taken
out, packed into batches.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. ``run`` writes
each stage's result as Parquet in the shared folder and reads it back for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from salesflow.llm import langid, packing, simhash, suffixes
from salesflow.llm.common import stored


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go: no letter, or a score that is hardly better than chance among the languages."""
    return langid.accepted(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by SimHash one document stays, that of the smallest id."""
    return simhash.one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 bytes or more that an earlier document has are taken out of the texts; every document stays."""
    return suffixes.without_repeats(docs, length_col="n_chars")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every kept document's place in a batch."""
    return packing.pack(docs)


STAGES = [
    ("language", identify_language),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("packing", pack),
]

#: The first stages (a trained network, SimHash, suffixes) have no SQL form; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
