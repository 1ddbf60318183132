"""The operators' queries: each applies one operator, with its production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import bytebpe, chat, collocations, convrepair, ctph, langid, lattice, licenses, packing, sharding, simhash, suffixes, urlfilter

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, sf_dir, "documents"))


def op2_simhash_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.repeats(_table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents"))


def op5_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.digest(_table(spark, sf_dir, "conversations"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bytebpe.tokenize(_table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY),
                            public_tokenizers.PATTERN, keep_ids=False)


def op7_embedding_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op8_piecewise_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctph.fingerprints(_table(spark, sf_dir, "documents"))


def op9_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op10_lookup_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(_table(spark, sf_dir, "documents"))


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return convrepair.report(convrepair.damage(_table(spark, sf_dir, "conversations")))


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list is made of the pages' own URLs whose host name has a listed word."""
    pages = _table(spark, sf_dir, "pages")
    return urlfilter.judge(pages, urlfilter.term_urls(pages))


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_license_scan, op2_simhash_pivots, op3_suffix_dedup, op4_language_id, op5_chat_perspectives, op6_byte_bpe,
        op7_embedding_lattice, op8_piecewise_fingerprints, op9_length_buckets, op10_lookup_sharding,
        op11_phrase_collocations, op12_conversation_repair, op13_url_filter)
}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL of the queries that SQL can express; the others are tested by brute force."""
    return {"op5_chat_perspectives": chat.ORACLE, "op9_length_buckets": packing.oracle_sql(),
            "op11_phrase_collocations": collocations.oracle_sql(), "op13_url_filter": urlfilter.oracle_sql()}
