"""Layers stored by key: bucketed and sorted files, so that grouping or joining by the key needs no exchange.

A key's rows lie in one bucket, so what looks for repeated keys, or compares two such layers by key, reads buckets side by side and
shuffles nothing. The shuffle is paid once, when the layer is written. Buckets are a fixed number for the life of a table: choose it
so that a bucket is a task's worth at the size the table will have.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

BUCKET_BYTES = 256 << 20


def buckets_for(total_bytes: int, bucket_bytes: int = BUCKET_BYTES) -> int:
    """A power of two, so that tables of different size can be joined bucket by bucket."""
    n = max(1, -(-total_bytes // bucket_bytes))
    return 1 << (n - 1).bit_length()


def write_bucketed(df: DataFrame, table: str, keys: Sequence[str] | str, buckets: int, path: str | None = None) -> DataFrame:
    """Write a catalog table of Parquet files, bucketed and sorted by the keys; one file for each bucket."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    writer = (df.repartition(buckets, *keys).write.mode("overwrite").format("parquet")
              .bucketBy(buckets, keys[0], *keys[1:]).sortBy(keys[0], *keys[1:]))
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return read_bucketed(df.sparkSession, table)


def read_bucketed(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)


def compare_bucketed(left: DataFrame, right: DataFrame, keys: Sequence[str] | str) -> DataFrame:
    """Rows of both sides by key, NULL where a side lacks it: a merge of buckets without an exchange where both are bucketed by
    the keys into the same number. Columns are ``l_...`` and ``r_...``; NULL keys match nothing."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    l, r = (df.select(*keys, *[df[c].alias(f"{p}_{c}") for c in df.columns if c not in keys]) for df, p in ((left, "l"), (right, "r")))
    return l.join(r.hint("merge"), keys, "full_outer")
