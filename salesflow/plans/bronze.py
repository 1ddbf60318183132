"""CSV landing files -> bronze Parquet, with rejected rows kept aside and a size report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.layers import bronze_landing, bronze_rejects, to_bronze
from ..sources.files import raw_sales_csv, storage_report, write_parquet


def ingest_bronze(spark: SparkSession, csv_path: str, bronze_path: str,
                  rejects_path: str | None = None) -> DataFrame:
    """Type the CSV (read as text, declared schema, no inference pass) into bronze Parquet.

    With ``rejects_path``, rows whose text did not survive typing are written there too, raw.
    That is a second pass over the text; it only filters, and writes few rows. Returns the storage
    report of the CSV against the bronze files. ``ingest_landing`` needs no second pass.
    """
    raw = raw_sales_csv(spark, csv_path)
    write_parquet(to_bronze(raw), bronze_path)
    if rejects_path:
        write_parquet(bronze_rejects(raw), rejects_path)
    return storage_report(spark, csv_path, bronze_path)


def ingest_landing(spark: SparkSession, csv_path: str, landing_path: str) -> DataFrame:
    """The CSV typed into one Parquet landing of good and rejected rows, read and written once; the storage report.

    ``operators.layers.landing_bronze`` and ``landing_rejects`` read the two kinds back.
    """
    write_parquet(bronze_landing(raw_sales_csv(spark, csv_path)), landing_path)
    return storage_report(spark, csv_path, landing_path)
