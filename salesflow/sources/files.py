"""Batch file sources and sinks: CSV, Parquet paths, named sources, storage size."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.jsonfmt import TIMESTAMP_TEXT_FORMAT
from ..schemas import RAW_SALES


def csv_scan(spark: SparkSession, path: str, infer_schema: bool = False,
             schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header line.

    ``schema`` given: no inference pass. ``infer_schema=True``: one extra pass over the files to
    guess types (avoid on large inputs); guessed timestamps are read as TIMESTAMP_NTZ, since
    CSV text carries no zone, so the values do not depend on the session's time zone.
    Otherwise every column is text.
    """
    reader = spark.read.option("header", True)
    if schema is None and infer_schema:
        guessed = reader.option("inferSchema", True).csv(path).schema
        schema = T.StructType([
            T.StructField(f.name, T.TimestampNTZType() if isinstance(f.dataType, T.TimestampType) else f.dataType,
                          f.nullable)
            for f in guessed.fields])
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def raw_sales_csv(spark: SparkSession, path: str) -> DataFrame:
    """Sales CSV as text: columns are found by the header's names, in any order, and all are kept.

    Only the header line is read beforehand (no inference pass). The sale columns come first; a file
    that names the id ``id`` has it as ``id_transaccion``. A file without a needed column fails,
    and so does one whose header differs from that of the other files.
    """
    raw = spark.read.option("header", True).option("enforceSchema", False).csv(path)
    if "id_transaccion" not in raw.columns and "id" in raw.columns:
        raw = raw.withColumnRenamed("id", "id_transaccion")
    missing = [c for c in RAW_SALES.names if c not in raw.columns]
    if missing:
        raise ValueError(f"{path}: the header lacks {', '.join(missing)}")
    return raw.select(*RAW_SALES.names, *[F.col(f"`{c}`") for c in raw.columns if c not in RAW_SALES.names])


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """CSV with header; timestamps written with full microseconds so they round-trip."""
    (df.write.mode(mode).option("header", True)
     .option("timestampNTZFormat", TIMESTAMP_TEXT_FORMAT)
     .option("timestampFormat", TIMESTAMP_TEXT_FORMAT + "XXX")
     .csv(path))
    return path


def parquet_scan(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: list[str] | None = None) -> str:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def parquet_path_sql(spark: SparkSession, path: str, select_list: str, where: str | None = None) -> DataFrame:
    """SQL straight over a Parquet path: ``SELECT <list> FROM parquet.`path` [WHERE ...]``."""
    if "`" in path:
        raise ValueError("path must not contain backquotes")
    sql = f"SELECT {select_list} FROM parquet.`{path}`"
    if where:
        sql += f" WHERE {where}"
    return spark.sql(sql)


def named_source(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> DataFrame:
    """Register a path under a logical name (a session-scoped view) and scan it by that name."""
    if not name.replace("_", "").isalnum() or "'" in path:
        raise ValueError("invalid source name or path")
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} USING {fmt} OPTIONS (path '{path}')")
    return spark.table(name)


def storage_report(spark: SparkSession, source_path: str, target_path: str) -> DataFrame:
    """Bytes on disk of a source and of its converted copy, and the share saved.

    Lists files through the file source (distributed listing, only the ``length`` column is
    read); hidden and ``_``-prefixed files (checksums, markers) are not counted.
    """
    def sizes(path: str, side: str) -> DataFrame:
        return (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
                .select(F.lit(side).alias("side"), F.col("length")))

    both = sizes(source_path, "source").unionByName(sizes(target_path, "target"))
    agg = both.agg(
        F.sum(F.when(F.col("side") == "source", F.col("length"))).alias("source_bytes"),
        F.sum(F.when(F.col("side") == "target", F.col("length"))).alias("target_bytes"),
    )
    return agg.select(
        "source_bytes", "target_bytes",
        F.round(F.col("source_bytes") / F.lit(1024 * 1024), 2).alias("source_mb"),
        F.round(F.col("target_bytes") / F.lit(1024 * 1024), 2).alias("target_mb"),
        F.round((1 - F.try_divide(F.col("target_bytes"), F.col("source_bytes"))) * 100, 2).alias("saved_pct"),
    )
