"""Sales-shaped views over the driver's test tables.

Each view reads a whole table and renames/derives columns into the sale shape
(id_transaccion, tienda_id, [producto_id,] monto, fecha); nothing is sampled or capped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def sales_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1: one sale per event; store = user_id % 100 + 1; error events become refunds (negative)."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").alias("id_transaccion"),
        (F.col("user_id") % 100 + 1).alias("tienda_id"),
        F.when(F.col("event_type") == "error", -F.col("value")).otherwise(F.col("value")).alias("monto"),
        F.col("ts").alias("fecha"),
    )


def sales_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V2: one sale per line item; store = supplier, product = part; ids are not unique."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id_transaccion"),
        F.col("l_suppkey").alias("tienda_id"),
        F.col("l_partkey").alias("producto_id"),
        F.col("l_extendedprice").alias("monto"),
        F.col("l_shipdate").alias("fecha"),
    )


def sales_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V3: one sale per order; store = o_custkey % 100 + 1; ids unique."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("id_transaccion"),
        (F.col("o_custkey") % 100 + 1).alias("tienda_id"),
        F.col("o_totalprice").alias("monto"),
        F.col("o_orderdate").alias("fecha"),
    )
