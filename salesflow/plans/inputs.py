"""Inputs of the registered queries, derived by Spark from the driver's tables.

Message and text inputs are built from whole tables. A caller that reads few large files (the test files
hold one row group each, which one task would read) may pass ``partitions`` to spread their rows; by default
nothing is moved. Where a query needs bad records (typing
rejects, quarantine), the bad records are produced by a rule on the data itself (order status,
the ``k`` value inside the event's ``props``), not by sampling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.jsonfmt import TIMESTAMP_TEXT_FORMAT, json_write_options
from ..operators.layers import to_bronze
from ..operators.messages import encode_messages
from ..sources.files import write_csv
from ..sources.testviews import sales_from_events, sales_from_lineitem, sales_from_orders, table


def spread(df: DataFrame, partitions: int | None) -> DataFrame:
    """The rows dealt round-robin over so many partitions, or left as they are for None."""
    return df.repartition(partitions) if partitions else df


def producer_rows(sales: DataFrame) -> DataFrame:
    """Rows as the producer publishes them: the id travels under the name ``id``."""
    return sales.withColumnRenamed("id_transaccion", "id")


def event_messages(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """V1 sales as (key, value) text messages keyed by store."""
    return encode_messages(producer_rows(spread(sales_from_events(spark, sf_dir), partitions)))


def lineitem_messages(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """V2 sales (with product) as (key, value) text messages keyed by store."""
    return encode_messages(producer_rows(spread(sales_from_lineitem(spark, sf_dir), partitions)))


def damaged_event_messages(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """V1 messages where the event's ``props.k`` picks a kind of damage.

    k = 0: text that is not JSON; k = 1: NULL value (tombstone); k = 2: empty value;
    k = 3: a JSON array; k = 4: amount sent as a string. Other rows are intact.
    """
    ev = spread(table(spark, sf_dir, "events"), partitions)
    k = F.get_json_object("props", "$.k").cast("int")
    store = F.col("user_id") % 100 + 1
    amount = F.when(F.col("event_type") == "error", -F.col("value")).otherwise(F.col("value"))

    def as_json(monto):
        return F.to_json(F.struct(F.col("event_id").alias("id"), store.alias("tienda_id"),
                                  monto.alias("monto"), F.col("ts").alias("fecha")),
                         json_write_options())

    value = (F.when(k == 0, F.lit("not json"))
             .when(k == 1, F.lit(None).cast("string"))
             .when(k == 2, F.lit(""))
             .when(k == 3, F.lit("[]"))
             .when(k == 4, as_json(amount.cast("string")))
             .otherwise(as_json(amount)))
    return ev.select(store.cast("string").alias("key"), value.alias("value"))


def damaged_raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V3 as raw text, with amounts of pending orders ('P') sent as the word 'pending' and the
    dates of urgent finished orders sent as 'sin fecha'."""
    o = table(spark, sf_dir, "orders")
    bad_amount = F.col("o_orderstatus") == "P"
    bad_date = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F")
    return o.select(
        F.col("o_orderkey").cast("string").alias("id_transaccion"),
        (F.col("o_custkey") % 100 + 1).cast("string").alias("tienda_id"),
        F.when(bad_amount, F.lit("pending")).otherwise(F.col("o_totalprice").cast("string")).alias("monto"),
        F.when(bad_date, F.lit("sin fecha")).otherwise(F.col("o_orderdate").cast("string")).alias("fecha"),
    )


def orders_csv(spark: SparkSession, sf_dir: str, path: str, partitions: int | None = None) -> str:
    """V3 written as a CSV folder with a header (the raw landing files of bronze)."""
    return write_csv(spread(sales_from_orders(spark, sf_dir), partitions), path)


def damaged_orders_csv(spark: SparkSession, sf_dir: str, path: str) -> str:
    """The damaged order text as a CSV folder with a header."""
    return write_csv(damaged_raw_orders(spark, sf_dir), path)


def drifted_orders_csv(spark: SparkSession, sf_dir: str, path: str) -> str:
    """V3 as a later CSV that drifted: ids of urgent orders beyond INT, half stores and the word 'pending' in pending orders,
    no date, and two more columns."""
    o = table(spark, sf_dir, "orders")
    pending, store = F.col("o_orderstatus") == "P", (F.col("o_custkey") % 100 + 1).cast("string")
    return write_csv(o.select(
        F.col("o_orderpriority").alias("prioridad"),
        F.when(pending, F.lit("pending")).otherwise(F.col("o_totalprice").cast("string")).alias("monto"),
        (F.col("o_orderkey") + F.when(F.col("o_orderpriority") == "1-URGENT", 3_000_000_000).otherwise(0)).alias("id_transaccion"),
        F.when(pending, F.concat(store, F.lit(".5"))).otherwise(store).alias("tienda_id"),
        F.col("o_custkey").alias("cliente")), path)


def damaged_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The damaged order text, typed: pending orders have no amount, urgent finished ones no date."""
    return to_bronze(damaged_raw_orders(spark, sf_dir))


def clashing_orders(spark: SparkSession, sf_dir: str, path: str) -> str:
    """V3 as a Parquet folder whose files disagree: the order key modulo 5 tells how its amount and date are written.

    0: amount INT (whole units); 1: amount BIGINT, date as text; 2: amount DOUBLE, columns in another order; 3: amount as text,
    that of pending orders the word 'pending'; 4: amount DECIMAL, no store.
    """
    o = table(spark, sf_dir, "orders")
    key, store, price, when = (F.col("o_orderkey").alias("id_transaccion"), (F.col("o_custkey") % 100 + 1).cast("int").alias("tienda_id"),
                               F.col("o_totalprice"), F.col("o_orderdate").alias("fecha"))
    text = F.when(F.col("o_orderstatus") == "P", F.lit("pending")).otherwise(price.cast("string"))
    shapes = [
        [key, store, F.floor(price).cast("int").alias("monto"), when],
        [key, store, F.floor(price).cast("bigint").alias("monto"), F.date_format("o_orderdate", TIMESTAMP_TEXT_FORMAT).alias("fecha")],
        [price.alias("monto"), when, store, key],
        [key, store, text.alias("monto"), when],
        [key, price.cast("decimal(18,2)").alias("monto"), when],
    ]
    for kind, columns in enumerate(shapes):
        o.where(F.col("o_orderkey") % 5 == kind).select(*columns).write.mode("append").parquet(path)
    return path
