"""Sale-event jobs: publish a table as messages; decode a message stream into a table or files.

Production wiring (connector jars on the cluster; values are the caller's)::

    publish_sales(sales_df, fmt="kafka", options=kafka_sink_options(brokers))
    stream = event_stream(spark, "kafka", kafka_options(brokers))
    ensure_table(spark, "lake.default.ventas", provider="iceberg", partition_by=["route"])
    query = ingest_to_table(stream, "lake.default.ventas", "s3a://bucket/checkpoints/ventas")
    sales, bad = good_events(spark.table("lake.default.ventas")), quarantined(spark.table("lake.default.ventas"))
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.messages import as_binary_messages, encode_messages, landed
from ..operators.ordered import as_ordered_messages, in_order, ordered_messages
from ..schemas import LANDING
from ..sources.versions import append_batch
from .sinks import append_to_parquet, append_to_table, publish, start
from .sources import DEFAULT_TOPIC


def kafka_sink_options(bootstrap_servers: str, topic: str = DEFAULT_TOPIC) -> dict:
    return {"kafka.bootstrap.servers": bootstrap_servers, "topic": topic}


def publish_sales(sales: DataFrame, fmt: str = "kafka", options: dict | None = None,
                  path: str | None = None, key: str = "tienda_id") -> None:
    """Encode every row as a keyed JSON message and write them with a batch sink."""
    publish(as_binary_messages(encode_messages(sales, key)), fmt=fmt, options=options, path=path)


def publish_in_order(sales: DataFrame, staging: str, fmt: str = "kafka", options: dict | None = None, path: str | None = None,
                     key: str = "tienda_id", order_by: Sequence[str] = ("fecha", "id")) -> None:
    """Like ``publish_sales``, with every message numbered within its key, and each task writing a key's messages by number.

    A broker gets the number as the header ``seq``, files as the column ``seq``. Through one task a key is in order by
    itself; a key larger than a run (one of the session's shuffle partitions) goes through several tasks and is put in order by the number.
    """
    numbered = in_order(ordered_messages(sales, staging, key, order_by))
    publish(as_ordered_messages(numbered) if fmt == "kafka" else numbered, fmt=fmt, options=options, path=path)


def ingest_to_table(stream: DataFrame, table: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Decode a message stream and append every message to the landing ``table`` (see ``ensure_table``).

    One query reads the topic once and parses each message once; good and undecodable messages are rows of
    the same table, told apart by ``route``: read it with ``good_events`` and ``quarantined``. The output is exactly-once
    where the sink keeps its own log of committed batches (Parquet files and table formats do).
    """
    return append_to_table(landed(stream), table, checkpoint, trigger)


def ingest_to_parquet(stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Decode a message stream and append every message as Parquet files under ``path``, in one folder for each
    route, exactly once. Read it back with ``read_landing``."""
    return append_to_parquet(landed(stream), path, checkpoint, trigger, partition_by=["route"])


def ingest_to_versions(stream: DataFrame, root: str, checkpoint: str, name: str = "sales", trigger: dict | None = None) -> StreamingQuery:
    """Decode a message stream and append every batch to the versioned landing layer at ``root``, one folder for each route, exactly
    once. Small batches make small files: ``sources.versions.compact`` packs them while the stream runs. Read it back with
    ``sources.versions.read_layer``. A stream with a new checkpoint must have a new name."""
    def run(batch: DataFrame, number: int) -> None:
        append_batch(batch, root, name, number, ["route"])

    return start(landed(stream).writeStream.foreachBatch(run).option("checkpointLocation", checkpoint), trigger)


def read_landing(spark: SparkSession, path: str) -> DataFrame:
    """The rows that ``ingest_to_parquet`` has committed; a filter on ``route`` reads that folder only."""
    return spark.read.schema(LANDING).parquet(path)
