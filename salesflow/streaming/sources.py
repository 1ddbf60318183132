"""Streaming sources of sale messages.

Production reads a broker topic (``format("kafka")``); tests and this repository's checks read
message files with the same (key, value) shape, since no broker is reachable here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import MESSAGE

# Fixed values of the reference deployment: topic name, batch bound and time bound of a poll.
DEFAULT_TOPIC = "ventas_stream"
BATCH_MESSAGES = 5000
BATCH_WAIT = "30s"


def kafka_options(bootstrap_servers: str, topic: str = DEFAULT_TOPIC, starting_offsets: str = "earliest",
                  batch_messages: int | None = None, max_wait: str | None = None,
                  min_partitions: int | None = None) -> dict:
    """Options of a broker source: start at the earliest offset on first start (a checkpoint
    resumes later runs). A micro-batch takes all that has arrived, without a cap.

    ``batch_messages`` and ``max_wait`` cut batches by size or time instead, as a poll loop does. Run
    such a stream without a fixed trigger: the next batch then starts as soon as the last is done, and the size bound is
    no limit on throughput. A bound together with a trigger interval would be one.

    ``min_partitions`` splits each topic partition's offset range over several tasks, so a topic
    with few partitions still keeps many cores busy (no shuffle involved).
    """
    opts = {"kafka.bootstrap.servers": bootstrap_servers, "subscribe": topic,
            "startingOffsets": starting_offsets}
    if min_partitions:
        opts["minPartitions"] = str(min_partitions)
    if batch_messages:
        opts["maxOffsetsPerTrigger"] = str(batch_messages)
        opts["minOffsetsPerTrigger"] = str(batch_messages)
    if max_wait:
        opts["maxTriggerDelay"] = max_wait
    return opts


def event_stream(spark: SparkSession, fmt: str = "kafka", options: dict | None = None,
                 path: str | None = None, schema=None) -> DataFrame:
    """A streaming DataFrame from any source format (broker, files, ...)."""
    reader = spark.readStream.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return reader.load(path) if path else reader.load()


def message_file_stream(spark: SparkSession, path: str, files_per_batch: int | None = None,
                        bytes_per_batch: int | None = None) -> DataFrame:
    """Message files (key, value as bytes) under ``path`` as a stream; a micro-batch takes all new files, or
    about ``bytes_per_batch`` or ``files_per_batch`` of them at a time."""
    opts = {"maxFilesPerTrigger": str(files_per_batch)} if files_per_batch else {}
    if bytes_per_batch:
        opts["maxBytesPerTrigger"] = str(bytes_per_batch)
    return event_stream(spark, "parquet", opts, path=path, schema=MESSAGE)
