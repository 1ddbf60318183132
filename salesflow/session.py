"""Session helpers: a local builder for tests and benches, and the shared scratch root.

Library functions never create a session of their own; they take the caller's.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, app: str = "salesflow",
                  driver_memory: str = "8g", max_partition_bytes: str = "16m") -> SparkSession:
    """Local session for tests and benchmarks (UTC, AQE on, no UI).

    Splittable files (CSV) are cut into ``max_partition_bytes`` pieces so a single-machine run
    uses all its cores on small inputs; a cluster keeps its own (larger) split size.
    """
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.files.maxPartitionBytes", max_partition_bytes)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set (a folder every executor and the driver can reach).
    Only a local-mode session without it gets a fresh temporary folder, as in tests.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir().rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="salesflow-ckpt-"))
    return sc.getCheckpointDir().rstrip("/")


def hadoop_path(spark: SparkSession, folder: str):
    """The folder's file system and path."""
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(sc._jsc.hadoopConfiguration()), path


def scratch_root(spark: SparkSession) -> str:
    """This application's own folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/salesflow/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unique folder path under the application's scratch folder (the path itself is not created).

    The scratch folder belongs to the application: it is deleted when the application ends, or
    earlier by ``drop_scratch``. Nothing that is to stay may be written there.
    """
    folder = scratch_root(spark)
    fs, path = hadoop_path(spark, folder)
    if not fs.exists(path):
        fs.mkdirs(path)
        fs.deleteOnExit(path)
    return f"{folder}/{label}-{uuid.uuid4().hex[:12]}"


def drop_scratch(spark: SparkSession) -> None:
    """Delete all that this application has written to its scratch folder; results read from it are gone too."""
    fs, path = hadoop_path(spark, scratch_root(spark))
    fs.delete(path, True)


def unique_name(label: str) -> str:
    """A table name that does not collide when a query runs twice in one session."""
    return f"{label}_{uuid.uuid4().hex[:12]}"
