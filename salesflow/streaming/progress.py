"""What a stream does, as a table: rows, lag, quarantine and time of every batch; and a stop between batches.

``watch`` counts a batch's messages and quarantined messages inside the stream itself (an observation, no second pass).
``ProgressLog`` is a listener that writes a row for each batch, or each ``every`` of them, as Parquet.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..schemas import QUARANTINE

OBSERVED = "salesflow_landed"
PROGRESS = ("query string, run string, batch bigint, at string, n_input bigint, n_landed bigint, n_quarantined bigint, "
            "quarantine_share double, behind bigint, batch_ms bigint, input_per_s double, processed_per_s double")


def watch(landing: DataFrame) -> DataFrame:
    """A landing stream whose progress tells how many messages landed and how many of them are quarantined."""
    return landing.observe(OBSERVED, F.count(F.lit(1)).alias("n_landed"), F.count_if(F.col("route") == QUARANTINE).alias("n_quarantined"))


def _behind(progress) -> int | None:
    """Messages that have arrived and were not read, over all partitions, where the source tells (brokers do)."""
    told = [s.metrics.get("offsetsBehindLatest") or s.metrics.get("maxOffsetsBehindLatest") for s in progress.sources]
    known = [int(float(x)) for x in told if x is not None]
    return sum(known) if known else None


def progress_row(progress) -> tuple:
    """A row of the progress table from what Spark reports of a batch."""
    seen = progress.observedMetrics.get(OBSERVED)
    landed, bad = (int(seen["n_landed"]), int(seen["n_quarantined"])) if seen is not None else (None, None)
    finite = [x if x == x and abs(x) != float("inf") else None for x in (progress.inputRowsPerSecond, progress.processedRowsPerSecond)]
    return (progress.name or str(progress.id), str(progress.runId), int(progress.batchId), progress.timestamp, int(progress.numInputRows), landed, bad,
            bad / landed if landed else None, _behind(progress), int(progress.durationMs.get("triggerExecution", 0)), *finite)


class ProgressLog(StreamingQueryListener):
    """Writes the progress of the session's streams below ``path``: start it with ``spark.streams.addListener``, read it with
    ``read_progress``. A file holds ``every`` batches; ``flush`` writes what is left, as the end of a query does. Batches
    without rows are not noted. Trouble with the log never stops a stream: it is kept in ``failures``."""

    def __init__(self, spark: SparkSession, path: str, every: int = 20) -> None:
        super().__init__()
        self.spark, self.path, self.every = spark, path.rstrip("/"), every
        self.rows: list[tuple] = []
        self.last: dict[str, int] = {}
        self.failures: list[str] = []

    def flush(self) -> None:
        rows, self.rows = self.rows, []
        if not rows:
            return
        try:
            # a folder for each write: two logs into one path do not meet
            self.spark.createDataFrame(rows, PROGRESS).coalesce(1).write.parquet(f"{self.path}/flush={time.time_ns()}-{uuid.uuid4().hex[:6]}")
        except Exception as e:
            self.failures.append(str(e)[:500])

    def onQueryStarted(self, event) -> None:
        pass

    def heard(self, progress) -> bool:
        return self.last.get(str(progress.runId), -1) >= progress.batchId

    def onQueryProgress(self, event) -> None:
        self.last[str(event.progress.runId)] = event.progress.batchId
        if event.progress.numInputRows:
            self.rows.append(progress_row(event.progress))
            if len(self.rows) >= self.every:
                self.flush()

    def onQueryIdle(self, event) -> None:
        self.flush()

    def onQueryTerminated(self, event) -> None:
        self.flush()


def noted(spark: SparkSession, log: ProgressLog, query: StreamingQuery, timeout_s: float = 30.0) -> bool:
    """Wait until the log has heard of a finished query's last batch (listeners are told a little later), and write it."""
    last, end = query.lastProgress, time.monotonic() + timeout_s
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(int(timeout_s * 1000))
    while last is not None and not log.heard(last) and time.monotonic() < end:
        time.sleep(0.05)
    log.flush()
    return last is None or log.heard(last)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PROGRESS).option("recursiveFileLookup", True).parquet(path.rstrip("/"))


def stop_between_batches(query: StreamingQuery, poll_s: float = 0.2, timeout_s: float | None = None) -> bool:
    """Stop a stream when no batch is running, so that none is cut short and done again. After ``timeout_s`` it is stopped as it
    is (a batch that was cut is replayed on restart). Returns whether it stopped between batches."""
    began = time.monotonic()
    while query.isActive and json.loads(query._jsq.status().json())["isTriggerActive"]:
        if timeout_s is not None and time.monotonic() - began > timeout_s:
            query.stop()
            return False
        time.sleep(poll_s)
    query.stop()
    return True


def run_until(query: StreamingQuery, should_stop: Callable[[], bool], poll_s: float = 1.0, timeout_s: float | None = None) -> StreamingQuery:
    """Let a stream run until ``should_stop()`` says so (a marker file, a closing time), then stop it between batches. Raises
    the stream's error if it ends by itself with one."""
    while not query.awaitTermination(poll_s):
        if should_stop():
            stop_between_batches(query, timeout_s=timeout_s)
            break
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return query
