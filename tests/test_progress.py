"""Stream progress as a table, and stops between batches."""

import time

import pytest
from pyspark.sql import functions as F

from salesflow.operators import messages
from salesflow.session import scratch_path
from salesflow.streaming import ingest, progress, sinks, sources


def publish(spark, path, n, files, bad=0):
    values = [f'{{"id": {i}, "tienda_id": 1, "monto": 2.0, "fecha": "2024-01-01 00:00:00"}}' for i in range(n)] + ["not json"] * bad
    sinks.publish(messages.as_binary_messages(spark.createDataFrame([(None, v) for v in values], "key string, value string").repartition(files)), fmt="parquet", path=path)


def test_a_row_for_each_batch(spark):
    root = scratch_path(spark, "progress")
    publish(spark, f"{root}/topic", 40, 4, bad=10)
    log = progress.ProgressLog(spark, f"{root}/log", every=3)
    spark.streams.addListener(log)
    try:
        stream = progress.watch(messages.landed(sources.message_file_stream(spark, f"{root}/topic", files_per_batch=1)))
        query = sinks.run_to_completion(sinks.append_to_parquet(stream, f"{root}/out", f"{root}/ckpt", {"availableNow": True}))
        assert progress.noted(spark, log, query)
    finally:
        spark.streams.removeListener(log)
    told = progress.read_progress(spark, f"{root}/log").orderBy("batch").collect()
    assert [r.batch for r in told] == [0, 1, 2, 3] and log.failures == []
    assert sum(r.n_input for r in told) == sum(r.n_landed for r in told) == 50
    assert sum(r.n_quarantined for r in told) == 10
    assert all(r.run == str(query.runId) and r.batch_ms > 0 and abs(r.quarantine_share - r.n_quarantined / r.n_landed) < 1e-9 for r in told)


def test_lag_of_brokers():
    class Source:
        def __init__(self, **metrics):
            self.metrics = metrics

    class Told:
        sources = [Source(maxOffsetsBehindLatest="12"), Source()]

    assert progress._behind(Told) == 12
    Told.sources = [Source()]
    assert progress._behind(Told) is None


def test_trouble_with_the_log_stops_no_stream(spark):
    log = progress.ProgressLog(spark, "nosuchscheme://x/y", every=1)
    log.rows = [("q", "r", 0, "now", 1, None, None, None, None, 1, None, None)]
    log.flush()
    assert log.rows == [] and len(log.failures) == 1


def test_a_stream_stops_between_batches(spark):
    root = scratch_path(spark, "progress-stop")
    publish(spark, f"{root}/topic", 30, 6)
    stream = sources.message_file_stream(spark, f"{root}/topic", files_per_batch=1)
    query = ingest.ingest_to_versions(stream, f"{root}/landing", f"{root}/ckpt", trigger={"processingTime": "1 second"})
    end = time.time() + 120
    progress.run_until(query, lambda: (query.lastProgress is not None and query.lastProgress.batchId >= 1) or time.time() > end, poll_s=0.1)
    assert not query.isActive and query.exception() is None
    # what was read is what was committed, and a restart goes on
    sinks.run_to_completion(ingest.ingest_to_versions(sources.message_file_stream(spark, f"{root}/topic"), f"{root}/landing", f"{root}/ckpt", trigger={"availableNow": True}))
    from salesflow.sources.versions import read_layer
    ids = [r.id_transaccion for r in messages.good_events(read_layer(spark, f"{root}/landing")).collect()]
    assert sorted(ids, key=int) == [str(i) for i in range(30)]


def test_a_failing_stream_says_so(spark):
    root = scratch_path(spark, "progress-fail")
    publish(spark, f"{root}/topic", 3, 1)
    stream = messages.landed(sources.message_file_stream(spark, f"{root}/topic")).withColumn("monto", F.raise_error(F.lit("broken")).cast("double"))
    query = sinks.append_to_parquet(stream, f"{root}/out", f"{root}/ckpt", {"processingTime": "1 second"})
    with pytest.raises(Exception, match="broken"):
        progress.run_until(query, lambda: False, poll_s=0.1)
