from pyspark.sql import functions as F

from salesflow.operators import messages
from salesflow.session import scratch_path, unique_name
from salesflow.streaming import ingest, sinks, sources

ONCE = {"availableNow": True}


def _publish(spark, path, ids):
    df = spark.createDataFrame([(i, i % 3 + 1, float(i), "2024-01-01 00:00:00") for i in ids],
                               "id bigint, tienda_id int, monto double, fecha string")
    sinks.publish(messages.as_binary_messages(messages.encode_messages(df)).repartition(2), fmt="parquet", path=path)


def _run(spark, topic, table, ckpt):
    stream = sources.message_file_stream(spark, topic, files_per_batch=1)
    sinks.run_to_completion(ingest.ingest_to_table(stream, table, ckpt, ONCE), 120)


def test_restart_resumes_and_adds_nothing_twice(spark):
    root = scratch_path(spark, "resume-test")
    table = sinks.ensure_table(spark, unique_name("t"), location=f"{root}/table")
    sinks.ensure_table(spark, table, location=f"{root}/table")  # idempotent DDL
    _publish(spark, f"{root}/topic", range(0, 10))
    _run(spark, f"{root}/topic", table, f"{root}/ckpt")
    assert spark.read.table(table).count() == 10
    _run(spark, f"{root}/topic", table, f"{root}/ckpt")
    assert spark.read.table(table).count() == 10
    _publish(spark, f"{root}/topic", range(10, 15))
    _run(spark, f"{root}/topic", table, f"{root}/ckpt")
    ids = sorted(int(r[0]) for r in spark.read.table(table).select("id_transaccion").collect())
    assert ids == list(range(15))


def test_parquet_sink_batches(spark):
    root = scratch_path(spark, "batches-test")
    _publish(spark, f"{root}/topic", range(0, 20))
    good = messages.decode_messages(sources.message_file_stream(spark, f"{root}/topic", files_per_batch=1))
    q = sinks.append_to_parquet(good, f"{root}/out", f"{root}/ckpt", ONCE)
    sinks.run_to_completion(q, 120)
    assert q.lastProgress is not None
    out = spark.read.parquet(f"{root}/out")
    assert out.count() == 20
    assert out.agg(F.sum("monto")).first()[0] == float(sum(range(20)))


def test_kafka_options_have_no_cap_unless_asked():
    opts = sources.kafka_options("broker:9092")
    assert opts["subscribe"] == "ventas_stream" and opts["startingOffsets"] == "earliest"
    assert not [k for k in opts if "PerTrigger" in k or "Delay" in k]
    opts = sources.kafka_options("broker:9092", batch_messages=5000, max_wait="30s")
    assert opts["maxOffsetsPerTrigger"] == opts["minOffsetsPerTrigger"] == "5000" and opts["maxTriggerDelay"] == "30s"


def test_no_message_is_lost_and_each_is_parsed_once(spark):
    root = scratch_path(spark, "quarantine-test")
    rows = ['{"id": 1, "tienda_id": 2, "monto": 3.0, "fecha": "2024-01-01 00:00:00", "otro": "kept"}',
            '{"id": 2, "tienda_id": 2, "monto": "12"}', "not json", None]
    msgs = spark.createDataFrame([(None, v) for v in rows], "key string, value string")
    sinks.publish(messages.as_binary_messages(msgs), fmt="parquet", path=f"{root}/topic")
    stream = sources.message_file_stream(spark, f"{root}/topic")
    query = ingest.ingest_to_parquet(stream, f"{root}/out", f"{root}/ckpt", ONCE)
    sinks.run_to_completion(query)
    assert query._jsq.explainInternal(False).count("from_json(") <= 1
    landing = ingest.read_landing(spark, f"{root}/out")
    assert sorted((r["raw"] for r in landing.collect()), key=str) == sorted(rows, key=str)
    assert [tuple(r) for r in messages.good_events(landing).collect()] == [("1", "2", None, 3.0, __import__("datetime").datetime(2024, 1, 1))]
    bad = {r["raw"]: (r["reason"], r["id_transaccion"]) for r in messages.quarantined(landing).collect()}
    assert bad == {"not json": ("malformed", None), None: ("empty_message", None), rows[1]: ("malformed", "2")}
    plan = messages.good_events(landing)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(route" in plan


def test_bytes_bound_a_batch_of_files(spark):
    root = scratch_path(spark, "bytes-test")
    _publish(spark, f"{root}/topic", range(0, 40))
    stream = sources.message_file_stream(spark, f"{root}/topic", bytes_per_batch=1024)
    sinks.run_to_completion(ingest.ingest_to_parquet(stream, f"{root}/out", f"{root}/ckpt", ONCE))
    assert ingest.read_landing(spark, f"{root}/out").count() == 40


def test_kafka_min_partitions():
    assert sources.kafka_options("b:9092", min_partitions=64)["minPartitions"] == "64"
