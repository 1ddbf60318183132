"""Incremental gold: equal to gold of all rows, whatever is replayed, dies or comes in which batches."""

import random

import pytest
from pyspark.sql import functions as F

from salesflow.operators import messages
from salesflow.operators.layers import to_gold
from salesflow.session import scratch_path
from salesflow.sources.versions import read_manifest
from salesflow.streaming import gold, sinks, sources

SILVER = "venta_id bigint, tienda_id int, monto double"


def sales(n=300, seed=0):
    rng = random.Random(seed)
    amounts = [0.1, 0.01, 1e9 + 0.07, 3.0, 19.99, 1e-5]
    return [(i if i % 7 else None, rng.choice([1, 2, 3, None]), rng.choice(amounts)) for i in range(n)]


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def batches(spark, rows, sizes):
    at = 0
    for n in sizes:
        yield spark.createDataFrame(rows[at:at + n], SILVER)
        at += n


@pytest.mark.parametrize("fold_at", [16, 2])
def test_gold_after_batches_equals_gold_of_all(spark, fold_at):
    root, rows = scratch_path(spark, "gold"), sales()
    want = got(to_gold(spark.createDataFrame(rows, SILVER)))
    for i, batch in enumerate(batches(spark, rows, [50, 1, 0, 99, 120, 30])):
        assert gold.apply_batch(batch, root, "s", i, fold_at)
        assert not gold.apply_batch(batch, root, "s", i, fold_at)  # replayed
    assert got(gold.read_gold(spark, root)) == want
    assert len(read_manifest(spark, root)[1]["folders"]) <= max(fold_at, 2)
    assert not gold.apply_batch(spark.createDataFrame(rows, SILVER), root, "s", 3)  # an old one
    assert got(gold.read_gold(spark, root)) == want


def test_a_batch_that_died_is_applied_once(spark):
    root, rows = scratch_path(spark, "gold"), sales(40, 1)
    gold.apply_batch(spark.createDataFrame(rows[:20], SILVER), root, "s", 0)
    before = got(gold.read_gold(spark, root))
    dies = spark.createDataFrame(rows[20:], SILVER).withColumn("monto", F.when(F.col("venta_id") == 39, F.raise_error(F.lit("killed")).cast("double")).otherwise(F.col("monto")))
    with pytest.raises(Exception, match="killed"):
        gold.apply_batch(dies, root, "s", 1)
    gold.partial_sums(spark.createDataFrame(rows[20:], SILVER)).write.parquet(f"{root}/state-lost")  # written, not committed
    assert got(gold.read_gold(spark, root)) == before
    assert gold.apply_batch(spark.createDataFrame(rows[20:], SILVER), root, "s", 1)
    assert got(gold.read_gold(spark, root)) == got(to_gold(spark.createDataFrame(rows, SILVER)))


def test_two_streams_into_one_gold(spark):
    root, rows = scratch_path(spark, "gold"), sales(60, 2)
    for name, part in (("a", rows[:30]), ("b", rows[30:])):
        assert gold.apply_batch(spark.createDataFrame(part, SILVER), root, name, 0)
    assert got(gold.read_gold(spark, root)) == got(to_gold(spark.createDataFrame(rows, SILVER)))


def test_amounts_without_exact_parts(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, 1, inf), (2, 1, 5.0), (3, 2, nan), (4, 3, 1e300), (5, 3, 1.0), (6, 4, None), (7, 5, 9.2e11), (8, 5, 0.25)]
    root = scratch_path(spark, "gold")
    for i, batch in enumerate(batches(spark, rows, [3, 2, 3])):
        gold.apply_batch(batch, root, "s", i)
    assert [str(r) for r in got(gold.read_gold(spark, root))] == [str(r) for r in got(to_gold(spark.createDataFrame(rows, SILVER)))]


def test_no_batch_yet(spark):
    assert gold.read_gold(spark, scratch_path(spark, "gold")).collect() == []


def test_work_is_in_proportion_to_the_batch(spark):
    """A batch reads its own rows, and no folder of the state until it folds."""
    root = scratch_path(spark, "gold")
    for i in range(3):
        gold.apply_batch(spark.createDataFrame(sales(1000, i), SILVER), root, "s", i)
    folders = read_manifest(spark, root)[1]["folders"]
    assert len(folders) == 3
    for f in folders:
        assert spark.read.parquet(f"{root}/{f}").count() == 4


def test_stream_with_a_replayed_batch(spark):
    root = scratch_path(spark, "gold-stream")
    df = spark.createDataFrame([(i, i % 3 + 1, float(i) + 0.1, "2024-01-01 00:00:00") for i in range(60)],
                               "id bigint, tienda_id int, monto double, fecha string")
    encoded = messages.as_binary_messages(messages.encode_messages(df))
    sinks.publish(encoded.repartition(5), fmt="parquet", path=f"{root}/topic")

    def run():
        stream = sources.message_file_stream(spark, f"{root}/topic", files_per_batch=1)
        sinks.run_to_completion(gold.ingest_to_gold(stream, f"{root}/gold", f"{root}/ckpt", trigger={"availableNow": True}))

    run()
    want = got(to_gold(gold.silver_of_messages(encoded)))
    assert len(want) == 3 and got(gold.read_gold(spark, f"{root}/gold")) == want
    # the stream's own log forgets the last batch, as after a crash between the batch and its commit
    log = f"{root}/ckpt/commits".replace("file:", "")
    import os
    last = max(int(f) for f in os.listdir(log) if f.isdigit())
    assert last == 4
    for name in (str(last), f".{last}.crc"):
        if os.path.exists(f"{log}/{name}"):
            os.remove(f"{log}/{name}")
    run()
    assert got(gold.read_gold(spark, f"{root}/gold")) == want
