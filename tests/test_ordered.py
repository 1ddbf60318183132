"""Numbers within a key: increasing, without gaps, for keys of any size."""

import glob
import json
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from salesflow.operators import ordered
from salesflow.session import scratch_path
from salesflow.streaming import ingest

SCHEMA = "id bigint, tienda_id int, monto double, fecha timestamp_ntz"


def sales(spark, n=6000, seed=0, hot=1 / 3):
    """A third of the rows are of one store; some have no store or no time."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        store = 7 if rng.random() < hot else rng.choice([None, 1, 2, 3, *range(20, 60)])
        rows.append((i, store, float(i), None if rng.random() < 0.02 else pd.Timestamp(2024, 1, 1) + pd.Timedelta(seconds=rng.randrange(500))))
    rng.shuffle(rows)
    return rows, spark.createDataFrame(pd.DataFrame(rows, columns=["id", "tienda_id", "monto", "fecha"]).astype({"tienda_id": "Int64"}), SCHEMA).repartition(6)


def expected(rows):
    out, n = [], {}
    for i, store, _, when in sorted(rows, key=lambda r: (r[3] is not None, r[3] or 0, r[0])):
        key = "" if store is None else str(store)
        n[key] = n.get(key, 0) + 1
        out.append((key, i, n[key]))
    return sorted(out)


@pytest.mark.parametrize("runs", [1, 4, 37])
def test_numbers_of_every_message(spark, runs):
    rows, df = sales(spark)
    got = ordered.ordered_messages(df, scratch_path(spark, "runs"), runs=runs)
    assert sorted((r.key, json.loads(r.value)["id"], r.seq) for r in got.collect()) == expected(rows)
    assert ordered.sequence_faults(got).collect() == []


def test_a_hot_key_is_cut_into_runs(spark):
    _, df = sales(spark)
    staging = scratch_path(spark, "runs")
    ordered.ordered_messages(df, staging, runs=30)
    placed = spark.read.parquet(staging)
    assert placed.where("key = '7'").select("run").distinct().count() > 5
    largest = placed.groupBy("run").count().agg(F.max("count")).first()[0]
    assert largest < 6000 / 5


def test_files_hold_each_key_by_increasing_number(spark):
    rows, df = sales(spark, 3000)
    root = scratch_path(spark, "ordered")
    ingest.publish_in_order(df, f"{root}/runs", fmt="parquet", path=f"{root}/topic")
    seen = {}
    for f in glob.glob(f"{root.replace('file:', '')}/topic/*.parquet"):
        for key, part in pd.read_parquet(f).groupby("key"):
            assert part.seq.is_monotonic_increasing
            seen.setdefault(key, []).extend(part.seq)
    assert {k: sorted(v) for k, v in seen.items()} == {k: list(range(1, len(v) + 1)) for k, v in seen.items()}
    assert sum(map(len, seen.values())) == len(rows)


def test_the_list_of_what_to_add_is_bounded_by_the_runs(spark):
    _, df = sales(spark)
    got = ordered.ordered_messages(df, scratch_path(spark, "runs"), runs=10)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan.lower()


def test_many_batches_in_one_run(spark):
    """A key's rows that come in several Arrow batches count on."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        rows, df = sales(spark, 2500, 3)
        got = ordered.ordered_messages(df, scratch_path(spark, "runs"), runs=2)
        assert sorted((r.key, json.loads(r.value)["id"], r.seq) for r in got.collect()) == expected(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_faults_are_found(spark):
    told = spark.createDataFrame([("a", 1), ("a", 2), ("b", 2), ("c", 1), ("c", 1), ("d", 1), ("d", 3)], "key string, seq bigint")
    assert sorted(r.key for r in ordered.sequence_faults(told).collect()) == ["b", "c", "d"]


def test_headers_and_empty_table(spark):
    _, df = sales(spark, 50)
    sent = ordered.as_ordered_messages(ordered.ordered_messages(df, scratch_path(spark, "runs")))
    row = sent.where("key = CAST('7' AS BINARY)").first()
    assert row.headers[0].key == "seq" and int(row.headers[0].value.decode()) >= 1
    assert ordered.ordered_messages(df.limit(0), scratch_path(spark, "runs")).collect() == []
