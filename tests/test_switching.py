"""The README's switching guide, run end to end on local paths (files stand in for the broker)."""

from salesflow.operators.layers import to_bronze, to_gold, to_silver
from salesflow.operators.quality import reconcile
from salesflow.operators.totals import first_n, store_sum_with_total, store_totals
from salesflow.plans.medallion import run_medallion
from salesflow.session import scratch_path, unique_name
from salesflow.sources.files import csv_scan, raw_sales_csv, storage_report, write_csv, write_parquet
from salesflow.sources.testviews import sales_from_events
from salesflow.operators.messages import good_events
from salesflow.streaming.ingest import ingest_to_parquet, ingest_to_table, publish_sales, read_landing
from salesflow.streaming.sinks import ensure_table, run_to_completion
from salesflow.streaming.sources import message_file_stream

SF = "/root/testdata/sf0.001"
ONCE = {"availableNow": True}


def test_switching_guide(spark):
    root = scratch_path(spark, "switch")
    csv = write_csv(sales_from_events(spark, SF), f"{root}/sales.csv")

    a = store_totals(csv_scan(spark, csv, infer_schema=True), min_amount=100)
    b = store_totals(sales_from_events(spark, SF), min_amount=100)
    assert a.count() > 0 and reconcile(a, b, ["tienda_id"], atol=1e-5).count() == 0
    assert store_sum_with_total(csv_scan(spark, csv, infer_schema=True)).filter("is_total = 1").count() == 1

    write_parquet(to_bronze(raw_sales_csv(spark, csv)), f"{root}/bronze/sales")
    assert storage_report(spark, csv, f"{root}/bronze/sales").first()["target_bytes"] > 0
    gold = run_medallion(spark, spark.read.parquet(f"{root}/bronze/sales"), f"{root}/lake")
    direct = to_gold(to_silver(spark.read.parquet(f"{root}/bronze/sales")))
    assert gold.count() > 0 and reconcile(gold, direct, ["tienda_id"], atol=0.0, rtol=0.0).count() == 0

    src = csv_scan(spark, csv, infer_schema=True).withColumnRenamed("id_transaccion", "id")
    publish_sales(first_n(src, None, "id"), fmt="parquet", path=f"{root}/topic", key="tienda_id")
    stream = message_file_stream(spark, f"{root}/topic")
    table = ensure_table(spark, unique_name("ventas"), location=f"{root}/table")
    q_table = ingest_to_table(stream, table, f"{root}/ckpt/table", ONCE)
    q_files = ingest_to_parquet(stream, f"{root}/files", f"{root}/ckpt/files", ONCE)
    for q in (q_table, q_files):
        run_to_completion(q, 120)
    n = src.count()
    assert good_events(spark.read.table(table)).count() == n
    assert good_events(read_landing(spark, f"{root}/files")).count() == n
