"""Differential checks: the same answer from different engines/APIs, compared with ``reconcile``
(atol = rtol = 1e-5). pandas runs only on the small fixture table, inside the test."""

import pandas as pd

from salesflow.operators import layers, quality, totals
from salesflow.plans import queries
from salesflow.sources.testviews import sales_from_events

SF = "/root/testdata/sf0.001"


def test_flagship_matches_pandas(spark):
    ev = pd.read_parquet(f"{SF}/events.parquet")
    ev["tienda_id"] = ev["user_id"] % 100 + 1
    ev["monto"] = ev["value"].where(ev["event_type"] != "error", -ev["value"])
    expect = (ev[ev["monto"] > 100].groupby("tienda_id")
              .agg(monto_total=("monto", "sum"), monto_promedio=("monto", "mean")).reset_index())
    ours = totals.store_totals(sales_from_events(spark, SF), 100.0)
    diff = quality.reconcile(ours, spark.createDataFrame(expect), ["tienda_id"])
    assert diff.count() == 0, diff.collect()[:5]


def test_sql_models_match_dataframe_operators(spark):
    api = layers.to_gold(layers.to_silver(sales_from_events(spark, SF)))
    sql = queries.gold_sql_model(spark, SF)
    assert quality.reconcile(api, sql, ["tienda_id"], atol=0.0, rtol=0.0).count() == 0


def test_batch_gold_matches_streamed_gold(spark):
    batch = queries.gold_store_sales(spark, SF)
    streamed = queries.stream_to_gold(spark, SF)
    assert quality.reconcile(batch, streamed, ["tienda_id"], atol=0.0, rtol=0.0).count() == 0
