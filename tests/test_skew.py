"""A store holding a third of all rows: results stay exact and the aggregation is pre-combined."""

from pyspark.sql import functions as F

from salesflow.operators import layers, quality, totals


def skewed(spark, n=30000):
    # store 1 gets every third row; the rest spread over 999 stores
    return (spark.range(n, numPartitions=8)
            .select(F.col("id").alias("id_transaccion"),
                    F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 999 + 2).alias("tienda_id"),
                    ((F.col("id") % 1000) / 10 + 100.01).alias("monto")))


def test_hot_store_totals_exact(spark):
    df = skewed(spark)
    got = {r["tienda_id"]: r["monto_total"] for r in totals.store_totals(df, 100.0).collect()}
    expect = {}
    for i in range(30000):
        k = 1 if i % 3 == 0 else i % 999 + 2
        expect[k] = expect.get(k, 0) + round((i % 1000) / 10 * 100 + 10001)
    assert got == {k: v / 100 for k, v in expect.items()}
    plan = totals.store_totals(df, 100.0)._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan  # map-side combine before the shuffle


N_STORES = len({1 if i % 3 == 0 else i % 999 + 2 for i in range(30000)})


def test_hot_key_reconcile_does_not_multiply(spark):
    df = skewed(spark).select("tienda_id", F.lit(1.0).alias("v"))
    out = quality.reconcile(df, df, "tienda_id").collect()
    # every store repeats, so every store is one duplicate_key row, never a row per pair
    assert len(out) == N_STORES and {r["status"] for r in out} == {"duplicate_key"}


def test_hot_key_gold_and_unique(spark):
    silver = skewed(spark).withColumnRenamed("id_transaccion", "venta_id")
    g = {r["tienda_id"]: r["numero_de_transacciones"] for r in layers.to_gold(silver).collect()}
    assert g[1] == 10000 and sum(g.values()) == 30000
    assert quality.duplicate_keys(silver, "tienda_id").count() == N_STORES
