from salesflow.operators import totals


def sales(spark):
    return spark.createDataFrame(
        [(1, 1, 150.0), (2, 1, 50.0), (3, 2, 100.0), (4, 2, 100.01), (5, None, 300.0), (6, 3, None)],
        "id_transaccion bigint, tienda_id int, monto double")


def test_store_totals_filter_group_order(spark):
    rows = [tuple(r) for r in totals.store_totals(sales(spark), 100.0).collect()]
    assert rows == [(None, 300.0, 300.0), (1, 150.0, 150.0), (2, 100.01, 100.01)]


def test_store_sum_with_total(spark):
    rows = {(r["tienda_id"], r["is_total"]): (r["monto_total"], r["n_rows"])
            for r in totals.store_sum_with_total(sales(spark)).collect()}
    assert rows[(None, 1)] == (700.01, 6)
    assert rows[(None, 0)] == (300.0, 1)  # the NULL store keeps its own row
    assert rows[(3, 0)] == (None, 1)


def test_row_count_preview_first_n(spark):
    df = sales(spark)
    assert totals.row_count(df).first()["n_rows"] == 6
    assert [r["tienda_id"] for r in totals.preview(totals.store_sum(df), ["tienda_id"], 2).collect()] == [None, 1]
    assert [r["id_transaccion"] for r in totals.first_n(df, 3).collect()] == [1, 2, 3]
    assert totals.first_n(df, None).count() == 6


def test_store_sum_observing_rows(spark):
    sums, obs = totals.store_sum_observing_rows(sales(spark))
    rows = {r["tienda_id"]: r["monto_total"] for r in sums.collect()}
    assert obs.get["n_rows"] == 6 and rows[1] == 200.0


def test_amounts_below_a_cent_and_odd_amounts(spark):
    inf, nan = float("inf"), float("nan")
    groups = {1: [0.004] * 1000, 2: [nan, 1.0], 3: [inf, 1.0], 4: [-inf, 2.0], 5: [inf, -inf], 6: [1e18, 1.0], 7: [None, None],
              8: [0.1] * 10, 9: [-0.1, 0.3, -1e-10], 10: [9e11, 0.1234567891], 11: [1e12] * 10}
    df = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs], "tienda_id int, monto double").repartition(5)
    want = {1: 4.0, 2: nan, 3: inf, 4: -inf, 5: nan, 6: 1e18, 7: None, 8: 1.0, 9: 0.1999999999, 10: 9e11 + 0.1234567891, 11: 1e13}
    for out in (totals.store_sum(df), totals.store_sum_with_total(df).where("is_total = 0")):
        assert repr({r["tienda_id"]: r["monto_total"] for r in out.orderBy("tienda_id").collect()}) == repr(want)
    total = totals.store_sum_with_total(df.where("tienda_id in (1, 8, 9)")).where("is_total = 1").first()
    assert total["monto_total"] == 5.1999999999
    mean = {r["tienda_id"]: r["monto_promedio"] for r in totals.store_totals(df, None).collect()}
    assert mean[1] == 0.004 and mean[7] is None


def test_whole_parts_beyond_bigint_do_not_stop_the_job(spark):
    from pyspark.sql import functions as F
    df = spark.range(10_000_000, numPartitions=4).select(F.lit(1).alias("tienda_id"), F.lit(9.9e11).alias("monto"))
    assert abs(totals.store_sum(df).first()["monto_total"] / 9.9e18 - 1) < 1e-9


def test_rounding_large_and_odd_amounts(spark):
    from salesflow.functions.money import round_amount
    values = [24606.144999999997, 1e13 + 0.126, 1e300, float("inf"), None]
    df = spark.createDataFrame([(v,) for v in values], "monto double")
    assert [r[0] for r in df.select(round_amount("monto")).collect()][:1] == [24606.15]
    assert df.select(round_amount("monto")).collect()[3][0] == float("inf")


def test_first_n_has_one_order_for_ties(spark):
    df = spark.createDataFrame([(1, x) for x in "dbca"], "id_transaccion int, t string").repartition(3)
    assert [r["t"] for r in totals.first_n(df, 2).collect()] == ["a", "b"]


def test_a_threshold_that_bites(spark):
    """The reference's threshold keeps every line item, so a lost filter would not show; this one takes some out."""
    from salesflow.plans import queries
    sf = "/root/testdata/sf0.001"
    every = queries.row_count(spark, sf).first()["n_rows"]
    high = queries.filter_high_amount(spark, sf)
    assert 0 < high.count() < every and high.where("monto <= 30000").count() == 0
    plan = queries.store_totals_high_amount(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(l_extendedprice,30000.0)" in plan
