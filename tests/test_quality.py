import pytest

from salesflow.operators import quality
from salesflow.schemas import GOLD_CONTRACT, SILVER_CONTRACT


def test_dq_report_and_gate(spark):
    gold = spark.createDataFrame(
        [(1, 1.0, 1, 1.0), (1, 2.0, 1, 2.0), (None, 3.0, 1, None), (2, 1.0, 1, 1.0), (2, 1.0, 1, 1.0)],
        "tienda_id int, monto_total_ventas double, numero_de_transacciones bigint, "
        "monto_promedio_por_transaccion double")
    rep = {(r["column_name"], r["test"]): r["failures"] for r in quality.dq_report(gold, GOLD_CONTRACT).collect()}
    assert rep[("tienda_id", "unique")] == 2  # two duplicated values, NULL not counted
    assert rep[("tienda_id", "not_null")] == 1
    assert rep[("monto_promedio_por_transaccion", "not_null")] == 1
    assert rep[("monto_total_ventas", "not_null")] == 0
    assert len(rep) == 5
    with pytest.raises(quality.DataQualityError, match="tienda_id unique: 2"):
        quality.require_clean(quality.dq_report(gold, GOLD_CONTRACT))


def test_gate_passes_clean_silver(spark):
    silver = spark.createDataFrame([(1, 1, 2.0, None)], "venta_id bigint, tienda_id int, monto double, fecha_venta timestamp_ntz")
    rep = quality.dq_report(silver, SILVER_CONTRACT)
    with pytest.raises(quality.DataQualityError):
        quality.require_clean(rep)
    ok = spark.createDataFrame([(1, 1, 2.0)], "venta_id bigint, tienda_id int, monto double") \
        .selectExpr("*", "timestamp_ntz'2024-01-01 00:00:00' AS fecha_venta")
    assert quality.require_clean(quality.dq_report(ok, SILVER_CONTRACT)).count() == 4


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k int")
    assert [tuple(r) for r in quality.duplicate_keys(df, "k").collect()] == [(1, 2)]


def test_reconcile_fixture_rows(spark):
    left = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, None), (5, float("nan"))], "key int, v double")
    right = spark.createDataFrame([(1, 1.000009), (2, 2.1), (4, 4.0), (5, float("nan"))], "key int, v double")
    out = {(r["key"], r["status"]) for r in quality.reconcile(left, right, "key").collect()}
    assert out == {(2, "value_mismatch"), (3, "missing_right"), (4, "missing_left")}


def test_reconcile_duplicate_and_null_keys(spark):
    left = spark.createDataFrame([(None, 1.0), (7, 1.0), (7, 1.0)], "key int, v double")
    right = spark.createDataFrame([(None, 1.0), (7, 1.0)], "key int, v double")
    out = [(r["key"], r["status"]) for r in quality.reconcile(left, right, ["key"]).collect()]
    assert out == [(7, "duplicate_key")]


def test_reconcile_sees_every_column_and_type(spark):
    left = spark.createDataFrame([(1, 1.0, "a", 2.0)], "k int, v double, t string, w double")
    right = spark.createDataFrame([(1, 1.0, "b")], "k int, v double, t string")
    got = {(r["column_name"], r["status"], r["left_text"], r["right_text"]) for r in quality.reconcile(left, right, "k").collect()}
    assert got == {("t", "value_mismatch", "a", "b"), ("w", "missing_column", "present", "absent")}
    assert quality.reconcile(left, right, "k", columns=["v"]).count() == 0
    assert quality.reconcile(left.select("k"), right.select("k"), "k").count() == 0


def test_reconcile_tells_large_whole_numbers_apart(spark):
    a = spark.createDataFrame([(1, 2 ** 53 + 1), (2, -2 ** 63)], "k int, v bigint")
    b = spark.createDataFrame([(1, 2 ** 53), (2, 2 ** 63 - 1)], "k int, v bigint")
    assert {r["k"] for r in quality.reconcile(a, b, "k", atol=0.0, rtol=0.0).collect()} == {1, 2}


def test_reconcile_odd_numbers_dates_and_key_types(spark):
    inf, nan = float("inf"), float("nan")
    df = spark.createDataFrame([(None, inf, "2024-01-01"), ("x", nan, None), ("y", -inf, "2024-01-02")], "k string, v double, d string") \
        .selectExpr("cast(k as string) k", "v", "cast(d as date) d")
    assert quality.reconcile(df, df, ["k"]).count() == 0
    other = df.selectExpr("k", "-v as v", "date_add(d, 1) as d")
    got = {(r["k"], r["column_name"]) for r in quality.reconcile(df, other, ["k"]).collect()}
    assert got == {(None, "v"), (None, "d"), ("y", "v"), ("y", "d")}


def test_reconcile_is_one_shuffle_without_a_join(spark):
    df = spark.range(100).selectExpr("id as k", "cast(id as double) as v")
    plan = quality.reconcile(df, df, "k")._jdf.queryExecution().executedPlan().toString()
    initial = plan.split("Initial Plan")[-1]
    assert initial.count("Exchange hashpartitioning") <= 1 and "Join" not in initial


def test_a_doubled_store_fails_the_report(spark):
    """Each test of the two-layer report can fail."""
    import datetime as dt
    from salesflow.operators.layers import silver_gold_report, to_gold
    from salesflow.schemas import GOLD_CONTRACT, SILVER_CONTRACT
    silver = spark.createDataFrame([(1, 1, 5.0, dt.datetime(2024, 1, 1)), (None, 2, 3.0, None), (3, None, 1.0, None)],
                                   "venta_id bigint, tienda_id int, monto double, fecha_venta timestamp_ntz")
    doubled = silver_gold_report(silver, lambda s, more: to_gold(s, more).unionByName(to_gold(s, more).where("tienda_id = 1 OR tienda_id IS NULL")))
    told = {(r.model, r.column_name, r.test): r.failures for r in doubled.collect()}
    assert told[GOLD_CONTRACT.name, "tienda_id", "unique"] == 1 and told[GOLD_CONTRACT.name, "tienda_id", "not_null"] == 2
    told = {(r.model, r.column_name, r.test): r.failures for r in silver_gold_report(silver).collect()}
    assert told[GOLD_CONTRACT.name, "tienda_id", "unique"] == 0 and told[GOLD_CONTRACT.name, "tienda_id", "not_null"] == 1
    assert told[SILVER_CONTRACT.name, "fecha_venta", "not_null"] == 2 and told[SILVER_CONTRACT.name, "venta_id", "not_null"] == 1
    plan = silver_gold_report(silver)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def _tables(spark, seed, n=400):
    import random
    rng = random.Random(seed)
    rows = [(i if i != 7 else None, rng.choice([None, "a", "b"]), rng.choice([None, 1.5, 2.0, float("nan")]), rng.randrange(9), "x" * rng.randrange(9)) for i in range(n)]
    other = [list(r) for r in rows]
    for r in rng.sample(other, 6):
        r[rng.choice([1, 4])] = "changed"
    other[3][2] = 2.0 + 1e-9
    del other[10]
    other.append([n + 5, "new", 1.0, 1, "y"])
    rng.shuffle(other)
    ddl = "k bigint, a string, m double, n int, w string"
    return spark.createDataFrame(rows, ddl), spark.createDataFrame([tuple(r) for r in other], ddl.replace("n int", "n bigint"))


@pytest.mark.parametrize("fanout", [1, 4, 1024])
def test_reconcile_by_digest_gives_what_reconcile_gives(spark, fanout):
    from salesflow.operators.quality import reconcile, reconcile_by_digest
    left, right = _tables(spark, 1)
    for options in ({}, {"atol": 0.0, "rtol": 0.0}, {"columns": ["a", "m"]}):
        want = sorted(map(str, reconcile(left, right, "k", **options).collect()))
        assert want and sorted(map(str, reconcile_by_digest(left, right, "k", fanout=fanout, **options).collect())) == want


def test_equal_tables_shuffle_digests_only(spark):
    from salesflow.operators.quality import _differing, reconcile_by_digest
    left, _ = _tables(spark, 2)
    same = left.repartition(7)
    assert reconcile_by_digest(left, same, "k").collect() == []
    plan = reconcile_by_digest(left, same, "k")._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" not in plan  # nothing is read any more
    # repeats count, and so does where a NULL stands
    ddl = "k int, a int, b int"
    one = spark.createDataFrame([(1, None, 2), (2, 5, 5)], ddl)
    assert reconcile_by_digest(one, spark.createDataFrame([(1, 2, None), (2, 5, 5)], ddl), "k").count() == 2
    assert [r.status for r in reconcile_by_digest(one, one.unionByName(one.where("k = 2")), "k").collect()] == ["duplicate_key"]
    assert [r.status for r in reconcile_by_digest(one, one.drop("b"), "k").collect()] == ["missing_column"]


def test_only_differing_parts_are_compared(spark):
    from salesflow.operators import quality
    left, right = _tables(spark, 3, 5000)
    seen = []
    original = quality.reconcile
    quality.reconcile = lambda a, b, *more: seen.append((a.count(), b.count())) or original(a, b, *more)
    try:
        quality.reconcile_by_digest(left, right, "k").collect()
    finally:
        quality.reconcile = original
    assert 0 < seen[0][0] <= 10 and 0 < seen[0][1] <= 10
