import os

import pytest

from salesflow.operators.quality import DataQualityError
from salesflow.plans.medallion import LayerPaths, run_medallion
from salesflow.session import scratch_path


def bronze(spark, rows):
    return spark.createDataFrame(rows, "id_transaccion bigint, tienda_id int, monto double, fecha timestamp_ntz")


def test_gate_stops_before_gold(spark):
    import datetime as dt
    root = scratch_path(spark, "medallion-test")
    bad = bronze(spark, [(1, None, 5.0, dt.datetime(2024, 1, 1)), (2, 1, 3.0, dt.datetime(2024, 2, 1))])
    with pytest.raises(DataQualityError, match="silver_sales.tienda_id not_null: 1"):
        run_medallion(spark, bad, root)
    gold_dir = LayerPaths.under(root).gold.replace("file:", "")
    assert not os.path.exists(gold_dir)


def test_clean_build_writes_partitioned_silver_and_gold(spark):
    import datetime as dt
    root = scratch_path(spark, "medallion-test")
    good = bronze(spark, [(1, 2, 5.0, dt.datetime(2024, 1, 1)), (2, 1, 3.0, dt.datetime(2024, 2, 1)),
                          (3, 1, -1.0, dt.datetime(2024, 2, 1))])
    gold = run_medallion(spark, good, root)
    assert [tuple(r) for r in gold.orderBy("tienda_id").collect()] == [(1, 3.0, 1, 3.0), (2, 5.0, 1, 5.0)]
    silver_dir = LayerPaths.under(root).silver.replace("file:", "")
    assert sorted(d for d in os.listdir(silver_dir) if d.startswith("anio")) == ["anio_venta=2024"]


def test_layers_as_catalog_tables(spark):
    import datetime as dt
    from salesflow.session import unique_name
    root = scratch_path(spark, "medallion-tables")
    paths = LayerPaths.under(root, silver_table=unique_name("silver"), gold_table=unique_name("gold"))
    good = bronze(spark, [(1, 2, 5.0, dt.datetime(2024, 1, 1)), (2, 1, 3.0, dt.datetime(2024, 2, 1))])
    gold = run_medallion(spark, good, paths)
    assert gold.count() == 2 and spark.table(paths.silver_table).count() == 2
    assert spark.table(paths.gold_table).schema["tienda_id"].metadata["comment"]


def test_layers_without_any_row(spark):
    import datetime as dt
    root = scratch_path(spark, "medallion-empty")
    gold = run_medallion(spark, bronze(spark, [(1, 2, -5.0, dt.datetime(2024, 1, 1))]), root)
    assert gold.count() == 0
    assert gold.schema["tienda_id"].metadata["comment"]


def test_layers_keep_order_and_descriptions(spark):
    import datetime as dt
    from salesflow.plans.medallion import build_silver
    from salesflow.schemas import SILVER_CONTRACT
    from salesflow.session import unique_name
    good = bronze(spark, [(1, 2, 5.0, dt.datetime(2024, 1, 1))])
    paths = LayerPaths.under(scratch_path(spark, "medallion-comments"))
    silver = build_silver(spark, good, paths)
    assert silver.columns == [c.name for c in SILVER_CONTRACT.columns]
    assert {f.name: f.metadata["comment"] for f in silver.schema.fields} == SILVER_CONTRACT.descriptions()
    name = unique_name("silver")
    try:
        build_silver(spark, good, LayerPaths.under(scratch_path(spark, "medallion-comments"), silver_table=name))
        told = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
        assert told["Comment"] == SILVER_CONTRACT.description
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def days(spark, *rows):
    import datetime as dt
    return bronze(spark, [(i, 1, m, dt.datetime(*d)) for i, m, d in rows])


def test_rebuilt_months_read_and_write_these_months_only(spark):
    from salesflow.plans.medallion import build_silver_version, rebuild_silver_months
    root, landing = scratch_path(spark, "silver"), scratch_path(spark, "bronze")
    first = days(spark, (1, 1.0, (2024, 1, 31)), (2, 2.0, (2024, 2, 1)), (3, 3.0, (2024, 2, 29)), (4, 4.0, (2024, 12, 31)), (5, 5.0, (2025, 1, 1)))
    before = build_silver_version(spark, first, root).inputFiles()
    days(spark, (1, 10.0, (2024, 1, 31)), (3, 30.0, (2024, 2, 29)), (6, 60.0, (2024, 2, 10)), (4, 40.0, (2024, 12, 31))).write.parquet(landing)
    silver = rebuild_silver_months(spark, spark.read.parquet(landing), root, [(2024, 2), (2025, 1)])
    # January and December 2024 stay as they were, January 2025 has no sales any more
    assert sorted((r.venta_id, r.monto) for r in silver.collect()) == [(1, 1.0), (3, 30.0), (4, 4.0), (6, 60.0)]
    kept = [f for f in before if "anio_venta=2024/mes_venta=2" not in f and "anio_venta=2025" not in f]
    assert len(kept) == 2 and set(kept) < set(silver.inputFiles())
    assert silver.schema["monto"].metadata["comment"]


def test_rebuilt_months_reach_the_scan(spark):
    from pyspark.sql import functions as F
    from salesflow.operators.layers import to_silver
    landing = scratch_path(spark, "bronze")
    days(spark, (1, 1.0, (2024, 1, 31))).write.parquet(landing)
    plan = to_silver(spark.read.parquet(landing)).where(F.expr("fecha_venta >= TIMESTAMP_NTZ '2024-01-01 00:00:00'"))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(fecha" in plan


def test_a_failing_rebuild_leaves_silver_as_it_was(spark):
    from salesflow.plans.medallion import build_silver_version, rebuild_silver_months
    root = scratch_path(spark, "silver")
    import datetime as dt
    build_silver_version(spark, days(spark, (1, 1.0, (2024, 1, 31))), root)
    bad = bronze(spark, [(None, 1, 5.0, dt.datetime(2024, 1, 2))])
    for rebuild in (lambda: build_silver_version(spark, bad, root), lambda: rebuild_silver_months(spark, bad, root, [(2024, 1)])):
        with pytest.raises(DataQualityError, match="venta_id not_null: 1"):
            rebuild()
    from salesflow.sources.versions import read_layer
    assert [r.venta_id for r in read_layer(spark, root).collect()] == [1]
    assert [r.venta_id for r in rebuild_silver_months(spark, bad, root, []).collect()] == [1]
