import datetime as dt
import math

from pyspark.sql import functions as F

from salesflow.operators import layers
from salesflow.schemas import GOLD_CONTRACT, RAW_SALES, SILVER_CONTRACT
from salesflow.session import scratch_path


def raw(spark, rows):
    return spark.createDataFrame(rows, RAW_SALES)


def test_bronze_types_and_rejects(spark):
    df = raw(spark, [
        ("1", "2", "3.5", "2021-01-02 03:04:05"),
        ("x", "", "abc", "nope"),
        ("3000000000", "5", "NaN", "2021-01-02"),
        (None, None, None, None),
    ])
    b = layers.to_bronze(df)
    assert [f.dataType.simpleString() for f in b.schema.fields] == ["bigint", "int", "double", "timestamp_ntz"]
    rows = b.collect()
    assert tuple(rows[0]) == (1, 2, 3.5, dt.datetime(2021, 1, 2, 3, 4, 5))
    assert tuple(rows[1]) == (None, None, None, None)
    # id fits BIGINT; NaN amount is treated as missing; a date alone is midnight
    assert tuple(rows[2]) == (3000000000, 5, None, dt.datetime(2021, 1, 2))
    rej = {r["id_transaccion"]: r["failed_columns"] for r in layers.bronze_rejects(df).collect()}
    # '' is text that became NULL; a NULL raw value is no reject
    assert rej == {"x": "id_transaccion,tienda_id,monto,fecha", "3000000000": "monto"}


def test_silver_filter_and_date_parts(spark):
    b = layers.to_bronze(raw(spark, [
        ("1", "1", "0.01", "2024-01-07 10:00:00"),
        ("2", "1", "0", "2024-01-06 10:00:00"),
        ("3", "1", "-5", "2024-01-06 10:00:00"),
        ("4", "1", None, "2024-01-06 10:00:00"),
        ("5", "1", "NaN", "2024-01-06 10:00:00"),
        ("6", "1", "7", "2024-01-06 23:59:59"),
    ]))
    s = {r["venta_id"]: r for r in layers.to_silver(b).collect()}
    assert sorted(s) == [1, 6]
    assert s[1]["dia_semana_venta"] == 1 and s[6]["dia_semana_venta"] == 7  # Sunday=1, Saturday=7
    assert (s[1]["anio_venta"], s[1]["mes_venta"], s[1]["dia_venta"]) == (2024, 1, 7)
    assert s[1].asDict().keys() == {c.name for c in SILVER_CONTRACT.columns}


def test_gold_semantics(spark):
    silver = spark.createDataFrame(
        [(1, 1, 10.0), (None, 1, 20.0), (3, None, 5.0), (4, 2, None), (5, 2, None)],
        "venta_id bigint, tienda_id int, monto double")
    g = {r["tienda_id"]: r for r in layers.to_gold(silver).collect()}
    assert g[1]["monto_total_ventas"] == 30.0 and g[1]["numero_de_transacciones"] == 1
    assert g[1]["monto_promedio_por_transaccion"] == 15.0
    assert g[None]["monto_total_ventas"] == 5.0  # NULL store is its own group
    assert g[2]["monto_total_ventas"] is None and g[2]["monto_promedio_por_transaccion"] is None
    assert g[2]["numero_de_transacciones"] == 2


def test_exact_sum_is_order_free(spark):
    vals = [0.1, 0.2, 0.3] * 1000 + [1e9 + 0.01, -1e9]
    df = spark.createDataFrame([(1, v) for v in vals], "tienda_id int, monto double")
    totals = [layers.to_gold(df.repartition(n).select(F.lit(1).alias("venta_id"), "tienda_id", "monto"))
              .first()["monto_total_ventas"] for n in (1, 3, 7)]
    assert totals[0] == totals[1] == totals[2] == 600.01


def test_layer_comments_survive_write(spark):
    silver = layers.to_silver(layers.to_bronze(raw(spark, [("1", "1", "2.0", "2024-01-07 10:00:00")])))
    path = scratch_path(spark, "layer-test")
    layers.write_layer(silver, path, SILVER_CONTRACT, partition_by=layers.SILVER_PARTITIONS)
    back = spark.read.parquet(path)
    assert back.schema["venta_id"].metadata["comment"] == SILVER_CONTRACT.descriptions()["venta_id"]
    assert back.count() == 1
    g = layers.with_comments(layers.to_gold(back), GOLD_CONTRACT)
    assert "comment" in g.schema["tienda_id"].metadata
    assert not math.isnan(g.first()["monto_total_ventas"])


def test_write_layer_as_named_table_replaces_previous(spark):
    from salesflow.session import unique_name
    silver = layers.to_silver(layers.to_bronze(raw(spark, [("1", "1", "2.0", "2024-01-07 10:00:00"),
                                                           ("2", "1", "3.0", "2024-02-07 10:00:00")])))
    path, name = scratch_path(spark, "layer-table"), unique_name("slv")
    layers.write_layer(silver, path, SILVER_CONTRACT, partition_by=layers.SILVER_PARTITIONS, table=name)
    assert spark.table(name).count() == 2
    layers.write_layer(silver.limit(1), path, SILVER_CONTRACT, partition_by=layers.SILVER_PARTITIONS, table=name)
    assert spark.table(name).count() == 1  # overwrite, as a rebuilt layer
    assert spark.table(name).schema["monto"].metadata["comment"].startswith("Amount")


def test_ingest_bronze_writes_typed_and_rejects(spark):
    from salesflow.plans.bronze import ingest_bronze
    from salesflow.sources.files import write_csv
    root = scratch_path(spark, "ingest-test")
    df = raw(spark, [("1", "2", "3.5", "2021-01-02 03:04:05"), ("x", "2", "1.0", "2021-01-02")])
    write_csv(df, f"{root}/in.csv")
    report = ingest_bronze(spark, f"{root}/in.csv", f"{root}/bronze", f"{root}/rejects").first()
    assert report["source_bytes"] > 0 and report["target_bytes"] > 0
    assert spark.read.parquet(f"{root}/bronze").count() == 2
    assert [r["failed_columns"] for r in spark.read.parquet(f"{root}/rejects").collect()] == ["id_transaccion"]


def test_raw_csv_finds_columns_by_name_and_keeps_the_others(spark):
    import pytest
    from salesflow.sources.files import raw_sales_csv, write_csv
    path = scratch_path(spark, "csv-header")
    write_csv(spark.createDataFrame([("2020-01-01 00:00:00", 9, 12.5, 5, 1)],
                                    "fecha string, producto_id int, monto double, tienda_id int, id int"), path)
    out = layers.to_bronze(raw_sales_csv(spark, path))
    assert out.columns == ["id_transaccion", "tienda_id", "monto", "fecha", "producto_id"]
    assert tuple(out.first()) == (1, 5, 12.5, dt.datetime(2020, 1, 1), "9")
    write_csv(spark.createDataFrame([(1, 5)], "id int, tienda_id int"), path)
    with pytest.raises(ValueError, match="lacks monto, fecha"):
        raw_sales_csv(spark, path)


def test_amounts_that_are_not_finite_are_rejected(spark):
    df = raw(spark, [(str(i), "1", text, "2020-01-01") for i, text in enumerate(["Infinity", "-Infinity", "NaN", "1e308"])])
    assert [r["monto"] for r in layers.to_bronze(df).orderBy("id_transaccion").collect()] == [None, None, None, 1e308]
    assert sorted(r["id_transaccion"] for r in layers.bronze_rejects(df).collect()) == ["0", "1", "2"]
