"""Folders of Parquet files whose types clash."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesflow.schemas import BRONZE_SALES
from salesflow.session import scratch_path
from salesflow.sources import mixed

DAY = dt.datetime(2024, 1, 2, 3, 4, 5, 678901)


def write(spark, path, ddl, *rows):
    spark.createDataFrame(list(rows), ddl).coalesce(1).write.mode("append").parquet(path)


@pytest.fixture
def folder(spark):
    path = scratch_path(spark, "mixed")
    write(spark, path, "id_transaccion int, tienda_id int, monto int, fecha timestamp_ntz", (1, 1, 10, DAY), (2, None, None, None))
    write(spark, path, "fecha string, monto bigint, id_transaccion bigint, tienda_id bigint", (str(DAY), 2**53 + 1, 3, 1), (str(DAY), 7, 4, 2**40), ("someday", 8, 5, 1))
    write(spark, path, "id_transaccion bigint, tienda_id int, monto double, fecha timestamp_ntz", (6, 1, 0.5, DAY), (7, 2, float("nan"), DAY))
    write(spark, path, "id_transaccion string, tienda_id double, monto string, fecha timestamp_ntz, otro int", ("8", 1.0, "2.25", DAY, 1), ("9", 1.5, "pending", DAY, 1), (None, None, "", None, 1))
    write(spark, path, "id_transaccion bigint, monto decimal(12,2)", (10, __import__("decimal").Decimal("99.99")))
    write(spark, path, "id_transaccion bigint, tienda_id int, monto array<double>, fecha date", (11, 1, [1.0], dt.date(2024, 1, 2)), (12, 1, None, dt.date(2024, 1, 2)))
    write(spark, path, "other string", ("no column of ours",))
    return path


def test_every_row_is_read_and_only_misfits_are_set_aside(spark, folder):
    got = mixed.read_mixed_parquet(spark, folder, BRONZE_SALES)
    good = {r.id_transaccion: (r.tienda_id, r.monto, r.fecha) for r in mixed.good_rows(got, BRONZE_SALES).where("id_transaccion is not null").collect()}
    midnight = dt.datetime(2024, 1, 2)
    assert str(good.pop(7)) == str((2, float("nan"), DAY))
    assert good == {1: (1, 10.0, DAY), 2: (None, None, None), 6: (1, 0.5, DAY), 8: (1, 2.25, DAY), 10: (None, 99.99, None), 12: (1, None, midnight)}
    bad = {(r.failed_columns, r.raw) for r in mixed.rejected_rows(got).collect()}
    day = "2024-01-02 03:04:05.678901"
    assert bad == {
        ("monto", '{"id_transaccion":3,"tienda_id":1,"monto":9007199254740993,"fecha":"%s"}' % day),
        ("tienda_id", '{"id_transaccion":4,"tienda_id":1099511627776,"monto":7,"fecha":"%s"}' % day),
        ("fecha", '{"id_transaccion":5,"tienda_id":1,"monto":8,"fecha":"someday"}'),
        ("tienda_id,monto", '{"id_transaccion":"9","tienda_id":1.5,"monto":"pending","fecha":"%s"}' % day),
        ("monto", '{"id_transaccion":null,"tienda_id":null,"monto":"","fecha":null}'),
        ("monto", '{"id_transaccion":11,"tienda_id":1,"monto":[1.0],"fecha":"2024-01-02"}')}
    assert got.count() == 14 and got.columns == [*BRONZE_SALES.names, "file", "failed_columns", "raw"]
    assert all(r.file.startswith("file:") and folder.replace("file:", "").strip("/") in r.file for r in mixed.rejected_rows(got).collect())


def test_one_scan_for_each_combination_of_types(spark, folder):
    # a file of the first group with its columns in another order, and one more with a column that is not ours
    write(spark, folder, "monto int, fecha timestamp_ntz, tienda_id int, id_transaccion int, extra array<int>", (5, DAY, 1, 20, [1]))
    plan = mixed.read_mixed_parquet(spark, folder, BRONZE_SALES)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 7


def test_plain_readers_fail_on_such_a_folder(spark, folder):
    with pytest.raises(Exception):
        spark.read.option("mergeSchema", True).parquet(folder).collect()


def test_only_wanted_columns_and_filters_reach_the_scan(spark, folder):
    got = mixed.good_rows(mixed.read_mixed_parquet(spark, folder, BRONZE_SALES), BRONZE_SALES).where("monto > 1").select("monto")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "otro" not in plan


def test_broken_files_are_named(spark, folder, tmp_path):
    local = folder.replace("file:", "")
    with open(f"{local}/zz-broken.parquet", "wb") as f:
        f.write(b"PAR1 nonsense")
    with pytest.raises(ValueError, match="zz-broken.parquet"):
        mixed.read_mixed_parquet(spark, folder, BRONZE_SALES)
    assert mixed.footers(spark, folder, BRONZE_SALES.names).where("error is not null").count() == 1


def test_footers_through_spark_where_pyarrow_has_no_file_system(spark, folder, monkeypatch):
    """viewfs is a store that only Spark's readers open."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.mixedtest.link./in", f"file://{folder.replace('file:', '')}")
    path = "viewfs://mixedtest/in"
    got = mixed.read_mixed_parquet(spark, path, BRONZE_SALES)
    assert got.count() == 14 and mixed.rejected_rows(got).count() == 6


def test_empty_folder(spark):
    path = scratch_path(spark, "mixed")
    spark.createDataFrame([], BRONZE_SALES).write.parquet(path)
    got = mixed.read_mixed_parquet(spark, path, BRONZE_SALES)
    assert got.collect() == [] and got.schema["monto"].dataType == T.DoubleType()
    assert mixed.rejected_rows(got).where(F.lit(True)).collect() == []
