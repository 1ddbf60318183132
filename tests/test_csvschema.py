import datetime as dt

import pytest
from pyspark.sql import types as T

from salesflow.session import scratch_path
from salesflow.sources import csvschema
from salesflow.sources.files import write_csv


def csv(spark, columns, rows):
    return write_csv(spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in columns)).coalesce(1), scratch_path(spark, "csv"))


def report(spark, path, ddl):
    schema = T.StructType.fromDDL(ddl)
    return {r.column_name: tuple(r)[1:] for r in csvschema.check_csv(spark, path, schema).collect()}


def test_the_first_file_is_inferred_and_later_ones_are_not(spark):
    saved = scratch_path(spark, "schema")
    assert csvschema.load_schema(spark, saved) is None
    first = csv(spark, ["a", "t"], [("1", "2024-01-02 03:04:05"), ("2", None)])
    schema = csvschema.learned_schema(spark, first, saved)
    assert schema.simpleString() == "struct<a:int,t:timestamp_ntz>"
    assert csvschema.learned_schema(spark, "/nowhere", saved) == schema  # the file isn't looked at


def test_each_column_of_a_later_file(spark):
    path = csv(spark, ["d", "x.y", "a", "big", "n", "day", "new", "void"], [
        ("1.5", "s", "3000000000", "9007199254740993.5", None, "2024-01-02 10:00:00", "7", None),
        ("x", "t", "4", "1", None, "2024-01-03", "8.25", None), (None, None, None, None, None, None, None, None)])
    got = report(spark, path, "a int, big int, d double, n int, day date, `x.y` string, gone string")
    assert got == {
        "a": ("int", "misfit", 2, 1, "bigint"),
        "big": ("int", "misfit", 2, 1, "string"),  # a DOUBLE would lose digits before the point
        "d": ("double", "misfit", 2, 1, "string"),
        "n": ("int", "ok", 0, 0, "int"),
        "day": ("date", "misfit", 2, 1, "timestamp_ntz"),
        "x.y": ("string", "ok", 2, 0, "string"),
        "gone": ("string", "missing", 0, 0, "string"),
        "new": (None, "extra", 2, 0, "double"),
        "void": (None, "extra", 0, 0, "string"),
    }


def test_the_widened_schema_holds_both_files(spark):
    saved = scratch_path(spark, "schema")
    first, later = csv(spark, ["a", "b"], [("1", "2.5")]), csv(spark, ["c", "a"], [("2024-05-06", "3000000000"), (None, "5")])
    csvschema.learned_schema(spark, first, saved)
    wider = csvschema.update_schema(spark, later, saved)
    assert wider.simpleString() == "struct<a:bigint,b:double,c:date>" and csvschema.load_schema(spark, saved) == wider
    assert sorted(map(tuple, csvschema.read_typed(spark, later, wider).collect())) == [(5, None, None), (3000000000, None, dt.date(2024, 5, 6))]
    assert [tuple(r) for r in csvschema.read_typed(spark, first, wider).collect()] == [(1, 2.5, None)]
    for path in (first, later):
        assert all(r.status in ("ok", "missing") for r in csvschema.check_csv(spark, path, wider).collect())
        assert csvschema.update_schema(spark, path, saved) == wider


@pytest.mark.parametrize("ddl", ["a int, b string", "z int"])
def test_a_file_without_rows(spark, ddl):
    path = csv(spark, ["a", "b"], [])
    for status, filled, misfits in ((r[1], r[2], r[3]) for r in report(spark, path, ddl).values()):
        assert status != "misfit" and filled == misfits == 0


def test_one_scan_of_the_text(spark):
    path = csv(spark, ["a", "b"], [("1", "2")])
    plan = csvschema.check_csv(spark, path, T.StructType.fromDDL("a int, b double, c string"))
    assert plan._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 1
