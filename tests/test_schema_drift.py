"""Tables whose declared shape changes."""

import pytest
from pyspark.sql import types as T

from salesflow.session import scratch_path, unique_name
from salesflow.streaming import sinks
from salesflow.streaming.sinks import SchemaDrift, ensure_table, schema_changes


@pytest.fixture
def table(spark):
    name = unique_name("drift")
    where = scratch_path(spark, "drift")
    yield name, where
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def fill(spark, name, *rows):
    for r in rows:
        spark.sql(f"INSERT INTO {name} VALUES {r}")


def test_an_added_column(spark, table):
    name, where = table
    ensure_table(spark, name, "id bigint, monto double", location=where)
    fill(spark, name, "(1, 2.5)")
    with pytest.raises(SchemaDrift, match="producto is new"):
        ensure_table(spark, name, "id bigint, monto double, producto string", location=where)
    for _ in range(2):  # idempotent
        ensure_table(spark, name, "id bigint, monto double, producto string", location=where, evolve=True)
    fill(spark, name, "(2, 3.5, 'x')")
    assert sorted(map(tuple, spark.table(name).collect())) == [(1, 2.5, None), (2, 3.5, "x")]


def test_widened_types(spark, table):
    name, where = table
    ensure_table(spark, name, "id int, monto float, d decimal(6,2), dia date", location=where)
    fill(spark, name, "(1, 2.5, 1.25, DATE'2024-01-02')")
    wide = "id bigint, monto double, d decimal(12,2), dia timestamp_ntz, nuevo int"
    with pytest.raises(SchemaDrift, match="id is now bigint"):
        ensure_table(spark, name, wide, location=where)
    ensure_table(spark, name, wide, location=where, evolve=True)
    fill(spark, name, "(5000000000, 1e300, 1234567.25, TIMESTAMP_NTZ'2024-01-02 03:04:05', 7)")
    got = sorted((r.id, r.monto, float(r.d), str(r.dia), r.nuevo) for r in spark.table(name).collect())
    assert got == [(1, 2.5, 1.25, "2024-01-02 00:00:00", None), (5000000000, 1e300, 1234567.25, "2024-01-02 03:04:05", 7)]


@pytest.mark.parametrize("old,new,said", [
    ("id bigint", "id int", "id is bigint, not int"), ("id string", "id bigint", "not bigint"), ("id bigint", "id double", "not double"),
    ("id bigint, x int", "id bigint", "x is not declared"), ("id decimal(6,2)", "id decimal(6,3)", "not decimal"), ("id double", "id float", "not float")])
def test_forbidden_changes(spark, table, old, new, said):
    name, where = table
    ensure_table(spark, name, old, location=where)
    for evolve in (False, True):
        with pytest.raises(SchemaDrift, match=said):
            ensure_table(spark, name, new, location=where, evolve=evolve)
    assert spark.table(name).schema.simpleString() == T._parse_datatype_string(old).simpleString()


def test_managed_parquet_is_not_widened(spark, table):
    name, _ = table
    ensure_table(spark, name, "id int")
    with pytest.raises(SchemaDrift, match="managed"):
        ensure_table(spark, name, "id bigint", evolve=True)
    ensure_table(spark, name, "id int, x string", evolve=True)
    assert spark.table(name).columns == ["id", "x"]


def test_changes_are_found_without_case(spark):
    old, new = (T._parse_datatype_string(x) for x in ("Id int, b string", "ID int, B string, c array<int>"))
    added, wider = schema_changes(old, new)
    assert [f.name for f in added] == ["c"] and wider == []
    assert sinks._widens(T.DecimalType(6, 2), T.DecimalType(8, 4)) and not sinks._widens(T.DecimalType(6, 2), T.DecimalType(7, 4))
