"""Every registered query against its DuckDB oracle on the smallest test data."""

import pytest

import __spark_entry__ as entry
from oracle_check import compare, duck
from salesflow.plans.oracle import oracle_sql
from salesflow.plans.queries import REGISTRY

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, name, REGISTRY[name], oracle_sql().get(name), con, SF)
    assert res["ok"] in (True, None), res
    assert res["rows"] > 0


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["tienda_id", "monto_total", "monto_promedio"]
    assert df.count() > 0


def test_every_query_but_storage_has_oracle():
    assert set(REGISTRY) - set(oracle_sql()) == {"storage_report"}
    assert set(REGISTRY) <= set(entry.queries()) and set(oracle_sql()) <= set(entry.oracle_sql())
