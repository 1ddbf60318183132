"""The model graph: order, cycles, gates, skipped descendants, projects in YAML."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from salesflow.plans import models
from salesflow.plans.models import Model, ModelError, build_models, build_order
from salesflow.schemas import ColumnContract, ModelContract
from salesflow.session import scratch_path


def sql(name, text, **more):
    return Model(name, text, **more)


def names(ms):
    return [m.name for m in ms]


def keyed(name, *tests):
    return ModelContract(name, "", (ColumnContract("k", "the key", tests),))


def status(outcomes):
    return {o.model: o.status for o in outcomes}


def source(spark, *keys):
    return {"raw.t": spark.createDataFrame([(k,) for k in keys], "k int")}


def test_order_follows_the_references_and_not_the_list():
    ms = [sql("d", "select * from {{ ref('b') }} join {{ref(\"c\")}}"), sql("c", "select * from {{ ref('a') }}"),
          Model("b", build=lambda spark, a: a, reads=("a",)), sql("a", "select * from {{ source('raw', 't') }}")]
    order = names(build_order(ms, ["raw.t"]))
    assert order[0] == "a" and order[-1] == "d" and set(order[1:3]) == {"b", "c"}


@pytest.mark.parametrize("ms,said", [
    ([sql("a", "select * from {{ ref('b') }}"), sql("b", "select * from {{ ref('c') }}"), sql("c", "select * from {{ ref('a') }}")], "circle"),
    ([sql("a", "select * from {{ ref('a') }}")], "circle: a -> a"),
    ([sql("a", "select * from {{ ref('nobody') }}")], "model a reads unknown nobody"),
    ([sql("a", "select * from {{ source('raw', 'x') }}")], "unknown raw.x"),
    ([sql("a", "select 1"), sql("a", "select 2")], "two models"),
    ([sql("a", "select {{ env_var('HOME') }}")], "not a ref"),
    ([sql("a", "select {{ ref(name) }}")], "not a ref"),
    ([sql("a", "select {{ __import__('os').getcwd() }}")], "not a ref"),
])
def test_graphs_that_cannot_be_built(ms, said):
    with pytest.raises(ModelError, match=said):
        build_order(ms, ["raw.t"])


def test_models_are_checked():
    for bad in ({"sql": "x", "build": print}, {}, {"sql": "x", "materialized": "incremental"}):
        with pytest.raises(ModelError):
            Model("m", **bad)


def test_a_failed_model_skips_its_descendants_and_nothing_else(spark):
    root = scratch_path(spark, "models")
    ms = [sql("a", "select * from {{ source('raw', 't') }}"),
          sql("b", "select * from {{ ref('a') }}", contract=keyed("b", "unique", "not_null")),
          sql("c", "select k + 1 as k from {{ ref('b') }}"), sql("d", "select * from {{ ref('c') }}"),
          sql("e", "select count(*) as n from {{ ref('a') }}"), sql("f", "select no_such_column from {{ ref('e') }}"), sql("g", "select * from {{ ref('f') }}")]
    out = build_models(spark, ms, source(spark, 1, 1, 2, None), root)
    assert status(out) == {"a": "built", "b": "failed", "c": "skipped", "d": "skipped", "e": "built", "f": "error", "g": "skipped"}
    told = {o.model: o for o in out}
    assert told["b"].failures == 2 and told["b"].detail == "k not_null: 1; k unique: 1"
    assert told["c"].detail == "reads b" and "no_such_column" in told["f"].detail
    assert models.read_model(spark, root, "e").collect()[0].n == 4
    with pytest.raises(ValueError, match="no layer"):
        models.read_model(spark, root, "b")
    assert models.build_report(spark, out).where("status = 'failed'").count() == 1


def test_readers_keep_the_last_good_version(spark):
    root = scratch_path(spark, "models")
    ms = [sql("a", "select * from {{ source('raw', 't') }}", contract=keyed("a", "unique")), sql("b", "select max(k) as k from {{ ref('a') }}")]
    assert status(build_models(spark, ms, source(spark, 1, 2), root)) == {"a": "built", "b": "built"}
    assert status(build_models(spark, ms, source(spark, 7, 7), root)) == {"a": "failed", "b": "skipped"}
    assert sorted(r.k for r in models.read_model(spark, root, "a").collect()) == [1, 2]
    assert models.read_model(spark, root, "b").first().k == 2
    assert status(build_models(spark, ms, source(spark, 7, 8), root)) == {"a": "built", "b": "built"}
    assert models.read_model(spark, root, "b").first().k == 8


def test_views_config_and_selection(spark):
    root = scratch_path(spark, "models")
    ms = [sql("v", "{{ config(materialized='view') }} select k, k % 2 as odd from {{ source('raw', 't') }}", contract=keyed("v", "not_null")),
          sql("p", "{{\n config(materialized='table', partition_by=['odd'])\n}}\nselect * from {{ ref('v') }}"), sql("x", "select 1 as one")]
    assert names(o for o in [Model(o.model, "x") for o in build_models(spark, ms, source(spark, 1, 2, 3), root, ["p"])]) == ["v", "p"]
    p = models.read_model(spark, root, "p")
    assert {f.split("odd=")[1][0] for f in p.inputFiles()} == {"0", "1"} and p.count() == 3
    with pytest.raises(ValueError):
        models.read_model(spark, root, "v")
    with pytest.raises(ModelError, match="no model"):
        build_models(spark, ms, source(spark, 1), root, ["q"])
    # a column that the contract names and the model lacks
    lacking = [sql("y", "select 1 as one", contract=keyed("y", "not_null"))]
    assert status(build_models(spark, lacking, {}, root)) == {"y": "failed"}


SILVER_SQL = """-- sales
{{ config(materialized='table', partition_by=['anio_venta']) }}
SELECT id_transaccion AS venta_id, tienda_id, monto, CAST(fecha AS TIMESTAMP_NTZ) AS fecha_venta, YEAR(fecha) AS anio_venta
FROM {{ source('bronze', 'sales') }} WHERE monto > 0"""
GOLD_SQL = "SELECT tienda_id, SUM(monto) AS total FROM {{ ref('silver') }} GROUP BY tienda_id ORDER BY tienda_id"
YAML = """version: 2
sources:
  - name: bronze
    schema: default
    tables:
      - name: sales
        identifier: "%s"
      - name: stores
models:
  - name: silver
    description: "Cleaned: sales"
    columns:
      - name: venta_id
        description: key
        tests: [not_null, unique]
      - name: anio_venta
  - name: gold
    columns:
      - name: tienda_id
        tests:
          - unique
"""


def test_project_in_a_folder(spark, tmp_path):
    pytest.importorskip("yaml")
    data = spark.createDataFrame([(1, 2, 5.0, dt.datetime(2024, 1, 1)), (2, 2, 3.0, dt.datetime(2025, 1, 1)), (3, 1, -1.0, dt.datetime(2025, 1, 1))],
                                 "id_transaccion bigint, tienda_id int, monto double, fecha timestamp_ntz")
    data.write.parquet(f"file://{tmp_path}/bronze")
    for name, text in (("models/silver.sql", SILVER_SQL), ("models/gold/gold.sql", GOLD_SQL), ("models/all.yml", YAML % f"file://{tmp_path}/bronze")):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(text)
    ms, sources = models.load_project(str(tmp_path / "models"))
    assert sources == {"bronze.sales": f"file://{tmp_path}/bronze", "bronze.stores": "default.stores"}
    root = scratch_path(spark, "project")
    assert status(build_models(spark, ms, sources, root)) == {"silver": "built", "gold": "built"}
    assert [tuple(r) for r in models.read_model(spark, root, "gold").collect()] == [(2, 8.0)]
    silver = models.read_model(spark, root, "silver")
    assert silver.schema["venta_id"].metadata["comment"] == "key"
    # the YAML's own tests stop a build
    data.withColumn("id_transaccion", F.lit(1).cast("bigint")).write.mode("overwrite").parquet(f"file://{tmp_path}/bronze")
    out = build_models(spark, ms, sources, root)
    assert status(out) == {"silver": "failed", "gold": "skipped"} and out[0].detail == "venta_id unique: 1"


def test_unknown_tests_are_refused():
    with pytest.raises(ModelError, match="unknown test"):
        models.contract_of({"name": "m", "columns": [{"name": "c", "tests": [{"accepted_values": {"values": [1]}}]}]})
