"""The sales layers as a model graph: one staging view, silver, two gold models and a report that reads both."""

from __future__ import annotations

from ..functions.money import exact_sum_sql
from ..operators.layers import SILVER_PARTITIONS, to_gold
from ..schemas import GOLD_CONTRACT, SILVER_CONTRACT, ColumnContract, ModelContract
from .models import Model
from .sql_models import SILVER_MODEL

SOURCE = "bronze.sales"

STAGING = """{{ config(materialized='view') }}
SELECT id_transaccion, tienda_id, monto, fecha FROM {{ source('bronze', 'sales') }}"""

MONTHS = f"""
SELECT tienda_id, anio_venta, mes_venta, {exact_sum_sql("monto")} AS monto_mes, COUNT(venta_id) AS ventas_mes
FROM {{{{ ref('silver_sales') }}}}
GROUP BY tienda_id, anio_venta, mes_venta"""

REPORT = """
SELECT s.tienda_id, s.monto_total_ventas, s.numero_de_transacciones, COUNT(*) AS meses, MAX(m.monto_mes) AS mejor_mes
FROM {{ ref('gold_store_sales') }} s JOIN {{ ref('gold_store_months') }} m ON s.tienda_id <=> m.tienda_id
GROUP BY s.tienda_id, s.monto_total_ventas, s.numero_de_transacciones"""


def _tested(name: str, description: str, **tests: tuple[str, ...]) -> ModelContract:
    return ModelContract(name, description, tuple(ColumnContract(c, "", t) for c, t in tests.items()))


SALES_MODELS = [
    Model("report_stores", REPORT, contract=_tested("report_stores", "Stores with their best month.", tienda_id=("unique", "not_null"), mejor_mes=("not_null",))),
    Model("gold_store_months", MONTHS, contract=_tested("gold_store_months", "Sales per store and month.", tienda_id=("not_null",), monto_mes=("not_null",))),
    Model("gold_store_sales", build=lambda spark, silver: to_gold(silver), reads=("silver_sales",), contract=GOLD_CONTRACT),
    Model("silver_sales", SILVER_MODEL.format(source="{{ ref('staged_sales') }}"), contract=SILVER_CONTRACT, partition_by=tuple(SILVER_PARTITIONS)),
    Model("staged_sales", STAGING),
]
