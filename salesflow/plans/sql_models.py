"""The silver and gold models as Spark SQL text, for users who keep their models in SQL.

``source`` is anything a FROM clause takes: a table or view name, ``parquet.`/path```, or a
parenthesised subquery. Results equal ``to_silver`` / ``to_gold``: the sums are the very SQL text
that the operators use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.money import exact_avg_sql, exact_sum_sql

SILVER_MODEL = """
SELECT
    id_transaccion AS venta_id,
    tienda_id,
    monto,
    fecha_venta,
    YEAR(fecha_venta) AS anio_venta,
    MONTH(fecha_venta) AS mes_venta,
    DAY(fecha_venta) AS dia_venta,
    DAYOFWEEK(fecha_venta) AS dia_semana_venta
FROM (SELECT *, TRY_CAST(fecha AS TIMESTAMP_NTZ) AS fecha_venta FROM {source})
WHERE monto > 0
"""

GOLD_MODEL = f"""
SELECT
    tienda_id,
    {exact_sum_sql("monto")} AS monto_total_ventas,
    COUNT(venta_id) AS numero_de_transacciones,
    {exact_avg_sql("monto")} AS monto_promedio_por_transaccion
FROM {{source}}
GROUP BY tienda_id
"""


def silver_model(spark: SparkSession, source: str) -> DataFrame:
    return spark.sql(SILVER_MODEL.format(source=source))


def gold_model(spark: SparkSession, source: str) -> DataFrame:
    return spark.sql(GOLD_MODEL.format(source=source))
