"""Declared schemas of the sale entity in each shape, and the column contracts of the layers.

Shapes: raw text (CSV), bronze (typed), silver (cleaned, date parts), gold (per store), and the
sale event carried as a JSON message.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Raw CSV: every column read as text; typing happens in bronze.
RAW_SALES = T.StructType([
    T.StructField("id_transaccion", T.StringType()),
    T.StructField("tienda_id", T.StringType()),
    T.StructField("monto", T.StringType()),
    T.StructField("fecha", T.StringType()),
])

# Bronze: ids widened to BIGINT (ids above 2^31-1 exist at scale); sale time is a wall-clock
# time without zone, as the source text carries none.
BRONZE_SALES = T.StructType([
    T.StructField("id_transaccion", T.LongType()),
    T.StructField("tienda_id", T.IntegerType()),
    T.StructField("monto", T.DoubleType()),
    T.StructField("fecha", T.TimestampNTZType()),
])

# Sale event as decoded from a message. Superset of what producers send: `id` is the field
# name the producer uses, `id_transaccion` the one the consumer expects; both are kept and
# merged after decoding. `_corrupt_record` receives the raw text of malformed messages.
CORRUPT_COLUMN = "_corrupt_record"
SALE_EVENT = T.StructType([
    T.StructField("id_transaccion", T.StringType()),
    T.StructField("id", T.StringType()),
    T.StructField("tienda_id", T.StringType()),
    T.StructField("producto_id", T.StringType()),
    T.StructField("monto", T.DoubleType()),
    T.StructField("fecha", T.TimestampNTZType()),
    T.StructField(CORRUPT_COLUMN, T.StringType()),
])

# Where a message stream lands: every message is one row, good or not, with its text as it came, so that keys
# outside the declared event are not lost. ``route`` tells good events from quarantined messages.
GOOD, QUARANTINE = "good", "quarantine"
LANDING = T.StructType([
    T.StructField("id_transaccion", T.StringType()),
    T.StructField("tienda_id", T.StringType()),
    T.StructField("producto_id", T.StringType()),
    T.StructField("monto", T.DoubleType()),
    T.StructField("fecha", T.TimestampNTZType()),
    T.StructField("raw", T.StringType()),
    T.StructField("reason", T.StringType()),
    T.StructField("route", T.StringType()),
])
LANDING_DDL = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in LANDING.fields)

# Shape of a message as a broker source yields it (the parts decoding needs).
MESSAGE = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
])


@dataclass(frozen=True)
class ColumnContract:
    name: str
    description: str
    tests: tuple[str, ...] = ()


@dataclass(frozen=True)
class ModelContract:
    name: str
    description: str
    columns: tuple[ColumnContract, ...] = field(default_factory=tuple)

    def tested(self, test: str) -> list[str]:
        return [c.name for c in self.columns if test in c.tests]

    def descriptions(self) -> dict[str, str]:
        return {c.name: c.description for c in self.columns}


SILVER_CONTRACT = ModelContract(
    name="silver_sales",
    description="Cleaned sales from bronze; one row per sale transaction.",
    columns=(
        ColumnContract("venta_id", "Identifier of the sale transaction.", ("not_null",)),
        ColumnContract("tienda_id", "Store where the sale happened.", ("not_null",)),
        ColumnContract("monto", "Amount of the sale; zero, negative and missing amounts removed.",
                       ("not_null",)),
        ColumnContract("fecha_venta", "Date and time of the sale.", ("not_null",)),
        ColumnContract("anio_venta", "Year of the sale."),
        ColumnContract("mes_venta", "Month of the sale."),
        ColumnContract("dia_venta", "Day of month of the sale."),
        ColumnContract("dia_semana_venta", "Day of week of the sale, 1 = Sunday ... 7 = Saturday."),
    ),
)

GOLD_CONTRACT = ModelContract(
    name="gold_store_sales",
    description="Sales metrics per store.",
    columns=(
        ColumnContract("tienda_id", "Store identifier; the key of this model.", ("unique", "not_null")),
        ColumnContract("monto_total_ventas", "Sum of the amounts of the store's sales.", ("not_null",)),
        ColumnContract("numero_de_transacciones", "Number of sales with an identifier.", ("not_null",)),
        ColumnContract("monto_promedio_por_transaccion", "Average amount per sale.", ("not_null",)),
    ),
)
