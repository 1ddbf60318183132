"""Tables as keyed JSON messages and back.

Encoding is a projection (key text + JSON text per row). Decoding parses by a declared schema
in PERMISSIVE mode; good rows and quarantined rows come out of the same parse.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.jsonfmt import infer_json_schema, parse_json_permissive, row_to_json
from ..schemas import CORRUPT_COLUMN, GOOD, QUARANTINE, SALE_EVENT


def encode_messages(df: DataFrame, key: str | None = "tienda_id", columns: list[str] | None = None,
                    also: Sequence[Column] = ()) -> DataFrame:
    """(key, value) text per row: key = the key column as text ('' when NULL), value = JSON; ``also`` are further columns.

    A broker assigns partitions by key, so rows are not grouped by key here (``operators.ordered`` numbers them within it).
    """
    key_col = F.coalesce(F.col(key).cast("string"), F.lit("")) if key else F.lit(None).cast("string")
    return df.select(key_col.alias("key"), row_to_json(df, columns).alias("value"), *also)


def as_binary_messages(messages: DataFrame) -> DataFrame:
    """Key and value as bytes, the form broker sinks and sources carry."""
    return messages.select(F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"))


def parse_messages(messages: DataFrame) -> DataFrame:
    """Parse each message value (text or bytes) by the sale-event schema.

    Output: ``raw`` (the text), ``data`` (the parsed struct, NULL for NULL/blank values) and
    ``reason`` (NULL for a good row, else why it is quarantined).

    The parse sits in a one-element ``explode``: filters on its result cannot be pushed below
    it, so each message is parsed once (a plain projection would be re-parsed inside every
    pushed-down filter and again in the final projection).
    """
    text = F.col("value").cast("string")
    parsed = messages.select(
        text.alias("raw"), F.explode(F.array(parse_json_permissive(text, SALE_EVENT))).alias("data"))
    reason = (F.when(F.col("data").isNull(), F.lit("empty_message"))
              .when(F.col(f"data.{CORRUPT_COLUMN}").isNotNull(), F.lit("malformed")))
    return parsed.withColumn("reason", reason)


def landed(messages: DataFrame) -> DataFrame:
    """Every message as one row: the decoded fields, its text, why it is not good (if so) and its route.

    The id is taken from ``id_transaccion`` or, failing that, ``id``. A message that fits the declared event
    only in part keeps the fields that do.
    """
    return parse_messages(messages).select(
        F.coalesce(F.col("data.id_transaccion"), F.col("data.id")).alias("id_transaccion"),
        F.col("data.tienda_id").alias("tienda_id"),
        F.col("data.producto_id").alias("producto_id"),
        F.col("data.monto").alias("monto"),
        F.col("data.fecha").alias("fecha"),
        "raw", "reason",
        F.when(F.col("reason").isNull(), F.lit(GOOD)).otherwise(F.lit(QUARANTINE)).alias("route"),
    )


def good_events(landing: DataFrame) -> DataFrame:
    """The sale events of a landing table."""
    return landing.filter(F.col("route") == GOOD).select("id_transaccion", "tienda_id", "producto_id", "monto", "fecha")


def quarantined(landing: DataFrame) -> DataFrame:
    """The messages of a landing table that could not be decoded: text, reason and the parts that did parse."""
    return landing.filter(F.col("route") == QUARANTINE).select(
        "raw", "reason", "id_transaccion", "tienda_id", "monto", "fecha")


def decode_messages(messages: DataFrame) -> DataFrame:
    """Good sale events from a message frame (batch or streaming)."""
    return good_events(landed(messages))


def split_quarantine(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, quarantine) from one parse definition; works on batch and streaming frames."""
    landing = landed(messages)
    return good_events(landing), quarantined(landing)


def parse_json_column(df: DataFrame, column: str, ddl: str, keep: list[str] | None = None) -> DataFrame:
    """Expand a JSON text column into top-level columns by a schema given as DDL; bad text gives NULLs."""
    keep = keep if keep is not None else [c for c in df.columns if c != column]
    return df.select(*keep, F.from_json(F.col(column), ddl).alias("_j")).select(*keep, "_j.*")


def split_json_column(df: DataFrame, column: str, ddl: str | None = None,
                      keep: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(good, bad): a JSON text column expanded by a schema, and the text that does not fit it.

    ``ddl`` is the declared schema; without one it is inferred, which reads the column twice more. Text that is not
    a JSON object, or holds another type than the schema's, is in ``bad`` as ``raw`` with its ``reason`` and
    nowhere else. NULL and blank text is no message: it stays in ``good`` with NULL columns.
    """
    keep = keep if keep is not None else [c for c in df.columns if c != column]
    schema = T._parse_datatype_string(ddl or infer_json_schema(df, column))
    corrupt = T.StructField(CORRUPT_COLUMN, T.StringType())
    # one-element explode: the text is parsed once, whatever is filtered on the result
    parsed = df.select(*keep, F.col(column).alias("raw"), F.explode(F.array(
        parse_json_permissive(F.col(column), T.StructType([*schema.fields, corrupt])))).alias("_j"))
    good = parsed.filter(F.col(f"_j.{CORRUPT_COLUMN}").isNull()).select(
        *keep, *[F.col("_j")[f.name].alias(f.name) for f in schema.fields])
    bad = parsed.filter(F.col(f"_j.{CORRUPT_COLUMN}").isNotNull()).select(*keep, "raw", F.lit("malformed").alias("reason"))
    return good, bad
