"""JSON text in and out of rows."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import CORRUPT_COLUMN

# Fixed format of timestamps inside messages and CSV files: full microseconds, so values
# round-trip exactly (writers default to milliseconds).
TIMESTAMP_TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def json_write_options() -> dict[str, str]:
    """Writer options of message JSON: NULL fields kept; zone-free timestamps in full."""
    return {"ignoreNullFields": "false", "timestampNTZFormat": TIMESTAMP_TEXT_FORMAT}


def row_to_json(df: DataFrame, columns: list[str] | None = None) -> Column:
    """One JSON object per row; NULL fields written as ``null``; timestamps as full text.

    TIMESTAMP_NTZ values are written by the JSON writer itself (no zone involved); zoned
    TIMESTAMP values are written as wall-clock text in the session zone.
    """
    fields = []
    for f in df.schema.fields:
        if columns is not None and f.name not in columns:
            continue
        c = F.col(f.name)
        if isinstance(f.dataType, T.TimestampType):
            c = F.date_format(c, TIMESTAMP_TEXT_FORMAT)
        fields.append(c.alias(f.name))
    return F.to_json(F.struct(*fields), json_write_options())


def parse_json_permissive(text: Column, schema: T.StructType) -> Column:
    """Parse JSON by a declared schema; malformed text lands in ``_corrupt_record``.

    Timestamps use Spark's default parser, which takes both ``yyyy-MM-dd HH:mm:ss[.ffffff]``
    and the ISO ``T`` form; it is about twice as fast as a pattern-based formatter.
    """
    return F.from_json(text, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN})


MAX_KEYS = 2000


def infer_json_schema(df: DataFrame, column: str, max_keys: int = MAX_KEYS) -> str:
    """Infer one merged schema (as DDL) for a JSON text column, once, across all rows.

    The merge runs as a distributed aggregate (partial merge per task, then final); only the
    schema string reaches the driver. A merged schema grows with the number of different keys, so that is estimated
    first (a sketch of fixed size): a column that uses keys as data raises an error instead of
    growing without end. A key with two types becomes text. Declare the schema where it is known.
    """
    keys = (df.select(F.explode(F.json_object_keys(F.col(column))).alias("k"))
            .agg(F.approx_count_distinct("k").alias("n")).first()["n"])
    if keys > max_keys:
        raise ValueError(f"column {column!r} has about {keys} different keys (at most {max_keys} are merged): declare a schema")
    is_object = F.json_object_keys(F.col(column)).isNotNull()  # other JSON has no columns to give
    ddl = (df.select(F.schema_of_variant_agg(F.when(is_object, F.try_parse_json(F.col(column)))).alias("s"))
           .first()["s"])
    if ddl is None or not ddl.startswith("OBJECT<"):
        raise ValueError(f"column {column!r} holds no JSON objects")
    # Variant schema names objects OBJECT<...> and untyped nulls VOID; DDL says STRUCT / STRING.
    # Only type positions change: text inside backquotes is a field name, and so is a bare word
    # followed by a colon (a field may be called VOID).
    parts = ddl.split("`")
    for i in range(0, len(parts), 2):
        parts[i] = re.sub(r"\bOBJECT<", "STRUCT<", parts[i])
        parts[i] = re.sub(r"\b(VOID|VARIANT)\b(?!\s*:)", "STRING", parts[i])
    return "`".join(parts)
