"""Date parts and epoch conversions, zone-free on TIMESTAMP_NTZ; ``instant`` is the one way into a zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

EPOCH_NTZ_SQL = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_timestamp(c: Column | str, dtype: T.DataType | None = None) -> Column:
    """Column as TIMESTAMP_NTZ; text is parsed (NULL if unparsable), timestamps pass through."""
    col = _col(c)
    if isinstance(dtype, T.TimestampNTZType):
        return col
    return col.try_cast(T.TimestampNTZType())


def date_parts(ts: Column | str) -> dict[str, Column]:
    """Year, month, day of month and day of week (1 = Sunday ... 7 = Saturday)."""
    col = _col(ts)
    return {
        "anio_venta": F.year(col),
        "mes_venta": F.month(col),
        "dia_venta": F.dayofmonth(col),
        "dia_semana_venta": F.dayofweek(col),
    }


def epoch_seconds(ts: Column | str) -> Column:
    """Whole seconds since 1970-01-01 00:00:00 of a TIMESTAMP_NTZ (no zone shift)."""
    return F.unix_timestamp(_col(ts))


def from_epoch_seconds(seconds: Column | str) -> Column:
    """TIMESTAMP_NTZ from seconds since 1970-01-01 00:00:00 (as ``to_datetime(unit='s')``)."""
    return F.timestamp_add("SECOND", _col(seconds), F.expr(EPOCH_NTZ_SQL))


def instant(wall: Column | str, zone: str) -> Column:
    """TIMESTAMP of a wall-clock time in a zone. A time that clocks skip counts as the hour after, one they repeat as the first."""
    c = _col(wall)
    return F.make_timestamp_ltz(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), F.minute(c),
                                F.extract(F.lit("SECOND"), c), F.lit(zone))
