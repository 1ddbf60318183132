import datetime as dt
from zoneinfo import ZoneInfo

import pytest

from salesflow.operators import layers
from salesflow.plans.bronze import ingest_bronze, ingest_landing
from salesflow.schemas import RAW_SALES
from salesflow.session import scratch_path
from salesflow.sources.files import write_csv

ROWS = [("1", "2", "3.5", "2021-01-02 03:04:05", "k"), ("x", "", "abc", "nope", "l"), ("3000000000", "5", "NaN", "2021-01-02", None),
        (None, None, None, None, None), ("x", "", "abc", "nope", "l")]
DDL = ", ".join(f"{c} string" for c in RAW_SALES.names) + ", extra string"


def rows(df):
    return sorted(map(str, map(tuple, df.collect())))


def test_the_landing_holds_bronze_and_rejects(spark):
    raw = spark.createDataFrame(ROWS, DDL)
    landing = layers.bronze_landing(raw)
    assert layers.landing_bronze(landing).schema.simpleString() == layers.to_bronze(raw).schema.simpleString()
    assert rows(layers.landing_bronze(landing)) == rows(layers.to_bronze(raw))
    assert rows(layers.landing_rejects(landing)) == rows(layers.bronze_rejects(raw)) and layers.landing_rejects(landing).count() == 3
    with pytest.raises(ValueError, match="raw_text"):
        layers.bronze_landing(raw.withColumn("raw_text", raw.extra))


def test_written_once_and_read_back_in_part(spark):
    path = write_csv(spark.createDataFrame(ROWS, DDL), scratch_path(spark, "csv"))
    landing, bronze, rejects = (scratch_path(spark, n) for n in ("landing", "bronze", "rejects"))
    assert ingest_landing(spark, path, landing).first().source_bytes > 0
    ingest_bronze(spark, path, bronze, rejects)
    landed = spark.read.parquet(landing)
    assert rows(layers.landing_bronze(landed)) == rows(spark.read.parquet(bronze))
    assert rows(layers.landing_rejects(landed)) == rows(spark.read.parquet(rejects))
    good, bad = (d._jdf.queryExecution().executedPlan().toString() for d in (layers.landing_bronze(landed), layers.landing_rejects(landed)))
    assert "raw_text" not in good and "failed_columns" not in good
    assert "IsNotNull(failed_columns)" in bad and "monto:double" not in bad.partition("ReadSchema")[2]


@pytest.mark.parametrize("zone", ["America/Bogota", "Europe/Madrid", "+05:30"])
def test_instants_of_a_zone(spark, zone):
    """Summer and winter, a skipped hour, a repeated one, microseconds and nulls, whatever the session's zone."""
    walls = [dt.datetime(2024, 1, 2, 3, 4, 5, 678901), dt.datetime(2024, 7, 2, 23, 59, 59, 999999), dt.datetime(2024, 3, 31, 2, 30),
             dt.datetime(2024, 10, 27, 2, 30), dt.datetime(1969, 12, 31, 23, 0, 0, 1), None]
    silver = spark.createDataFrame([(i, w) for i, w in enumerate(walls)], "venta_id int, fecha_venta timestamp_ntz")
    tz = dt.timezone(dt.timedelta(hours=5, minutes=30)) if zone[0] == "+" else ZoneInfo(zone)
    epoch = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)
    want = [w and (w.replace(tzinfo=tz) - epoch) // dt.timedelta(microseconds=1) for w in walls]
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for session in ("UTC", "Asia/Tokyo", "Europe/Madrid"):
            spark.conf.set("spark.sql.session.timeZone", session)
            got = layers.zoned_silver(silver, zone).selectExpr("unix_micros(fecha_venta) AS us").collect()
            assert [r.us for r in got] == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
