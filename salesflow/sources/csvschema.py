"""CSV schemas that are inferred once, saved, held against later files and widened.

Inference reads the whole text. ``learned_schema`` does it for the first file only and keeps the result under a path;
``check_csv`` holds a later file against it in one pass and says, column by column, how many texts do not fit and which
type would hold them all; ``update_schema`` widens the saved schema by that report.

Columns are found by the header's names, in any order. Text fits a type where a cast gives a value, and empty text is no
value. Whole numbers widen to BIGINT and to DOUBLE (as long as every number is one that a DOUBLE holds exactly in its
whole part), dates to times without zone, anything to text. Columns are never narrowed or taken away.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .files import csv_scan

#: What texts of a type may be widened to, nearest first; text holds everything.
WIDER: dict[str, list[str]] = {
    "int": ["bigint", "double"], "bigint": ["double"], "double": [], "date": ["timestamp_ntz"], "timestamp_ntz": [],
    "boolean": [], "string": []}
#: Types tried for a column that the schema lacks, in this order.
GUESSES = ["int", "bigint", "double", "date", "timestamp_ntz", "boolean"]
EXACT = 2.0**53


def save_schema(spark: SparkSession, schema: T.StructType, path: str) -> None:
    """The schema as one line of JSON in a folder that any store holds."""
    spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def load_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The schema saved under a path; None if there is none."""
    try:
        lines = spark.read.text(path).collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return T.StructType.fromJson(json.loads(lines[0][0])) if lines else None


def learned_schema(spark: SparkSession, csv_path: str, schema_path: str) -> T.StructType:
    """The saved schema, or that of this file, inferred and saved: only the first call reads the text for it."""
    schema = load_schema(spark, schema_path)
    if schema is None:
        schema = csv_scan(spark, csv_path, infer_schema=True).schema
        save_schema(spark, schema, schema_path)
    return schema


def _text(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).option("enforceSchema", False).csv(path)


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _fits(text: Column, kind: str, whole: bool) -> Column:
    """Whether a text has a value of the type; ``whole`` asks a DOUBLE to keep every digit before the point."""
    value = text.try_cast(kind)
    ok = value.isNotNull()
    if kind == "date":  # the cast would cut a time of day off without a word
        ok &= F.length(F.trim(text)) <= 10
    return ok & (F.abs(value) <= EXACT) if whole and kind == "double" else ok


def _ways(declared: str | None) -> list[str]:
    """The types to try, nearest first."""
    return GUESSES if declared is None else [t for t in [declared, *WIDER.get(declared, [])] if t != "string"]


def check_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One row a column: (column_name, declared, status, filled, misfits, fits).

    ``status``: ok, misfit (some text is no value of the declared type), missing (no such column in the header), extra (not
    in the schema). ``filled`` counts texts, ``misfits`` those that do not fit the declared type, ``fits`` is the nearest type
    that holds all. One aggregate over one scan; a wide file is one row of counters per task.
    """
    raw = _text(spark, path)
    kinds = {f.name: f.dataType.simpleString() for f in schema.fields}
    names = list(kinds) + [c for c in raw.columns if c not in kinds]
    counters, rows = [], []
    for i, name in enumerate(names):
        declared, here = kinds.get(name), name in raw.columns
        if not here:
            rows.append(_row(name, declared, F.lit("missing"), F.lit(0), F.lit(0), F.lit(declared)))
            continue
        ways, filled = _ways(declared), F.col(f"n{i}")
        whole = declared in ("int", "bigint", None)
        counters.append(F.count(_quoted(name)).alias(f"n{i}"))
        counters += [F.count_if(_quoted(name).isNotNull() & ~F.coalesce(_fits(_quoted(name), w, whole and w != declared), F.lit(False)))
                     .alias(f"n{i}_{w}") for w in ways]
        off = {w: F.col(f"n{i}_{w}") for w in ways}
        nearest = F.coalesce(*[F.when(off[w] == 0, F.lit(w)) for w in ways], F.lit("string"))
        if declared is None:
            rows.append(_row(name, None, F.lit("extra"), filled, F.lit(0), F.when(filled > 0, nearest).otherwise("string")))
        else:
            bad = off.get(declared, F.lit(0))
            rows.append(_row(name, declared, F.when(bad > 0, "misfit").otherwise("ok"), filled, bad, nearest))
    counted = raw.agg(*(counters or [F.count("*").alias("n")]))
    return counted.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def _row(name: str, declared: str | None, status: Column, filled: Column, misfits: Column, fits: Column) -> Column:
    return F.struct(F.lit(name).alias("column_name"), F.lit(declared).cast("string").alias("declared"), status.alias("status"),
                    filled.cast("bigint").alias("filled"), misfits.cast("bigint").alias("misfits"), fits.alias("fits"))


def widened(schema: T.StructType, report: DataFrame) -> T.StructType:
    """The schema that holds the checked file too: types widened, extra columns put at the end."""
    found = {r["column_name"]: r for r in report.collect()}  # a row a column
    fields = [T.StructField(f.name, _type(found[f.name]["fits"]) if found[f.name]["status"] == "misfit" else f.dataType, True)
              for f in schema.fields]
    extra = [T.StructField(name, _type(r["fits"]), True) for name, r in found.items() if r["status"] == "extra"]
    return T.StructType(fields + extra)


def _type(kind: str) -> T.DataType:
    return T.StructType.fromDDL(f"c {kind}")["c"].dataType


def update_schema(spark: SparkSession, csv_path: str, schema_path: str) -> T.StructType:
    """The saved schema widened by a file, and saved if it changed. A file that lacks a column of it is no reason to change."""
    schema = learned_schema(spark, csv_path, schema_path)
    wider = widened(schema, check_csv(spark, csv_path, schema))
    if wider != schema:
        save_schema(spark, wider, schema_path)
    return wider


def read_typed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A CSV in the columns of a schema: found by name, missing ones and texts that do not fit are NULL, others left out."""
    raw = _text(spark, path)
    return raw.select(*[
        (_quoted(f.name).try_cast(f.dataType) if f.name in raw.columns else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields])
