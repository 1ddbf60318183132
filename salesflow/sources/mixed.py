"""Parquet folders whose files disagree on their columns' types.

A consumer that takes the types from each batch writes an amount as INT in one file, BIGINT, DOUBLE or text in the
next, and leaves a column out of a third. No single schema reads such a folder. Here the footers are read first, as a distributed
job; files of the same types are one group, each group is scanned by its own schema and every value is brought to the
declared type. A value that does not survive that sets its row aside, with its text and its file; nothing is dropped and
no file stops the job.

A value survives if it can be cast and, between numbers, cast back to what it was: 12.5 is no BIGINT, 2^53 + 1 no DOUBLE. Text
is cast as ``try_cast`` does.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.jsonfmt import row_to_json

UNSUPPORTED = "no file system"
SCHEMA_OF_FOOTERS = "file string, types string, error string"


def _types(footer: pq.FileMetaData, columns: set[str]) -> str:
    """The types of the wanted columns, in one order whatever the file's."""
    schema = footer.schema
    leaves = (schema.column(i) for i in range(len(schema)))
    return "; ".join(sorted(f"{c.path} {c.physical_type} {c.logical_type} {c.max_repetition_level}"
                            for c in leaves if c.path.split(".")[0] in columns))


def _open(path: str):
    local = re.sub("^file:/+", "/", path)
    if local.startswith("/"):
        return pafs.LocalFileSystem().open_input_file(local)
    try:
        system, inner = pafs.FileSystem.from_uri(path)
    except Exception as e:
        raise NotImplementedError(UNSUPPORTED) from e
    return system.open_input_file(inner)


def _footers(batches: Iterable[pa.RecordBatch], columns: set[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        content = batch.column(1) if batch.num_columns > 1 else None
        out = []
        for i, path in enumerate(batch.column(0).to_pylist()):
            types = error = None
            try:
                with (_open(path) if content is None else pa.BufferReader(content[i].as_buffer())) as f:
                    types = _types(pq.read_metadata(f), columns)
            except NotImplementedError:
                error = UNSUPPORTED
            except Exception as e:  # not a Parquet file, or a broken one
                error = str(e)[:500]
            out.append((path, types, error))
        cols = list(zip(*out)) or [[]] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in cols], ["file", "types", "error"])


def footers(spark: SparkSession, path: str, columns: Iterable[str]) -> DataFrame:
    """(file, types, error) of every file below a path: the types of the wanted columns, from its footer alone.

    Executors open the files through pyarrow (local paths, HDFS, S3, GCS, ABFS). Files in a store that only Spark's own
    readers reach are read whole for their footer.
    """
    wanted = set(columns)
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path))
    read = files.select("path").mapInArrow(lambda b: _footers(b, wanted), SCHEMA_OF_FOOTERS)
    if read.where(F.col("error") == UNSUPPORTED).isEmpty():
        return read
    return files.select("path", "content").mapInArrow(lambda b: _footers(b, wanted), SCHEMA_OF_FOOTERS)


def _brought(df: DataFrame, field: T.StructField) -> tuple[Column, Column]:
    """(the value in the declared type, whether it survived); types that have no cast survive as NULL only."""
    missing = F.lit(None).cast(field.dataType)
    if field.name not in df.columns:
        return missing, F.lit(True)
    old, kind = F.col(f"`{field.name}`"), df.schema[field.name].dataType
    if kind == field.dataType:
        return old, F.lit(True)
    new = old.try_cast(field.dataType)
    same = old.isNull() | new.isNotNull()
    if isinstance(kind, T.NumericType) and isinstance(field.dataType, T.NumericType):
        back = new.try_cast(kind)
        nan = F.isnan(old) if isinstance(kind, (T.DoubleType, T.FloatType)) and isinstance(field.dataType, (T.DoubleType, T.FloatType)) else F.lit(False)
        same = old.isNull() | F.coalesce(back == old, F.lit(False)) | nan
    try:
        df.select(new, same)
    except AnalysisException:
        return missing, old.isNull()
    return new, same


def read_mixed_parquet(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Every row below a path: the declared columns, ``file``, ``failed_columns`` (NULL for a good row) and ``raw``, the
    row as JSON in its own types (NULL for a good row). Split it with ``good_rows`` and ``rejected_rows``.

    There is one scan for each combination of types that the files have in the declared columns. The file names come to
    the driver, as they do in any listing of a table's files. A file without a readable footer raises: list them with ``footers``.
    """
    read = footers(spark, path, schema.names).persist()
    try:
        broken = read.where("error IS NOT NULL").limit(5).collect()
        if broken:
            raise ValueError("files without a readable footer: " + "; ".join(f"{r.file}: {r.error}" for r in broken))
        groups = read.groupBy("types").agg(F.array_sort(F.collect_list("file")).alias("files")).orderBy("types").collect()
    finally:
        read.unpersist()
    empty = spark.createDataFrame([], T.StructType([*schema.fields, *[T.StructField(c, T.StringType()) for c in ("file", "failed_columns", "raw")]]))
    return reduce(DataFrame.unionByName, [_group(spark, g["files"], schema) for g in groups], empty)


def _group(spark: SparkSession, files: list[str], schema: T.StructType) -> DataFrame:
    own = spark.read.parquet(*files)
    present = own.select(*[F.col(f"`{f.name}`") for f in schema.fields if f.name in own.columns])
    made = {f.name: _brought(present, f) for f in schema.fields}
    failed = F.concat_ws(",", *[F.when(~ok, F.lit(n)) for n, (_, ok) in made.items()])
    raw = row_to_json(present) if present.columns else F.lit("{}")
    return own.select(*[v.alias(n) for n, (v, _) in made.items()], F.col("_metadata.file_path").alias("file"),
                      F.when(failed != "", failed).alias("failed_columns"), F.when(failed != "", raw).alias("raw"))


def good_rows(mixed: DataFrame, schema: T.StructType) -> DataFrame:
    return mixed.where("failed_columns IS NULL").select(*[f"`{n}`" for n in schema.names])


def rejected_rows(mixed: DataFrame) -> DataFrame:
    """(file, failed_columns, raw) of the rows that don't fit the declared types."""
    return mixed.where("failed_columns IS NOT NULL").select("file", "failed_columns", "raw")
