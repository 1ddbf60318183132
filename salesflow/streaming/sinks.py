"""Streaming sinks (append to a table, append Parquet files) and the batch message sink.

Every streaming write has a checkpoint location: offsets are logged before a batch runs and
committed after its output is committed, so a restart resumes where the last run stopped and
replays an unfinished batch. File and table sinks keep their own commit log, which makes the
output exactly-once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..schemas import LANDING_DDL

# Fixed value, as the reference's stream job uses it: one micro-batch every 30 seconds.
PRODUCTION_TRIGGER = {"processingTime": "30 seconds"}


class SchemaDrift(ValueError):
    """A present table has another shape than the declared one, and not one it can be brought to."""


# What a column may be widened to without rewriting what is stored: every value keeps its meaning.
WIDER = {
    "tinyint": ("smallint", "int", "bigint"),
    "smallint": ("int", "bigint"),
    "int": ("bigint",),
    "float": ("double",),
    "date": ("timestamp_ntz",),
}


def _widens(old: T.DataType, new: T.DataType) -> bool:
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        return new.scale >= old.scale and new.precision - new.scale >= old.precision - old.scale
    return new.simpleString() in WIDER.get(old.simpleString(), ())


def schema_changes(present: T.StructType, declared: T.StructType) -> tuple[list[T.StructField], list[tuple[str, T.DataType]]]:
    """(columns to add, columns to widen) that bring a table to the declared shape. Anything else raises: a column that is
    missing from the declaration, or one whose type is no wider. Names are compared as Spark does, without case."""
    old, new = {f.name.lower(): f for f in present.fields}, {f.name.lower(): f for f in declared.fields}
    wrong = [f"{f.name} is not declared any more" for n, f in old.items() if n not in new]
    wider = []
    for n, f in new.items():
        if n in old and old[n].dataType != f.dataType:
            if _widens(old[n].dataType, f.dataType):
                wider.append((old[n].name, f.dataType))
            else:
                wrong.append(f"{f.name} is {old[n].dataType.simpleString()}, not {f.dataType.simpleString()}")
    if wrong:
        raise SchemaDrift("; ".join(wrong))
    return [f for n, f in new.items() if n not in old], wider


def ensure_table(spark: SparkSession, table: str, ddl: str = LANDING_DDL,
                 provider: str = "parquet", location: str | None = None,
                 partition_by: list[str] | None = None, evolve: bool = False) -> str:
    """Idempotent DDL: create the table if it does not exist yet. One that exists must have the declared shape.

    With ``evolve`` it is brought to that shape where that is safe: columns are added (old rows have NULL there) and types
    widened. Other differences raise ``SchemaDrift``, and so does any difference without ``evolve``.
    A table format widens by its own metadata. Plain Parquet files keep their types and are read by the wider one, so their table must
    have a location of its own: its entry is made anew over the same files.
    ``partition_by`` is for table formats, whose own metadata tells readers of new partitions.
    """
    if location and "'" in location:
        raise ValueError("location must not contain a single quote")
    loc = f" LOCATION '{location}'" if location else ""
    parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    create = f"CREATE TABLE IF NOT EXISTS {table} ({{ddl}}) USING {provider}{parts}{loc}"
    if not spark.catalog.tableExists(table):
        spark.sql(create.format(ddl=ddl))
        return table
    present, declared = spark.table(table).schema, T._parse_datatype_string(ddl)
    added, wider = schema_changes(present, declared)
    if (added or wider) and not evolve:
        changes = [f"{f.name} is new" for f in added] + [f"{n} is now {t.simpleString()}" for n, t in wider]
        raise SchemaDrift(f"{table} has an older shape ({'; '.join(changes)}): pass evolve=True to bring it to the declared one")
    if wider and provider == "parquet":
        _widen_files(spark, table, create, present, dict(wider), location)
    else:
        for n, t in wider:
            spark.sql(f"ALTER TABLE {table} ALTER COLUMN `{n}` TYPE {t.simpleString()}")
    if added:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in added)})")
    return table


def _widen_files(spark: SparkSession, table: str, create: str, present: T.StructType, wider: dict, location: str | None) -> None:
    """Make the catalog entry anew with wider types; the files stay, as the table is external."""
    told = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    if told.get("Type") != "EXTERNAL" or not location:
        raise SchemaDrift(f"{table} is managed by the catalog: its Parquet columns can only be widened with a location of their own")
    if told["Location"].rstrip("/").split(":", 1)[-1].lstrip("/") != location.rstrip("/").split(":", 1)[-1].lstrip("/"):
        raise SchemaDrift(f"{table} is at {told['Location']}, not at {location}")
    columns = ", ".join(f"`{f.name}` {wider.get(f.name, f.dataType).simpleString()}" for f in present.fields)
    spark.sql(f"DROP TABLE {table}")
    spark.sql(create.format(ddl=columns))


def _trigger(writer, trigger: dict | None):
    """None: the production interval; an empty dict: no interval, each batch follows the last at once."""
    trigger = PRODUCTION_TRIGGER if trigger is None else trigger
    return writer.trigger(**trigger) if trigger else writer


def start(writer, trigger: dict | None = None) -> StreamingQuery:
    """Start a stream writer that needs no path or table (one batch function)."""
    return _trigger(writer, trigger).start()


def append_to_table(df: DataFrame, table: str, checkpoint: str, trigger: dict | None = None,
                    query_name: str | None = None) -> StreamingQuery:
    """Append a stream to a catalog table (the table must exist; see ``ensure_table``)."""
    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if query_name:
        writer = writer.queryName(query_name)
    return _trigger(writer, trigger).toTable(table)


def append_to_parquet(df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
                      partition_by: list[str] | None = None) -> StreamingQuery:
    """Append a stream as Parquet files under ``path``; each micro-batch adds uniquely named
    files, recorded in the sink's log (readers of ``path`` see only committed batches)."""
    writer = (df.writeStream.format("parquet").outputMode("append")
              .option("path", path).option("checkpointLocation", checkpoint))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return _trigger(writer, trigger).start()


def publish(messages: DataFrame, fmt: str = "kafka", options: dict | None = None,
            path: str | None = None, mode: str = "append") -> None:
    """Write (key, value) messages with a batch sink: a broker topic in production, files in
    tests. Every task writes its own rows; nothing passes through the driver.

    A broker sink is at-least-once: a task that is run again sends its rows again.
    """
    writer = messages.write.format(fmt).mode(mode)
    for k, v in (options or {}).items():
        writer = writer.option(k, v)
    writer.save(path) if path else writer.save()


def run_to_completion(query: StreamingQuery, timeout_s: float | None = None) -> StreamingQuery:
    """Wait for a query started with an ``availableNow`` trigger to finish; raise its error.

    It waits as long as the data take, unless the caller sets a limit.
    """
    if timeout_s is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_s):
        query.stop()
        raise TimeoutError(f"streaming query {query.name or query.id} did not finish in {timeout_s}s")
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return query
