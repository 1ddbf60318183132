"""Medallion layers: raw text -> bronze (typed) -> silver (clean) -> gold (per store)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import as_timestamp, date_parts, instant
from ..functions.money import exact_avg, exact_sum
from ..schemas import BRONZE_SALES, GOLD_CONTRACT, SILVER_CONTRACT, ModelContract


def _typed(df: DataFrame) -> dict[str, F.Column]:
    out = {}
    for f in BRONZE_SALES.fields:
        c = F.col(f.name).try_cast(f.dataType)
        if f.name == "monto":  # an amount that is not finite is treated as missing
            c = F.when((c > float("-inf")) & (c < float("inf")), c)
        out[f.name] = c
    return out


def to_bronze(raw: DataFrame) -> DataFrame:
    """Type raw sale text in one projection; text that does not fit its type becomes NULL.

    The declared columns come first; every other column of the input follows unchanged.
    """
    typed = _typed(raw)
    return raw.select(*[typed[f.name].alias(f.name) for f in BRONZE_SALES.fields],
                      *[F.col(f"`{c}`") for c in raw.columns if c not in typed])


def _failures(raw: DataFrame) -> tuple[Column, Column]:
    """Whether some non-NULL text of a row did not survive typing, and the names of those columns in declared order."""
    typed = _typed(raw)
    failed = {name: F.col(name).isNotNull() & typed[name].isNull() for name in typed}
    any_failed = F.lit(False)
    for cond in failed.values():
        any_failed = any_failed | cond
    return any_failed, F.concat_ws(",", *[F.when(failed[n], F.lit(n)) for n in typed])


def bronze_rejects(raw: DataFrame) -> DataFrame:
    """Raw rows where some non-NULL text did not survive typing, with the failing columns.

    ``failed_columns`` lists the columns in declared order, comma separated.
    """
    any_failed, names = _failures(raw)
    return raw.filter(any_failed).select(*[F.col(f.name) for f in BRONZE_SALES.fields], names.alias("failed_columns"))


def bronze_landing(raw: DataFrame) -> DataFrame:
    """Bronze with its rejects in the same rows, so that the text is read and written once.

    Next to the typed columns, a row with text that did not survive typing has ``failed_columns`` and its
    declared texts as they came in ``raw_text``; both are NULL in every other row and cost nothing there.
    ``landing_bronze`` and ``landing_rejects`` are the two views of it.
    """
    clash = {"failed_columns", "raw_text"} & set(raw.columns)
    if clash:
        raise ValueError(f"the input has columns of the landing: {', '.join(sorted(clash))}")
    any_failed, names = _failures(raw)
    texts = F.struct(*[F.col(f.name) for f in BRONZE_SALES.fields])
    typed = _typed(raw)
    return raw.select(*[typed[f.name].alias(f.name) for f in BRONZE_SALES.fields],
                      *[F.col(f"`{c}`") for c in raw.columns if c not in typed],
                      F.when(any_failed, names).alias("failed_columns"), F.when(any_failed, texts).alias("raw_text"))


def landing_bronze(landing: DataFrame) -> DataFrame:
    """The bronze rows of a landing; the scan reads neither texts nor names of failed columns."""
    return landing.drop("failed_columns", "raw_text")


def landing_rejects(landing: DataFrame) -> DataFrame:
    """The rejected rows of a landing as ``bronze_rejects`` gives them; the filter reaches the scan."""
    return landing.filter(F.col("failed_columns").isNotNull()).select("raw_text.*", "failed_columns")


def to_silver(bronze: DataFrame) -> DataFrame:
    """Keep positive amounts, rename the id, derive date parts (timestamp parsed once)."""
    dtype = bronze.schema["fecha"].dataType
    ts = as_timestamp("fecha", dtype)
    parts = date_parts(F.col("fecha_venta"))
    return (bronze.filter(F.col("monto") > 0)
            .select(F.col("id_transaccion").alias("venta_id"), "tienda_id", "monto",
                    ts.alias("fecha_venta"))
            .select("venta_id", "tienda_id", "monto", "fecha_venta",
                    *[c.alias(n) for n, c in parts.items()]))


def zoned_silver(silver: DataFrame, zone: str) -> DataFrame:
    """Silver whose sale time is an instant: the wall clock of the text, read in a zone of the caller's choice.

    The date parts stay those of the wall clock. The result doesn't depend on the session's zone.
    """
    return silver.withColumn("fecha_venta", instant("fecha_venta", zone))


def to_gold(silver: DataFrame, more: Sequence[Column] = ()) -> DataFrame:
    """Per store: exact total, number of sales with an id, exact mean amount.

    No global order: the result stays hash-partitioned by store, so a join or regroup on the
    store downstream needs no new shuffle. Sort where order is the point (reports, previews).
    """
    return (silver.groupBy("tienda_id")
            .agg(exact_sum("monto").alias("monto_total_ventas"),
                 F.count("venta_id").alias("numero_de_transacciones"),
                 exact_avg("monto").alias("monto_promedio_por_transaccion"), *more))


def silver_gold_report(silver: DataFrame, gold_model: Callable[..., DataFrame] = to_gold) -> DataFrame:
    """The contract tests of silver and of the gold made from it, from one pass over silver.

    Silver's NULL counts ride along with the per-store aggregates of gold: what is tested afterwards has one row per
    store. Gold's key is counted over its rows, which are already partitioned by it, so the test costs no further shuffle.
    """
    nulls = {c: f"__null_{c}" for c in SILVER_CONTRACT.tested("not_null")}
    gold = gold_model(silver, [F.count_if(F.col(c).isNull()).alias(n) for c, n in nulls.items()])
    (key,), rows = GOLD_CONTRACT.tested("unique"), F.col("__rows")
    tested = GOLD_CONTRACT.tested("not_null")
    per_key = gold.groupBy(key).agg(F.count(F.lit(1)).alias("__rows"), *[F.sum(n).alias(n) for n in nulls.values()],
                                    *[F.count_if(F.col(c).isNull()).alias(f"__gold_{c}") for c in tested])
    counts = {"unique": F.count_if(F.col(key).isNotNull() & (rows > 1))}
    counts |= {n: F.coalesce(F.sum(n), F.lit(0)) for n in nulls.values()}
    counts |= {f"__gold_{c}": F.coalesce(F.sum(f"__gold_{c}"), F.lit(0)) for c in tested}
    sums = per_key.agg(*[c.alias(n) for n, c in counts.items()])

    def row(model: str, column: str, test: str, failures: str) -> Column:
        return F.struct(F.lit(model).alias("model"), F.lit(column).alias("column_name"), F.lit(test).alias("test"),
                        F.col(failures).alias("failures"))

    return sums.select(F.inline(F.array(
        *[row(SILVER_CONTRACT.name, c, "not_null", n) for c, n in nulls.items()],
        row(GOLD_CONTRACT.name, key, "unique", "unique"),
        *[row(GOLD_CONTRACT.name, c, "not_null", f"__gold_{c}") for c in tested])))


def with_comments(df: DataFrame, contract: ModelContract) -> DataFrame:
    """Attach the contract's column descriptions as column comments (kept in Parquet footers)."""
    desc = contract.descriptions()
    return df.select(*[
        F.col(c).alias(c, metadata={"comment": desc[c]}) if c in desc else F.col(c) for c in df.columns
    ])


# Formats written as plain files at a path; others (e.g. a table format) are catalog tables whose
# location the catalog owns, and whose overwrite is one atomic commit for readers.
FILE_FORMATS = ("parquet", "orc", "json", "csv")


def write_layer(df: DataFrame, path: str | None, contract: ModelContract | None = None,
                partition_by: list[str] | None = None, table: str | None = None,
                fmt: str = "parquet", observe: tuple | None = None, rebalance: bool = True) -> str | None:
    """Materialise a layer at ``path`` (replacing what was there), optionally as a named table.

    With ``partition_by`` the files are laid out by those columns so readers prune folders.
    The rows are first rebalanced on those columns: without it every task writes one file
    per partition value it holds (tasks x values small files); with it, adaptive execution
    sizes the output partitions and splits a hot value (a busy month) over several tasks.
    That costs one shuffle of the layer; pass ``rebalance=False`` when the input is already
    clustered by those columns (e.g. landed day by day), where each task holds few values anyway.
    ``observe`` = ``(Observation, metric columns)`` computed by this write's final stage.
    With a table format as ``fmt`` (e.g. ``iceberg``) the layer is the catalog table ``table``
    and ``path`` is unused; its overwrite is then one atomic commit for concurrent readers.
    Returns the path, or the table name for a table format.
    """
    if contract is not None:
        df = with_comments(df, contract)
    if partition_by and rebalance:
        df = df.hint("rebalance", *partition_by)
    if observe is not None:
        df = df.observe(observe[0], *observe[1])
    writer = df.write.mode("overwrite").format(fmt)
    if fmt in FILE_FORMATS:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if table:
        writer.saveAsTable(table)
        if contract is not None:  # the model's own description lives on the table
            df.sparkSession.sql(f"COMMENT ON TABLE {table} IS '{contract.description.replace(chr(39), chr(92) + chr(39))}'")
    elif fmt in FILE_FORMATS:
        writer.save()
    else:
        raise ValueError(f"a {fmt!r} layer needs a catalog table name")
    return path if fmt in FILE_FORMATS else table


SILVER_PARTITIONS = ["anio_venta", "mes_venta"]
