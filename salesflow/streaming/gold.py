"""Gold kept up to date batch by batch, each batch counted once.

The state is a table of partial sums per store, in several folders. A batch adds a folder with the sums of its own rows,
so its work is in proportion to the batch; gold is the sum of the folders, a few rows for each store. When there are
``FOLD_AT`` folders the next batch puts them into one.

Folders and the number of the last batch applied change together, in one manifest (``sources.versions``): that is the ledger. A batch
that is replayed, whatever part of it had been done before, finds its number in the ledger and changes nothing, or finds that it
was never committed and is applied. Batches of one stream come in order, so the last number is enough.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.money import merge_parts_sql, sum_parts_sql, total_sql
from ..operators.layers import to_bronze, to_silver
from ..operators.messages import decode_messages
from ..sources.versions import commit, read_manifest
from .sinks import start

FOLD_AT = 16
COUNTS = ("n_sales", "n_amounts")
STATE = T.StructType([
    T.StructField("tienda_id", T.IntegerType()),
    *[T.StructField(n, T.LongType()) for n in ("whole", "upper", "lower", "odd")],
    T.StructField("plain", T.DoubleType()),
    *[T.StructField(n, T.LongType()) for n in COUNTS],
])
SUMS = {n: n for n in STATE.names if n not in ("tienda_id", *COUNTS)}


def partial_sums(silver: DataFrame) -> DataFrame:
    """The sums per store that gold is made of; they can be added to one another."""
    parts = sum_parts_sql("monto") | {"n_sales": "COUNT(venta_id)", "n_amounts": "COUNT(monto)"}
    return _state(silver.groupBy("tienda_id").agg(*[F.expr(x).alias(n) for n, x in parts.items()]))


def merged(state: DataFrame) -> DataFrame:
    """Partial sums added up: one row for each store."""
    parts = merge_parts_sql(SUMS) | {n: f"SUM({n})" for n in COUNTS}
    return _state(state.groupBy("tienda_id").agg(*[F.expr(x).alias(n) for n, x in parts.items()]))


def _state(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in STATE.fields])


def gold_of(state: DataFrame) -> DataFrame:
    """Gold, as ``to_gold`` gives it, from partial sums in any number of pieces."""
    total = total_sql(SUMS)
    return merged(state).select(
        "tienda_id", F.expr(total).alias("monto_total_ventas"), F.col("n_sales").alias("numero_de_transacciones"),
        F.expr(f"TRY_DIVIDE({total}, n_amounts)").alias("monto_promedio_por_transaccion"))


def _folders(spark: SparkSession, root: str, content: dict | None) -> DataFrame:
    if not content or not content["folders"]:
        return spark.createDataFrame([], STATE)
    return spark.read.schema(STATE).parquet(*[f"{root}/{f}" for f in content["folders"]])


def apply_batch(silver: DataFrame, root: str, stream: str, batch: int, fold_at: int = FOLD_AT) -> bool:
    """Add a batch of silver rows to the state at ``root``; False if this batch of this stream was counted before."""
    spark, root = silver.sparkSession, root.rstrip("/")
    _, before = read_manifest(spark, root)
    if before and before["applied"].get(stream, -1) >= batch:
        return False
    sums = partial_sums(silver)
    fold = bool(before) and len(before["folders"]) >= fold_at
    if fold:
        sums = merged(_folders(spark, root, before).unionByName(sums))
    folder = f"state-{uuid.uuid4().hex}"
    # one row for each store: few files
    sums.write.parquet(f"{root}/{folder}")
    applied = True

    def change(last: dict | None) -> dict | None:
        nonlocal applied
        last = last or {"applied": {}, "folders": []}
        if last["applied"].get(stream, -1) >= batch:
            applied = False
            return None
        gone = before["folders"] if fold else []
        if not set(gone) <= set(last["folders"]):
            raise RuntimeError(f"{root}: another stream has folded these sums meanwhile; the batch is to be run again")
        return {"applied": last["applied"] | {stream: batch}, "folders": [f for f in last["folders"] if f not in gone] + [folder]}

    commit(spark, root, change)
    return applied


def read_gold(spark: SparkSession, root: str) -> DataFrame:
    """Gold of all batches committed so far."""
    root = root.rstrip("/")
    return gold_of(_folders(spark, root, read_manifest(spark, root)[1]))


def silver_of_messages(messages: DataFrame) -> DataFrame:
    return to_silver(to_bronze(decode_messages(messages)))


def ingest_to_gold(stream: DataFrame, root: str, checkpoint: str, name: str = "sales", trigger: dict | None = None,
                   to_rows: Callable[[DataFrame], DataFrame] = silver_of_messages) -> StreamingQuery:
    """Decode a message stream and add each batch to the gold at ``root``. ``name`` tells streams into the same gold apart;
    a stream that starts anew, with a new checkpoint, must have a new name."""
    def run(batch: DataFrame, number: int) -> None:
        apply_batch(to_rows(batch), root, name, number)

    return start(stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint), trigger)
