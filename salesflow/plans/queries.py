"""Registered queries: one per operator family, each ``(spark, sf_dir) -> DataFrame``.

Each reads the driver's tables under ``sf_dir`` whole. Queries that write (layers, CSV,
message files, streams) write under the shared checkpoint folder, a new folder per call.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import epoch_seconds, from_epoch_seconds
from ..functions.money import round_amount as round_money
from ..operators import layers, messages, quality, totals
from ..schemas import BRONZE_SALES, LANDING
from ..session import scratch_path, unique_name
from ..sources import bucketed, csvschema, files, mixed
from ..sources.testviews import sales_from_events, sales_from_lineitem, sales_from_orders, table
from ..sources.versions import compact, read_layer, read_manifest
from ..streaming import gold, ingest, progress, sinks
from ..streaming import sources as stream_sources
from . import inputs, models, sql_models
from .bronze import ingest_landing
from .medallion import LayerPaths, build_gold, build_silver, build_silver_version, rebuild_silver_months, run_medallion
from .sales_models import SALES_MODELS, SOURCE

AVAILABLE_NOW = {"availableNow": True}

# Fixed values, as the reference's jobs use them: the amount threshold of the benchmark query,
# and the record limit the producer is run with.
MIN_AMOUNT = 100.0
PUBLISH_LIMIT = 100

HIGH_AMOUNT = 30_000.0  # a threshold that takes out about a third of the line items; all of them are above MIN_AMOUNT
CORRECTED_MONTHS = [(1997, 3), (1997, 4), (1999, 12)]

BATCH_BYTES = 64 << 20  # of message files a micro-batch takes

# ---- step 1: the benchmark query and its variants -------------------------------------------


def store_totals_min_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over line items, whose amount is a plain column: the threshold reaches the Parquet scan."""
    return totals.store_totals(sales_from_lineitem(spark, sf_dir), MIN_AMOUNT)


def event_totals_min_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over events, whose amount is derived (refunds are negative)."""
    return totals.store_totals(sales_from_events(spark, sf_dir), MIN_AMOUNT)


def filter_min_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals.filter_min_amount(sales_from_lineitem(spark, sf_dir), MIN_AMOUNT)


def store_totals_high_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals.store_totals(sales_from_lineitem(spark, sf_dir), HIGH_AMOUNT)


def filter_high_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals.filter_min_amount(sales_from_lineitem(spark, sf_dir), HIGH_AMOUNT)


def store_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals.store_sum(sales_from_lineitem(spark, sf_dir))


def store_sum_net(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unrounded amounts: price after discount, summed per store with its fractions of a cent."""
    li = table(spark, sf_dir, "lineitem")
    net = li.select(F.col("l_suppkey").alias("tienda_id"),
                    (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("monto"))
    return totals.store_sum(net)


def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals.row_count(sales_from_lineitem(spark, sf_dir))


def store_sum_with_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals.store_sum_with_total(sales_from_lineitem(spark, sf_dir))


def preview_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals.preview(event_totals_min_amount(spark, sf_dir), ["tienda_id"], 5)


# ---- step 2: CSV and Parquet sources, bronze -------------------------------------------------


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = inputs.orders_csv(spark, sf_dir, scratch_path(spark, "orders-csv"))
    return layers.to_bronze(files.raw_sales_csv(spark, path))


def csv_scan_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = inputs.orders_csv(spark, sf_dir, scratch_path(spark, "orders-csv"))
    return files.csv_scan(spark, path, infer_schema=True)


def bronze_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    csv_path = inputs.orders_csv(spark, sf_dir, scratch_path(spark, "orders-csv"))
    bronze_path = scratch_path(spark, "bronze-sales")
    files.write_parquet(layers.to_bronze(files.raw_sales_csv(spark, csv_path)), bronze_path)
    return files.parquet_scan(spark, bronze_path)


def bronze_product_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing files with a product column and another column order; the id is named ``id``."""
    sales = sales_from_lineitem(spark, sf_dir).withColumnRenamed("id_transaccion", "id")
    path = files.write_csv(sales.select("fecha", "producto_id", "monto", "id", "tienda_id"), scratch_path(spark, "product-csv"))
    return layers.to_bronze(files.raw_sales_csv(spark, path))


def _landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    csv_path = inputs.damaged_orders_csv(spark, sf_dir, scratch_path(spark, "damaged-csv"))
    path = scratch_path(spark, "bronze-landing")
    ingest_landing(spark, csv_path, path)
    return files.parquet_scan(spark, path)


def bronze_landing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze read from the landing that one pass over the CSV wrote."""
    return layers.landing_bronze(_landing(spark, sf_dir))


def bronze_landing_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers.landing_rejects(_landing(spark, sf_dir))


FIRST_SCHEMA = "id_transaccion int, tienda_id int, monto double, fecha timestamp_ntz"


def csv_schema_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A drifted CSV held against the schema of the first file."""
    path = inputs.drifted_orders_csv(spark, sf_dir, scratch_path(spark, "drifted-csv"))
    return csvschema.check_csv(spark, path, T.StructType.fromDDL(FIRST_SCHEMA))


def csv_schema_widened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The drifted CSV read by the saved schema, widened by it."""
    path, saved = inputs.drifted_orders_csv(spark, sf_dir, scratch_path(spark, "drifted-csv")), scratch_path(spark, "saved-schema")
    csvschema.save_schema(spark, T.StructType.fromDDL(FIRST_SCHEMA), saved)
    return csvschema.read_typed(spark, path, csvschema.update_schema(spark, path, saved))


SALE_ZONE = "America/Bogota"


def silver_zoned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver's sale times as instants of a zone, in microseconds since 1970 in UTC."""
    zoned = layers.zoned_silver(layers.to_silver(sales_from_events(spark, sf_dir)), SALE_ZONE)
    return zoned.select("venta_id", F.unix_micros("fecha_venta").alias("instante_us"), "dia_venta")


def bronze_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers.bronze_rejects(inputs.damaged_raw_orders(spark, sf_dir))


V3_SELECT = ("o_orderkey AS id_transaccion, CAST(o_custkey % 100 + 1 AS INT) AS tienda_id, "
             "o_totalprice AS monto, o_orderdate AS fecha")


def parquet_path_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.parquet_path_sql(spark, f"{sf_dir.rstrip('/')}/orders.parquet", V3_SELECT)


def named_source_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = files.named_source(spark, "salesflow_bronze_sales", f"{sf_dir.rstrip('/')}/orders.parquet")
    return src.selectExpr(*[s.strip() for s in V3_SELECT.split(", ")])


# ---- step 3: silver, gold, materialised layers, scalar functions ------------------------------


def silver_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers.to_silver(sales_from_events(spark, sf_dir))


def gold_store_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers.to_gold(layers.to_silver(sales_from_events(spark, sf_dir))).orderBy("tienda_id")


def materialize_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = LayerPaths.under(scratch_path(spark, "warehouse"))
    silver = build_silver(spark, sales_from_events(spark, sf_dir), paths, partitioned=True, gate=False)
    return build_gold(spark, silver, paths, gate=False)


def round_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return li.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id_transaccion"),
                     net.alias("monto_bruto"), round_money(net, 2).alias("monto"))


def epoch_to_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = sales_from_events(spark, sf_dir)
    secs = epoch_seconds("fecha")
    return sales.select("id_transaccion", secs.alias("epoch_s"), from_epoch_seconds(secs).alias("fecha_s"))


V1_SQL = ("(SELECT event_id AS id_transaccion, user_id % 100 + 1 AS tienda_id, "
          "CASE WHEN event_type = 'error' THEN -value ELSE value END AS monto, ts AS fecha "
          "FROM parquet.`{path}`)")


def silver_sql_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sql_models.silver_model(spark, V1_SQL.format(path=f"{sf_dir.rstrip('/')}/events.parquet"))


def gold_sql_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = "salesflow_silver_sales"  # one view for the session: a later call replaces it
    silver_sql_model(spark, sf_dir).createOrReplaceTempView(view)
    return sql_models.gold_model(spark, view)


def _clashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = inputs.clashing_orders(spark, sf_dir, scratch_path(spark, "clashing-parquet"))
    return mixed.read_mixed_parquet(spark, path, BRONZE_SALES)


def mixed_parquet_good(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of INT, BIGINT, DOUBLE, DECIMAL and text amounts, one of them without stores, as one table."""
    return mixed.good_rows(_clashing(spark, sf_dir), BRONZE_SALES)


def mixed_parquet_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed.rejected_rows(_clashing(spark, sf_dir)).drop("file")


def silver_month_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver built once, then three months made anew from bronze with every amount one higher."""
    root, bronze = scratch_path(spark, "silver-versions"), sales_from_orders(spark, sf_dir)
    build_silver_version(spark, bronze, root)
    return rebuild_silver_months(spark, bronze.withColumn("monto", F.col("monto") + 1), root, CORRECTED_MONTHS)


def model_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five models built in the order of their references; the last reads both gold models."""
    root = scratch_path(spark, "models")
    outcomes = models.build_models(spark, SALES_MODELS, {SOURCE: sales_from_orders(spark, sf_dir)}, root)
    if any(o.status != "built" for o in outcomes):
        raise RuntimeError(f"not all models were built: {outcomes}")
    return models.read_model(spark, root, "report_stores")


def model_graph_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same models over damaged orders: silver fails its tests, what reads it is skipped, another model is built."""
    count = models.Model("bronze_count", "SELECT COUNT(*) AS n_rows FROM {{ source('bronze', 'sales') }}")
    outcomes = models.build_models(spark, [*SALES_MODELS, count], {SOURCE: inputs.damaged_bronze(spark, sf_dir)}, scratch_path(spark, "models"))
    return models.build_report(spark, outcomes).drop("detail")


# ---- step 4: data quality --------------------------------------------------------------------


def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers.silver_gold_report(layers.to_silver(sales_from_lineitem(spark, sf_dir)))


def dq_report_damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver and gold tests over orders typed from damaged text: unparsable amounts are
    dropped by silver's amount filter, unparsable dates reach silver and fail its not_null test."""
    return layers.silver_gold_report(layers.to_silver(layers.to_bronze(inputs.damaged_raw_orders(spark, sf_dir))))


def dq_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_keys(layers.to_silver(sales_from_lineitem(spark, sf_dir)), "venta_id")


def medallion_gated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_medallion(spark, sales_from_events(spark, sf_dir), scratch_path(spark, "warehouse"))


def reconcile_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold (positive sales only) against the same metrics with refunds netted in."""
    sales = sales_from_events(spark, sf_dir)
    gross = layers.to_gold(layers.to_silver(sales))
    net = layers.to_gold(sales.select(F.col("id_transaccion").alias("venta_id"), "tienda_id", "monto"))
    return quality.reconcile(gross, net, ["tienda_id"])


def reconcile_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders against a copy with other text, shifted whole numbers and a column less."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    other = orders.select(
        "o_orderkey", F.lit("P").alias("o_orderstatus"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("o_orderpriority"),
        F.when(F.col("o_custkey") % 7 == 0, F.col("o_custkey") + 1).otherwise(F.col("o_custkey")).alias("o_custkey"))
    return quality.reconcile(orders, other, "o_orderkey", atol=0.0, rtol=0.0)


def reconcile_few(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders against a copy in which one order of a thousand has another amount and one of five hundred is missing, by digests."""
    orders = table(spark, sf_dir, "orders")
    other = orders.where("o_orderkey % 500 <> 3").withColumn(
        "o_totalprice", F.when(F.col("o_orderkey") % 1000 == 7, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    return quality.reconcile_by_digest(orders, other, "o_orderkey")


def duplicate_keys_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated sale ids of a silver layer that is stored by them: found without a shuffle."""
    silver = layers.to_silver(sales_from_lineitem(spark, sf_dir))
    name = unique_name("silver_by_id")
    bucketed.write_bucketed(silver, name, "venta_id", 8, scratch_path(spark, "silver-by-id"))
    return quality.duplicate_keys(bucketed.read_bucketed(spark, name), "venta_id")


def storage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    csv_path = inputs.orders_csv(spark, sf_dir, scratch_path(spark, "orders-csv"))
    bronze_path = scratch_path(spark, "bronze-sales")
    files.write_parquet(layers.to_bronze(files.raw_sales_csv(spark, csv_path)), bronze_path)
    return files.storage_report(spark, csv_path, bronze_path)


# ---- step 5: messages ------------------------------------------------------------------------


def first_n_to_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals.first_n(sales_from_orders(spark, sf_dir), PUBLISH_LIMIT)


def publish_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.event_messages(spark, sf_dir)


def publish_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages numbered by time within their store, written by the publishing job and read back."""
    root = scratch_path(spark, "publish-ordered")
    sales = inputs.producer_rows(sales_from_events(spark, sf_dir))
    ingest.publish_in_order(sales, f"{root}/runs", fmt="parquet", path=f"{root}/topic")
    return spark.read.parquet(f"{root}/topic")


def decode_sales_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.decode_messages(inputs.lineitem_messages(spark, sf_dir))


def decode_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bad = messages.split_quarantine(inputs.damaged_event_messages(spark, sf_dir))
    return bad


def json_inferred_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    good, _ = messages.split_json_column(ev, "props", keep=["event_id"])
    return good


def json_bad_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON text by a declared schema, some of it damaged: what is set aside, and why."""
    damaged = inputs.damaged_event_messages(spark, sf_dir)
    _, bad = messages.split_json_column(damaged, "value", "id BIGINT, tienda_id INT, monto DOUBLE", keep=["key"])
    return bad


# ---- step 6: streams -------------------------------------------------------------------------


def _publish_files(spark: SparkSession, msgs: DataFrame, path: str) -> str:
    """Stand-in for a topic: message files, one per task of the publishing job (each file is a
    unit of a micro-batch on the reading side)."""
    sinks.publish(messages.as_binary_messages(msgs), fmt="parquet", path=path)
    return path


def _stream_into_table(spark: SparkSession, topic: str, table_name: str, checkpoint: str) -> None:
    stream = stream_sources.message_file_stream(spark, topic)
    sinks.run_to_completion(ingest.ingest_to_table(stream, table_name, checkpoint, AVAILABLE_NOW))


@contextmanager
def _landing_table(spark: SparkSession, root: str):
    """A catalog table over files under ``root`` for as long as streams append to it; the files stay."""
    name = unique_name("sales_events")
    sinks.ensure_table(spark, name, location=f"{root}/table")
    try:
        yield name
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def _landed_table(spark: SparkSession, root: str) -> DataFrame:
    return messages.good_events(spark.read.schema(LANDING).parquet(f"{root}/table"))


def stream_decode_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "stream-append")
    topic = _publish_files(spark, inputs.event_messages(spark, sf_dir), f"{root}/topic")
    with _landing_table(spark, root) as name:
        _stream_into_table(spark, topic, name, f"{root}/checkpoint")
    return _landed_table(spark, root)


def _stream_into_files(spark: SparkSession, msgs: DataFrame, root: str) -> DataFrame:
    topic = _publish_files(spark, msgs, f"{root}/topic")
    stream = stream_sources.message_file_stream(spark, topic, bytes_per_batch=BATCH_BYTES)
    sinks.run_to_completion(ingest.ingest_to_parquet(stream, f"{root}/sales", f"{root}/checkpoint", AVAILABLE_NOW))
    return ingest.read_landing(spark, f"{root}/sales")


def stream_parquet_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = _stream_into_files(spark, inputs.event_messages(spark, sf_dir), scratch_path(spark, "stream-files"))
    return messages.good_events(landing)


def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good and damaged messages through one stream: every message is one row, with its text and route."""
    landing = _stream_into_files(spark, inputs.damaged_event_messages(spark, sf_dir), scratch_path(spark, "stream-bad"))
    return landing.drop("producto_id")


def stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish in two rounds with a run after each, then a run with nothing new: the table
    holds every message exactly once."""
    root = scratch_path(spark, "stream-resume")
    msgs = inputs.event_messages(spark, sf_dir)
    first_round = F.get_json_object("value", "$.tienda_id").cast("int") <= 50
    with _landing_table(spark, root) as name:
        for part in (msgs.filter(first_round), msgs.filter(~first_round), None):
            if part is not None:
                _publish_files(spark, part, f"{root}/topic")
            _stream_into_table(spark, f"{root}/topic", name, f"{root}/checkpoint")
    return _landed_table(spark, root)


def stream_to_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = stream_decode_append(spark, sf_dir)
    return run_medallion(spark, layers.to_bronze(events), scratch_path(spark, "warehouse"))


def stream_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Small batches into a versioned landing layer, packed half-way and at the end."""
    root = scratch_path(spark, "stream-compacted")
    msgs = inputs.event_messages(spark, sf_dir)
    first_round = F.get_json_object("value", "$.tienda_id").cast("int") <= 50
    for part in (msgs.filter(first_round), msgs.filter(~first_round)):
        topic = _publish_files(spark, part.repartition(3), f"{root}/topic")
        stream = stream_sources.message_file_stream(spark, topic, files_per_batch=1)
        sinks.run_to_completion(ingest.ingest_to_versions(stream, f"{root}/landing", f"{root}/checkpoint", trigger=AVAILABLE_NOW))
        compact(spark, f"{root}/landing")
    return messages.good_events(read_layer(spark, f"{root}/landing"))


def stream_schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landing table made before events had a product: a stream fills it, it is brought to today's shape, the stream goes on."""
    root, name = scratch_path(spark, "stream-drift"), unique_name("sales_events")
    msgs = inputs.event_messages(spark, sf_dir)
    first_round = F.get_json_object("value", "$.tienda_id").cast("int") <= 50
    old = [f for f in LANDING.fields if f.name != "producto_id"]
    try:
        sinks.ensure_table(spark, name, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in old), location=f"{root}/table")
        topic = _publish_files(spark, msgs.filter(first_round), f"{root}/topic")
        landing = messages.landed(stream_sources.message_file_stream(spark, topic)).select(*[f.name for f in old])
        sinks.run_to_completion(sinks.append_to_table(landing, name, f"{root}/checkpoint", AVAILABLE_NOW))
        sinks.ensure_table(spark, name, location=f"{root}/table", evolve=True)
        _publish_files(spark, msgs.filter(~first_round), f"{root}/topic")
        _stream_into_table(spark, topic, name, f"{root}/checkpoint")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return _landed_table(spark, root)


def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the progress log says of a stream of good and damaged messages, added up over its batches."""
    root = scratch_path(spark, "stream-progress")
    topic = _publish_files(spark, inputs.damaged_event_messages(spark, sf_dir).repartition(4), f"{root}/topic")
    log = progress.ProgressLog(spark, f"{root}/progress")
    spark.streams.addListener(log)
    try:
        stream = progress.watch(messages.landed(stream_sources.message_file_stream(spark, topic, files_per_batch=1)))
        query = sinks.run_to_completion(sinks.append_to_parquet(stream, f"{root}/sales", f"{root}/checkpoint", AVAILABLE_NOW, ["route"]))
        progress.noted(spark, log, query)
    finally:
        spark.streams.removeListener(log)
    told = progress.read_progress(spark, f"{root}/progress")
    return told.agg(F.count(F.lit(1)).alias("n_batches"), F.sum("n_input").alias("n_input"), F.sum("n_landed").alias("n_landed"),
                    F.sum("n_quarantined").alias("n_quarantined"))


def stream_gold_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold kept by partial sums, batch by batch; the last batch comes a second time."""
    root = scratch_path(spark, "stream-gold")
    msgs = inputs.event_messages(spark, sf_dir)
    n_files = 6
    topic = _publish_files(spark, msgs.repartition(n_files), f"{root}/topic")
    stream = stream_sources.message_file_stream(spark, topic, files_per_batch=1)
    sinks.run_to_completion(gold.ingest_to_gold(stream, f"{root}/gold", f"{root}/checkpoint", "events", AVAILABLE_NOW))
    last = read_manifest(spark, f"{root}/gold")[1]["applied"]["events"]
    gold.apply_batch(gold.silver_of_messages(msgs), f"{root}/gold", "events", last)
    return gold.read_gold(spark, f"{root}/gold")


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "store_totals_min_amount": store_totals_min_amount,
    "event_totals_min_amount": event_totals_min_amount,
    "filter_min_amount": filter_min_amount,
    "store_totals_high_amount": store_totals_high_amount,
    "filter_high_amount": filter_high_amount,
    "store_sum": store_sum,
    "store_sum_net": store_sum_net,
    "row_count": row_count,
    "store_sum_with_total": store_sum_with_total,
    "preview_stores": preview_stores,
    "csv_roundtrip": csv_roundtrip,
    "csv_scan_inferred": csv_scan_inferred,
    "bronze_typed": bronze_typed,
    "bronze_product_sales": bronze_product_sales,
    "bronze_rejects": bronze_rejects,
    "bronze_landing_rows": bronze_landing_rows,
    "bronze_landing_rejects": bronze_landing_rejects,
    "csv_schema_check": csv_schema_check,
    "csv_schema_widened": csv_schema_widened,
    "silver_zoned": silver_zoned,
    "parquet_path_sql": parquet_path_sql,
    "named_source_scan": named_source_scan,
    "silver_sales": silver_sales,
    "gold_store_sales": gold_store_sales,
    "silver_sql_model": silver_sql_model,
    "gold_sql_model": gold_sql_model,
    "materialize_layer": materialize_layer,
    "mixed_parquet_good": mixed_parquet_good,
    "mixed_parquet_rejects": mixed_parquet_rejects,
    "silver_month_rebuild": silver_month_rebuild,
    "model_graph": model_graph,
    "model_graph_report": model_graph_report,
    "round_amount": round_amount,
    "epoch_to_timestamp": epoch_to_timestamp,
    "dq_report": dq_report,
    "dq_report_damaged": dq_report_damaged,
    "dq_duplicate_keys": dq_duplicate_keys,
    "medallion_gated": medallion_gated,
    "reconcile_totals": reconcile_totals,
    "reconcile_orders": reconcile_orders,
    "reconcile_few": reconcile_few,
    "duplicate_keys_bucketed": duplicate_keys_bucketed,
    "storage_report": storage_report,
    "first_n_to_publish": first_n_to_publish,
    "publish_encode": publish_encode,
    "publish_ordered": publish_ordered,
    "decode_sales_json": decode_sales_json,
    "decode_quarantine": decode_quarantine,
    "json_inferred_columns": json_inferred_columns,
    "json_bad_text": json_bad_text,
    "stream_decode_append": stream_decode_append,
    "stream_parquet_batches": stream_parquet_batches,
    "stream_quarantine": stream_quarantine,
    "stream_resume": stream_resume,
    "stream_compacted": stream_compacted,
    "stream_schema_drift": stream_schema_drift,
    "stream_progress": stream_progress,
    "stream_to_gold": stream_to_gold,
    "stream_gold_incremental": stream_gold_incremental,
}
