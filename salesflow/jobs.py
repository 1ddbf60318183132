"""Command-line jobs: ``spark-submit --py-files salesflow.zip run_job.py <job> ...`` on a cluster,
or ``python -m salesflow.jobs <job> ...`` locally.

The session comes from the launcher (master, catalog, connector jars, ``spark.checkpoint.dir``);
each job wires library functions together and prints only bounded output (a preview, a report).

    python -m salesflow.jobs totals    --csv sales.csv [--min-amount 100] [--out PATH | --explain]
    python -m salesflow.jobs bronze    --csv sales.csv --out /lake/bronze/sales [--rejects PATH | --landing]
    python -m salesflow.jobs medallion --bronze /lake/bronze/sales --root /lake [--format iceberg \
                                       --silver-table lake.silver.ventas --gold-table lake.gold.tiendas]
    python -m salesflow.jobs publish   --csv sales.csv --brokers host:9092 [--topic T] [--limit N]
    python -m salesflow.jobs stream-table --brokers host:9092 --table lake.default.ventas \\
                                          --checkpoint s3a://b/ckpt [--provider iceberg] [--trigger "30 seconds"]
    python -m salesflow.jobs stream-files --brokers host:9092 --path s3a://b/sales --checkpoint s3a://b/ckpt
    python -m salesflow.jobs stream-landing | stream-gold --brokers host:9092 --root s3a://b/layer --checkpoint s3a://b/ckpt [--name N]
    python -m salesflow.jobs models --project models/ --root /lake [--select a,b] [--source group.table=PATH]
    python -m salesflow.jobs silver-months --bronze /lake/bronze/sales --root /lake/silver [--months 2024-03,2024-04]
    python -m salesflow.jobs compact | vacuum --root /lake/landing
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .operators.totals import first_n, preview, store_totals
from .plans.bronze import ingest_bronze, ingest_landing
from .plans.medallion import LayerPaths, build_silver_version, rebuild_silver_months, run_medallion
from .plans.models import build_models, build_report, load_project
from .operators.layers import to_bronze
from .sources.files import raw_sales_csv
from .sources.versions import compact, vacuum
from .streaming.gold import ingest_to_gold
from .streaming.ingest import (ingest_to_parquet, ingest_to_table, ingest_to_versions, kafka_sink_options, publish_in_order,
                               publish_sales)
from .streaming.sinks import PRODUCTION_TRIGGER, ensure_table
from .streaming.sources import (BATCH_MESSAGES, BATCH_WAIT, DEFAULT_TOPIC, event_stream, kafka_options,
                                message_file_stream)

PREVIEW_ROWS = 5


def source_options(args) -> dict:
    """Options of the broker source: batches without a cap unless the job sets one."""
    return kafka_options(args.brokers, args.topic, batch_messages=args.batch_messages or None,
                         max_wait=args.max_wait or None, min_partitions=args.min_partitions)


def _stream(spark: SparkSession, args):
    if args.source_format == "kafka":
        return event_stream(spark, "kafka", source_options(args))
    return message_file_stream(spark, args.source_path)


def trigger_of(args) -> dict:
    """The job's trigger: once, an interval, or none (each batch follows the last at once)."""
    if args.once:
        return {"availableNow": True}
    return {"processingTime": args.trigger} if args.trigger else {}


def sales_csv(spark: SparkSession, path: str):
    """Sales CSV typed by the declared columns (no inference pass); other columns stay text."""
    return to_bronze(raw_sales_csv(spark, path))


def run(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    p = argparse.ArgumentParser(prog="salesflow.jobs")
    sub = p.add_subparsers(dest="job", required=True)

    t = sub.add_parser("totals", help="per-store total and mean of sales above a threshold")
    t.add_argument("--csv"), t.add_argument("--parquet"), t.add_argument("--min-amount", type=float, default=100.0)
    t.add_argument("--out", help="folder for the full result, as Parquet")
    t.add_argument("--explain", action="store_true", help="print the formatted physical plan instead of running")

    b = sub.add_parser("bronze", help="CSV landing files -> typed bronze Parquet (+ rejects)")
    b.add_argument("--csv", required=True), b.add_argument("--out", required=True), b.add_argument("--rejects")
    b.add_argument("--landing", action="store_true", help="good and rejected rows in one table at --out, the text read once")

    m = sub.add_parser("medallion", help="bronze -> silver -> gold, each layer tested before the next")
    m.add_argument("--bronze", required=True), m.add_argument("--root", required=True)
    m.add_argument("--silver-table"), m.add_argument("--gold-table")
    m.add_argument("--format", default="parquet", help="layer format, e.g. iceberg (needs the table names)")

    pub = sub.add_parser("publish", help="CSV rows -> keyed JSON messages on a topic")
    pub.add_argument("--csv", required=True), pub.add_argument("--brokers")
    pub.add_argument("--topic", default=DEFAULT_TOPIC), pub.add_argument("--limit", type=int)
    pub.add_argument("--order-by", default="id_transaccion"), pub.add_argument("--format", default="kafka")
    pub.add_argument("--path", help="output folder when --format is a file format")
    pub.add_argument("--ordered", metavar="STAGING", help="number the messages of each key by fecha and id; a new folder for the sorted runs")

    for name, helptext in (("stream-table", "message stream -> landing table, good and quarantined rows told apart by route"),
                           ("stream-files", "message stream -> Parquet files, one folder each for good and quarantined rows"),
                           ("stream-landing", "message stream -> versioned landing layer (see compact)"),
                           ("stream-gold", "message stream -> gold kept up to date batch by batch")):
        s = sub.add_parser(name, help=helptext)
        s.add_argument("--brokers"), s.add_argument("--topic", default=DEFAULT_TOPIC)
        s.add_argument("--source-format", default="kafka"), s.add_argument("--source-path")
        s.add_argument("--checkpoint", required=True), s.add_argument("--min-partitions", type=int)
        # the table job takes all that has arrived every 30 s; the file job cuts batches by size or time
        # and needs no interval (an interval on top would cap the flow)
        files = name == "stream-files"
        s.add_argument("--batch-messages", type=int, default=BATCH_MESSAGES if files else 0, help="0: no bound")
        s.add_argument("--max-wait", default=BATCH_WAIT if files else "")
        s.add_argument("--trigger", default="" if files else PRODUCTION_TRIGGER["processingTime"], help="'': no interval")
        s.add_argument("--once", action="store_true", help="process what is there, then stop")
        if name == "stream-table":
            s.add_argument("--table", required=True), s.add_argument("--provider", default="parquet")
            s.add_argument("--location")
            s.add_argument("--evolve", action="store_true", help="bring a table of an older shape to today's")
        elif files:
            s.add_argument("--path", required=True)
        else:
            s.add_argument("--root", required=True), s.add_argument("--name", default="sales", help="tells streams into one root apart")

    mo = sub.add_parser("models", help="build a folder of SQL models in dependency order, each tested before it is published")
    mo.add_argument("--project", required=True), mo.add_argument("--root", required=True)
    mo.add_argument("--select", help="comma separated: these models and what they read")
    mo.add_argument("--source", action="append", default=[], help="group.table=path, instead of what the project declares")

    months = sub.add_parser("silver-months", help="silver as a versioned layer, built whole or some months of it")
    months.add_argument("--bronze", required=True), months.add_argument("--root", required=True)
    months.add_argument("--months", help="comma separated, as 2024-03; all without it")

    c = sub.add_parser("compact", help="pack the small files of a versioned layer")
    c.add_argument("--root", required=True), c.add_argument("--target-mb", type=int, default=256)
    v = sub.add_parser("vacuum", help="delete the versions of a layer that its last manifests don't name")
    v.add_argument("--root", required=True), v.add_argument("--keep", type=int, default=2), v.add_argument("--older-than-hours", type=float, default=24)

    args = p.parse_args(argv)
    if args.job.startswith("stream-") and args.batch_messages and args.trigger:
        p.error("a batch bound with a trigger interval caps the flow: set one of --batch-messages 0 or --trigger ''")
    if args.job == "totals" and not (args.csv or args.parquet):
        p.error("totals needs --csv or --parquet")
    if args.job == "publish" and args.format == "kafka" and not args.brokers:
        p.error("publish to kafka needs --brokers")
    if args.job == "publish" and args.format != "kafka" and not args.path:
        p.error("publish to files needs --path")
    if args.job.startswith("stream-"):
        if args.source_format == "kafka" and not args.brokers:
            p.error(f"{args.job} from kafka needs --brokers")
        if args.source_format != "kafka" and not args.source_path:
            p.error(f"{args.job} from files needs --source-path")
    spark = spark or SparkSession.builder.appName(f"salesflow-{args.job}").getOrCreate()

    if args.job == "totals":
        src = sales_csv(spark, args.csv) if args.csv else spark.read.parquet(args.parquet)
        result = store_totals(src, args.min_amount)
        if args.explain:
            result.explain("formatted")
        elif args.out:
            result.write.mode("overwrite").parquet(args.out)
        else:
            preview(result, ["tienda_id"], PREVIEW_ROWS).show(truncate=False)
    elif args.job == "bronze":
        if args.landing and args.rejects:
            p.error("--landing keeps rejects in its own rows")
        report = ingest_landing(spark, args.csv, args.out) if args.landing else ingest_bronze(spark, args.csv, args.out, args.rejects)
        report.show(truncate=False)
    elif args.job == "medallion":
        paths = LayerPaths.under(args.root, args.silver_table, args.gold_table, args.format)
        gold = run_medallion(spark, spark.read.parquet(args.bronze), paths)
        preview(gold, ["tienda_id"], PREVIEW_ROWS).show(truncate=False)
    elif args.job == "publish":
        rows = first_n(sales_csv(spark, args.csv), args.limit, args.order_by)
        opts = kafka_sink_options(args.brokers, args.topic) if args.format == "kafka" else None
        if args.ordered:
            publish_in_order(rows, args.ordered, fmt=args.format, options=opts, path=args.path, order_by=("fecha", "id_transaccion"))
        else:
            publish_sales(rows, fmt=args.format, options=opts, path=args.path)
    elif args.job == "stream-table":
        formats = ["route"] if args.provider != "parquet" else None
        ensure_table(spark, args.table, provider=args.provider, location=args.location, partition_by=formats, evolve=args.evolve)
        ingest_to_table(_stream(spark, args), args.table, args.checkpoint, trigger_of(args)).awaitTermination()
    elif args.job == "stream-files":
        ingest_to_parquet(_stream(spark, args), args.path, args.checkpoint, trigger_of(args)).awaitTermination()
    elif args.job in ("stream-landing", "stream-gold"):
        ingest = ingest_to_gold if args.job == "stream-gold" else ingest_to_versions
        ingest(_stream(spark, args), args.root, args.checkpoint, args.name, trigger_of(args)).awaitTermination()
    elif args.job == "models":
        found, sources = load_project(args.project)
        sources |= dict(x.split("=", 1) for x in args.source)
        outcomes = build_models(spark, found, sources, args.root, args.select.split(",") if args.select else None)
        build_report(spark, outcomes).show(len(outcomes), truncate=False)  # a row for each model
        if any(o.status != "built" for o in outcomes):
            raise SystemExit(1)
    elif args.job == "silver-months":
        bronze = spark.read.parquet(args.bronze)
        if args.months:
            rebuild_silver_months(spark, bronze, args.root, [tuple(map(int, m.split("-"))) for m in args.months.split(",")])
        else:
            build_silver_version(spark, bronze, args.root)
    elif args.job == "compact":
        print(f"{compact(spark, args.root, args.target_mb << 20)} folders packed")
    elif args.job == "vacuum":
        print(f"{len(vacuum(spark, args.root, args.keep, args.older_than_hours * 3600))} folders deleted")


if __name__ == "__main__":
    run()
