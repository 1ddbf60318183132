"""Gated medallion build: bronze -> silver -> test -> gold -> test.

Each layer is written once and read back, so the next layer reads stored files instead of
recomputing the upstream plan, and the lineage is cut at every layer edge. Silver's tests
(NULL counts) are observed during its own write; gold (one row per store) is tested on the
written table. A failing test raises before the next layer is written.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.layers import SILVER_PARTITIONS, to_gold, to_silver, with_comments, write_layer
from ..operators.quality import dq_report, observe_not_null, require_clean, require_observed_clean
from ..schemas import GOLD_CONTRACT, SILVER_CONTRACT, ModelContract
from ..sources.versions import read_layer, stage


@dataclass(frozen=True)
class LayerPaths:
    """Where the layers go: folders, and optionally catalog tables (required for a table format)."""
    silver: str | None
    gold: str | None
    silver_table: str | None = None
    gold_table: str | None = None
    fmt: str = "parquet"

    @classmethod
    def under(cls, root: str, silver_table: str | None = None, gold_table: str | None = None,
              fmt: str = "parquet") -> "LayerPaths":
        root = root.rstrip("/")
        return cls(f"{root}/silver/sales", f"{root}/gold/store_sales", silver_table, gold_table, fmt)


def _read_layer(spark: SparkSession, path: str | None, table: str | None, written: DataFrame,
                contract: ModelContract) -> DataFrame:
    """A written layer, read with the schema it was written with: an empty layer (no file at all) reads as
    no rows, columns keep their order, and every column its description."""
    if table:
        return spark.table(table)
    return with_comments(spark.read.schema(written.schema).parquet(path).select(written.columns), contract)


def build_silver(spark: SparkSession, bronze: DataFrame, paths: LayerPaths,
                 partitioned: bool = True, gate: bool = True) -> DataFrame:
    """Write silver; its NULL counts are observed during that same write (no second pass)."""
    spec = observe_not_null(SILVER_CONTRACT) if gate else None
    silver = to_silver(bronze)
    write_layer(silver, paths.silver, SILVER_CONTRACT, partition_by=SILVER_PARTITIONS if partitioned else None,
                table=paths.silver_table, fmt=paths.fmt, observe=spec)
    if gate:
        require_observed_clean(spec[0], SILVER_CONTRACT)
    return _read_layer(spark, paths.silver, paths.silver_table, silver, SILVER_CONTRACT)


def build_gold(spark: SparkSession, silver: DataFrame, paths: LayerPaths, gate: bool = True) -> DataFrame:
    # Files clustered by store (tight min/max statistics per file), without a global sort.
    built = to_gold(silver)
    write_layer(built.sortWithinPartitions("tienda_id"), paths.gold, GOLD_CONTRACT,
                table=paths.gold_table, fmt=paths.fmt)
    gold = _read_layer(spark, paths.gold, paths.gold_table, built, GOLD_CONTRACT)
    if gate:
        require_clean(dq_report(gold, GOLD_CONTRACT))
    return gold


def run_medallion(spark: SparkSession, bronze: DataFrame, root: str | LayerPaths, gate: bool = True,
                  partitioned: bool = True) -> DataFrame:
    """Build silver and gold under ``root`` (a folder, or ``LayerPaths`` naming catalog tables and
    a format), overwriting, testing each; return gold."""
    paths = root if isinstance(root, LayerPaths) else LayerPaths.under(root)
    silver = build_silver(spark, bronze, paths, partitioned=partitioned, gate=gate)
    return build_gold(spark, silver, paths, gate=gate)


# ---- silver as a versioned layer: rebuilt whole or by months, without a moment without it --------------


def build_silver_version(spark: SparkSession, bronze: DataFrame, root: str, gate: bool = True) -> DataFrame:
    """Silver as a new version of the layer at ``root``. Readers see it once it is whole and tested, and keep the version
    before it if the write dies or a test fails."""
    return _publish_silver(spark, with_comments(to_silver(bronze), SILVER_CONTRACT), root, gate)


def rebuild_silver_months(spark: SparkSession, bronze: DataFrame, root: str, months: Sequence[tuple[int, int]],
                          gate: bool = True) -> DataFrame:
    """Silver with the given months (year, month) made anew from bronze, all others as they are. Reads the rows of these months
    only (a range of sale times that reaches the scan) and writes their folders only; months that are next to one another are one
    range. A month without sales any more goes."""
    if not months:
        return read_layer(spark, root)
    ranges: list[list[int]] = []
    for n in sorted({y * 12 + m - 1 for y, m in months}):
        if ranges and ranges[-1][1] == n:
            ranges[-1][1] = n + 1
        else:
            ranges.append([n, n + 1])

    def start(n: int) -> str:
        return f"TIMESTAMP_NTZ '{n // 12:04d}-{n % 12 + 1:02d}-01 00:00:00'"

    touched = " OR ".join(f"(fecha_venta >= {start(a)} AND fecha_venta < {start(b)})" for a, b in ranges)
    silver = with_comments(to_silver(bronze).where(F.expr(touched)), SILVER_CONTRACT)
    cleared = ["/".join(f"{c}={v}" for c, v in zip(SILVER_PARTITIONS, month)) for month in months]
    return _publish_silver(spark, silver, root, gate, "partitions", cleared)


def _publish_silver(spark: SparkSession, silver: DataFrame, root: str, gate: bool, *publish) -> DataFrame:
    spec = observe_not_null(SILVER_CONTRACT) if gate else None
    staged = stage(silver, root, SILVER_PARTITIONS, observe=spec)
    if gate:
        require_observed_clean(spec[0], SILVER_CONTRACT)
    staged.publish(*publish)
    return read_layer(spark, root)
