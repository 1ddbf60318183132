"""Helpers shared by the operators: written intermediate tables and connected components."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffle_files_freed(spark: SparkSession):
    """Inside, each finished job frees its shuffle files at once: what it made is in a written table."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a new folder under ``spark.checkpoint.dir`` and read it back.

    The lineage ends at files that every executor can read, so a lost executor costs a re-read
    and not a recomputation. The declared schema is used on reading, so an empty table is fine.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{label}")
    with shuffle_files_freed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """Connected components of an undirected graph: (id, component = smallest id reachable).

    ``edges`` has two columns of one integer type; loops, repeats and nulls in it are harmless.
    Only ids with an edge to another id appear in the result.

    Each round hooks every vertex to its smallest neighbour, jumps one pointer further and
    contracts the edges, which at least halves the vertices still joined by edges; the number of
    rounds is logarithmic. Rows are only aggregated (with a map-side step) and joined to a side
    with one row per key, so a hub of any degree is split like any other skewed join key.
    """
    a, b = edges.columns[:2]
    pairs = edges.select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).where("u < v").distinct()
    pairs, names, step = stored(pairs, label), None, 0
    while not pairs.isEmpty():
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("id"), F.least("u", "m").alias("up"))
        low = stored(low, f"{label}-up{step}")
        far = low.select(F.col("id").alias("up"), F.col("up").alias("upper"))
        hop = stored(low.join(far, "up").select("id", F.col("upper").alias("to")), f"{label}-hop{step}")
        left = hop.select(F.col("id").alias("u"), F.col("to").alias("x"))
        right = hop.select(F.col("id").alias("v"), F.col("to").alias("y"))
        pairs = stored(
            pairs.join(left, "u").join(right, "v")
            .select(F.least("x", "y").alias("u"), F.greatest("x", "y").alias("v")).where("u < v").distinct(),
            f"{label}-edges{step}")
        if names is None:
            names = hop
        else:
            nxt = hop.select(F.col("id").alias("to"), F.col("to").alias("next"))
            names = stored(names.join(nxt, "to", "left").select("id", F.coalesce("next", "to").alias("to")),
                           f"{label}-names{step}")
        step += 1
    if names is None:
        return pairs.select(F.col("u").alias("id"), F.col("v").alias("component"))
    # the last representative of a component is its smallest id: hooking only ever goes down
    return names.select("id", F.col("to").alias("component"))
