"""Per-store totals: the benchmark query and its variants.

All aggregates are hash aggregates with a partial (map-side) step, so a store holding a
third of all rows is pre-aggregated inside every task before the shuffle; the shuffle carries
at most one row per store per task.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.money import exact_avg, exact_sum, merge_parts_sql, sum_parts_sql, total_sql


def filter_min_amount(df: DataFrame, min_amount: float = 100.0, amount: str = "monto") -> DataFrame:
    """Rows whose amount is strictly above ``min_amount`` (NULL amounts are dropped)."""
    return df.filter(F.col(amount) > F.lit(float(min_amount)))


def store_totals(df: DataFrame, min_amount: float | None = 100.0, key: str = "tienda_id",
                 amount: str = "monto") -> DataFrame:
    """Filter ``amount > min_amount``, group by store, exact sum and mean, ordered by store."""
    if min_amount is not None:
        df = filter_min_amount(df, min_amount, amount)
    return (df.groupBy(key)
            .agg(exact_sum(amount).alias("monto_total"),
                 exact_avg(amount).alias("monto_promedio"))
            .orderBy(key))


def store_sum(df: DataFrame, key: str = "tienda_id", amount: str = "monto") -> DataFrame:
    """Sum of amounts per store, no filter."""
    return df.groupBy(key).agg(exact_sum(amount).alias("monto_total"))


def row_count(df: DataFrame) -> DataFrame:
    """Number of rows, as a one-row DataFrame."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def store_sum_with_total(df: DataFrame, key: str = "tienda_id", amount: str = "monto") -> DataFrame:
    """Per-store sums and row counts plus one grand-total row, from a single scan.

    The data is aggregated once per store; the grand total is rolled up from those per-store
    partials (exact, since their parts are integers), so no second pass and no row duplication.
    ``is_total`` = 1 marks the total row; a NULL store keeps its own row with ``is_total`` = 0.
    """
    parts = sum_parts_sql(amount)
    names = {name: f"_{name}" for name in parts}
    per_store = df.groupBy(key).agg(*[F.expr(sql).alias(names[name]) for name, sql in parts.items()],
                                    F.count(F.lit(1)).alias("_rows"))
    return (per_store.rollup(key)
            .agg(F.grouping(key).cast("int").alias("is_total"),
                 F.expr(total_sql(merge_parts_sql(names))).alias("monto_total"),
                 F.sum("_rows").alias("n_rows")))


def store_sum_observing_rows(df: DataFrame, key: str = "tienda_id", amount: str = "monto"
                             ) -> tuple[DataFrame, Observation]:
    """Per-store sums, with the input's row count as a side metric of the same scan.

    The count is observed while the sums are computed (no second pass, no extra result row);
    read ``observation.get["n_rows"]`` after an action on the returned DataFrame. It is observed
    before the shuffle, and Spark may count a map stage twice if it re-runs after an executor
    loss; where the total must be exact under failures, use ``store_sum_with_total``.
    """
    obs = Observation(f"rows_{uuid.uuid4().hex[:8]}")
    observed = df.observe(obs, F.count(F.lit(1)).alias("n_rows"))
    return store_sum(observed, key, amount), obs


def _total_order(df: DataFrame, order_by: list[str]) -> list[str]:
    """The given columns, then all others that have an order: rows that tie on the former still have one order."""
    rest = [f.name for f in df.schema.fields
            if f.name not in order_by and not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return [*order_by, *[f"`{c}`" for c in rest]]


def preview(df: DataFrame, order_by: list[str], n: int = 5) -> DataFrame:
    """First ``n`` rows in a total order (top-n, no global sort of the input)."""
    return df.orderBy(*_total_order(df, order_by)).limit(n)


def first_n(df: DataFrame, n: int | None, order_by: str = "id_transaccion") -> DataFrame:
    """The first ``n`` rows by ``order_by``, ties by the other columns; all rows (unsorted) when ``n`` is None."""
    if n is None:
        return df
    return df.orderBy(*_total_order(df, [order_by])).limit(int(n))
