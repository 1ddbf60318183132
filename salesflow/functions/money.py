"""Exact money arithmetic on DOUBLE amounts.

Amounts arrive as DOUBLE. A DOUBLE sum depends on the order rows meet in, which changes with
partitioning; the same query could give different last digits on two runs or two clusters.
An amount is therefore split into its whole part and its first ten decimals, the decimals into two
groups of five digits, and the three are summed as BIGINT: exact, order-free, long arithmetic inside
generated code, with a partial sum per task. The parts are joined as decimals once per group, so
amounts below a cent count in full. An amount counts with its first fifteen digits, ten decimals at most:
that is the decimal number it was written as, without the noise of its binary form.

Amounts that are not finite, or beyond ``LIMIT`` in size, have no such parts. A group that holds one (or
whose whole parts overflow BIGINT) gets the plain DOUBLE sum, as SUM gives it: infinite or NaN where that is
the sum, and never an error.

The sums exist as SQL text only once; the DataFrame operators and the SQL models both use it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LIMIT = "1E12D"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sum_parts_sql(amount: str) -> dict[str, str]:
    """The aggregates that an exact sum of a column is made of, as SQL text by name."""
    x = f"CAST({amount} AS DOUBLE)"
    plain = f"{x} BETWEEN -{LIMIT} AND {LIMIT}"
    whole = f"CASE WHEN {plain} THEN CAST({x} AS BIGINT) END"
    # a DOUBLE tells fifteen digits: the larger the whole part, the fewer decimals mean anything
    steps = " ".join(f"WHEN ABS({x}) < 1E{15 - d}D THEN CAST(RINT(({x} - CAST({x} AS BIGINT)) * 1E{d}D) AS BIGINT) * {10 ** (10 - d)}"
                     for d in range(10, 3, -1))
    decimals = (f"CASE WHEN NOT ({plain}) THEN NULL {steps} "
                f"ELSE CAST(RINT(({x} - CAST({x} AS BIGINT)) * 1E3D) AS BIGINT) * {10 ** 7} END")
    return {
        "whole": f"TRY_SUM({whole})",
        "upper": f"SUM({decimals} DIV 100000)",
        "lower": f"SUM({decimals} % 100000)",
        "odd": f"COUNT_IF(NOT ({plain}))",
        "plain": f"SUM({x})",
    }


def merge_parts_sql(names: dict[str, str]) -> dict[str, str]:
    """The aggregates that merge partial results held in the columns ``names``."""
    lost = f"COUNT_IF({names['whole']} IS NULL AND {names['upper']} IS NOT NULL)"
    return {
        "whole": f"TRY_SUM({names['whole']})",
        "upper": f"SUM({names['upper']})",
        "lower": f"SUM({names['lower']})",
        "odd": f"(SUM({names['odd']}) + {lost})",
        "plain": f"SUM({names['plain']})",
    }


def total_sql(parts: dict[str, str]) -> str:
    """The sum as DOUBLE from its parts; NULL for a group without any amount."""
    exact = (f"CAST(CAST({parts['whole']} AS DECIMAL(20,0)) + CAST({parts['upper']} AS DECIMAL(20,0)) * 0.00001BD "
             f"+ CAST({parts['lower']} AS DECIMAL(20,0)) * 0.0000000001BD AS DOUBLE)")
    return f"COALESCE(CASE WHEN {parts['odd']} = 0 THEN {exact} END, {parts['plain']})"


def exact_sum_sql(amount: str) -> str:
    return total_sql(sum_parts_sql(amount))


def exact_avg_sql(amount: str) -> str:
    return f"TRY_DIVIDE({exact_sum_sql(amount)}, COUNT({amount}))"


def exact_sum(amount: str) -> Column:
    """Exact sum of a column of amounts, as DOUBLE."""
    return F.expr(exact_sum_sql(amount))


def exact_avg(amount: str) -> Column:
    """Exact sum divided by the number of non-NULL amounts; NULL for a group without any."""
    return F.expr(exact_avg_sql(amount))


def round_amount(amount: Column | str, digits: int = 2, snap_digits: int = 6) -> Column:
    """Round to ``digits`` decimals, ties away from zero on the decimal value (SQL ROUND).

    The DOUBLE is first snapped to ``snap_digits`` decimals, which removes binary noise: a
    product such as 24606.145 stored as 24606.144999999997 rounds to 24606.15, as it should.
    Amounts up to 1e12 go through ``decimal(18, snap_digits)``, which is long-backed and cheap; larger
    ones, and values that are not finite, go through ROUND on the DOUBLE itself, which never fails.
    (Array libraries round ties to even on the binary value; the two differ only on exact ties.)
    """
    x = _col(amount)
    small = F.abs(x) < F.lit(1e12 - 1)
    snapped = F.when(small, x).cast(f"decimal(18,{snap_digits})")
    return F.when(small, F.round(snapped, digits).cast("double")).otherwise(F.round(x, digits))
