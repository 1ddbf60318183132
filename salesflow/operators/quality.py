"""Data-quality checks: contract tests, duplicate keys, the gate, and tolerant reconciliation."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import ModelContract


class DataQualityError(RuntimeError):
    """Raised by ``require_clean`` when a contract test fails."""


def duplicate_keys(df: DataFrame, keys: list[str] | str) -> DataFrame:
    """Key values that occur more than once (NULL keys left out), with their row counts."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    not_null = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return (df.filter(not_null).groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("n_records"))
            .filter(F.col("n_records") > 1))


REPORT_SCHEMA = "model string, column_name string, test string, failures bigint"


def dq_report(df: DataFrame, contract: ModelContract) -> DataFrame:
    """One row per declared test: (model, column_name, test, failures).

    ``not_null`` failures = rows with NULL; ``unique`` failures = distinct non-NULL values that
    occur more than once (NULL is left to ``not_null``). With at most one ``unique`` column the
    whole report is one pass over the data: rows are grouped by that column (partial counts per
    task, so a hot key costs nothing extra) and the NULL counts ride along per group.
    """
    nn, uq = contract.tested("not_null"), contract.tested("unique")
    if not nn and not uq:
        raise ValueError(f"contract {contract.name!r} declares no tests")
    if len(uq) > 1:
        parts = [_not_null_counts(df, nn)] if nn else []
        parts += [_unique_counts(df, c) for c in uq]
        report = reduce(DataFrame.unionByName, parts)
    elif uq:
        report = _one_pass(df, nn, uq[0])
    else:
        report = _not_null_counts(df, nn)
    return report.select(F.lit(contract.name).alias("model"), "column_name", "test", "failures")


def _not_null_counts(df: DataFrame, nn: list[str]) -> DataFrame:
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in nn])
    return (counts.unpivot([], nn, "column_name", "failures")
            .select(F.lit("not_null").alias("test"), "column_name", "failures"))


def _unique_counts(df: DataFrame, col: str) -> DataFrame:
    return (duplicate_keys(df, col).agg(F.count(F.lit(1)).alias("failures"))
            .select(F.lit("unique").alias("test"), F.lit(col).alias("column_name"), "failures"))


def _one_pass(df: DataFrame, nn: list[str], key: str) -> DataFrame:
    others = [c for c in nn if c != key]
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"),
                                  *[F.count_if(F.col(c).isNull()).alias(c) for c in others])
    k = F.col(key)
    sums = per_key.agg(
        F.count_if(k.isNotNull() & (F.col("_rows") > 1)).alias("_unique"),
        F.coalesce(F.sum(F.when(k.isNull(), F.col("_rows"))), F.lit(0)).alias("_key_nulls"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in others])
    cells = [F.struct(F.lit("unique").alias("test"), F.lit(key).alias("column_name"),
                      F.col("_unique").alias("failures"))]
    cells += [F.struct(F.lit("not_null").alias("test"), F.lit(c).alias("column_name"),
                       (F.col("_key_nulls") if c == key else F.col(c)).alias("failures")) for c in nn]
    return sums.select(F.inline(F.array(*cells)))


def observe_not_null(contract: ModelContract) -> tuple[Observation, list]:
    """An observation of the contract's NULL counts: ``(observation, metric columns)``.

    Hand it to ``write_layer(observe=...)``: the counts are then computed by the layer write
    itself (no extra pass), in its final stage, where each partition's update is applied once
    even if earlier stages are recomputed after an executor loss.
    """
    nn = contract.tested("not_null")
    if not nn or contract.tested("unique"):
        raise ValueError("only not_null contracts can be observed during a write")
    obs = Observation(f"dq_{contract.name}_{uuid.uuid4().hex[:8]}")
    return obs, [F.count_if(F.col(c).isNull()).alias(c) for c in nn]


def observed_report(spark, obs: Observation, contract: ModelContract) -> DataFrame:
    """The report of ``observe_not_null`` once the action has run (one row per test)."""
    metrics = obs.get
    rows = [(contract.name, c, "not_null", int(metrics[c])) for c in contract.tested("not_null")]
    return spark.createDataFrame(rows, REPORT_SCHEMA)


def require_observed_clean(obs: Observation, contract: ModelContract) -> dict[str, int]:
    """Stop (raise) if an observed NULL count of the contract is above zero; no Spark job (the
    counts already sit on the driver once the observed action has run)."""
    metrics = {c: int(obs.get[c]) for c in contract.tested("not_null")}
    failed = {c: n for c, n in metrics.items() if n > 0}
    if failed:
        detail = "; ".join(f"{contract.name}.{c} not_null: {n}" for c, n in failed.items())
        raise DataQualityError(f"data tests failed: {detail}")
    return metrics


def require_clean(report: DataFrame) -> DataFrame:
    """Stop (raise) if any test in the report failed; otherwise return the report.

    The report holds one row per declared test, so collecting it is bounded.
    """
    failed = report.filter(F.col("failures") > 0).collect()
    if failed:
        detail = "; ".join(f"{r['model']}.{r['column_name']} {r['test']}: {r['failures']}" for r in failed)
        raise DataQualityError(f"data tests failed: {detail}")
    return report


# Fixed values, as the reference's cross-engine check uses them: absolute tolerance 1e-5 and
# the comparison library's default relative tolerance 1e-5.
ATOL = 1e-5
RTOL = 1e-5


def _kind(left: DataFrame, right: DataFrame, c: str) -> str:
    """How a column of both sides is compared: as whole numbers, as numbers or by its text."""
    pair = (left.schema[c].dataType, right.schema[c].dataType)
    if all(isinstance(t, T.IntegralType) for t in pair):
        return "whole"
    return "number" if all(isinstance(t, T.NumericType) for t in pair) else "other"


_FORMS = {"whole": lambda c: F.col(c).cast("decimal(20,0)"), "number": lambda c: F.col(c).cast("double"),
          "other": lambda c: F.col(c).cast("string")}

DIFFERENCE = "column_name string, left_value double, right_value double, left_text string, right_text string, status string"


def reconcile(left: DataFrame, right: DataFrame, keys: list[str] | str,
              columns: list[str] | None = None, atol: float = ATOL, rtol: float = RTOL) -> DataFrame:
    """Compare two results by key; one row per difference, none if they agree.

    All columns but the keys are compared unless ``columns`` names some. Numbers match when both are
    NULL, both NaN, or ``|l - r| <= atol + rtol * |r|``; whole numbers are subtracted as whole numbers, so none is too
    large to tell apart. Other types match when they are equal or both NULL. Keys match NULL-safely.

    Output: keys, column_name, left_value and right_value (numbers), left_text and right_text (other
    types, as text), status in {value_mismatch, missing_left, missing_right, duplicate_key,
    missing_column}. A column that only one side has is one row without keys.

    Both sides go through one grouping by the keys (one shuffle, with partial aggregates, no join), so a key
    that repeats any number of times is one row, reported as ``duplicate_key``.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    every = [c for c in dict.fromkeys([*left.columns, *right.columns]) if c not in keys]
    wanted = every if columns is None else list(columns)
    both = [c for c in wanted if c in left.columns and c in right.columns]
    lone = [c for c in wanted if c not in both]
    kinds = {c: _kind(left, right, c) for c in both}
    to = _FORMS

    def side(df: DataFrame, is_left: bool) -> DataFrame:
        return df.select(*keys, F.lit(is_left).alias("__left"), *[to[kinds[c]](c).alias(f"__{c}") for c in both])

    is_left = F.col("__left")
    grouped = side(left, True).unionByName(side(right, False)).groupBy(*keys).agg(
        F.count_if(is_left).alias("__n_l"), F.count_if(~is_left).alias("__n_r"),
        *[F.max(F.when(is_left, F.col(f"__{c}"))).alias(f"__l_{c}") for c in both],
        *[F.max(F.when(~is_left, F.col(f"__{c}"))).alias(f"__r_{c}") for c in both])

    def close(c: str) -> F.Column:
        lv, rv = F.col(f"__l_{c}"), F.col(f"__r_{c}")
        if kinds[c] == "other":
            return lv.eqNullSafe(rv)
        allowed = F.lit(float(atol)) + F.lit(float(rtol)) * F.abs(rv.cast("double"))
        near = F.abs(lv - rv).cast("double") <= allowed
        if kinds[c] == "number":  # a tolerance says nothing about infinite values: they are equal or not
            finite = (F.abs(lv) < float("inf")) & (F.abs(rv) < float("inf"))
            near = (near & finite) | (lv == rv)  # NaN equals NaN here
        same = (lv.isNull() & rv.isNull()) | near
        return F.coalesce(same, F.lit(False))

    empty = {"double": F.lit(None).cast("double"), "string": F.lit(None).cast("string")}

    def cell(name: F.Column, status: F.Column, c: str | None = None) -> F.Column:
        number = c is not None and kinds[c] != "other"
        text = c is not None and not number
        return F.struct(
            name.alias("column_name"),
            *[(F.col(f"__{s}_{c}").cast("double") if number else empty["double"]).alias(f"{n}_value") for s, n in (("l", "left"), ("r", "right"))],
            *[(F.col(f"__{s}_{c}") if text else empty["string"]).alias(f"{n}_text") for s, n in (("l", "left"), ("r", "right"))],
            status.alias("status"))

    n_l, n_r = F.col("__n_l"), F.col("__n_r")
    key_status = (F.when((n_l > 1) | (n_r > 1), F.lit("duplicate_key"))
                  .when(n_l == 0, F.lit("missing_left")).when(n_r == 0, F.lit("missing_right")))
    value_cells = [cell(F.lit(c), F.when(~close(c), F.lit("value_mismatch")), c) for c in both]
    cells = F.array(*value_cells) if value_cells else F.array().cast(f"array<struct<{DIFFERENCE.replace(' ', ':').replace(',:', ',')}>>")
    found = (grouped.select(*keys, F.explode(F.when(key_status.isNotNull(), F.array(cell(empty["string"], key_status)))
                                             .otherwise(cells)).alias("cell"))
             .filter(F.col("cell.status").isNotNull()).select(*keys, "cell.*"))
    if not lone:
        return found
    rows = [(c, None, None, *(("present" if c in df.columns else "absent") for df in (left, right)), "missing_column") for c in lone]
    absent = left.sparkSession.createDataFrame(rows, DIFFERENCE)
    return found.unionByName(absent.select(*[F.lit(None).cast(found.schema[k].dataType).alias(k) for k in keys], "*"))


# ---- reconciliation by digests ------------------------------------------------------------------------

FANOUT = 1024  # buckets of the first level, and parts of each that differs


def _row_digest(names: list[str]) -> dict[str, F.Column]:
    """Two 64-bit hashes of a row in four halves; they are added up, so the order of rows does not matter and repeats count."""
    cells = [F.col(c) for c in names] + [F.col(c).isNull() for c in names]  # a hash passes NULLs over
    out = {}
    for i in range(2):
        h = F.xxhash64(F.lit(i), *cells)
        out[f"low{i}"], out[f"high{i}"] = h.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(h, 32)
    return out


def _differing(left: DataFrame, right: DataFrame, bucket: str, digest: list[str]) -> DataFrame:
    """(bucket) of the buckets whose rows are not the same multiset on both sides: what is shuffled is a row for each
    bucket and task."""
    sides = left.select(F.lit(1).alias("__side"), bucket, *digest).unionByName(right.select(F.lit(-1).alias("__side"), bucket, *digest))
    sums = sides.groupBy(bucket).agg(F.sum("__side").alias("__rows"), *[F.sum(F.col("__side") * F.col(d)).alias(d) for d in digest])
    return sums.where(" OR ".join(f"`{c}` <> 0" for c in ("__rows", *digest))).select(bucket)


def reconcile_by_digest(left: DataFrame, right: DataFrame, keys: list[str] | str, columns: list[str] | None = None,
                        atol: float = ATOL, rtol: float = RTOL, fanout: int = FANOUT) -> DataFrame:
    """What ``reconcile`` gives, for tables that hardly differ: rows are shuffled only where digests do. A key that repeats on
    both sides with the same rows is no difference here (``duplicate_keys`` finds it); any other is reported.

    Both sides are hashed into ``fanout`` buckets by key, and each bucket's rows added up to a digest. Buckets that differ are cut
    into ``fanout`` parts in the same way, and the rows of the parts that differ are compared. Equal tables of any width cost one
    scan a side and ``fanout`` rows a task. Each further level scans both sides again, so tables that differ
    everywhere are better compared by ``reconcile`` at once. At most ``fanout`` squared bucket numbers are kept, in a broadcast list of
    16 MB at most.

    Digests of two 64-bit hashes take rows for equal that differ with a probability of about 2^-64 for each bucket.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    both = [c for c in (left.columns if columns is None else columns) if c in left.columns and c in right.columns and c not in keys]
    hashed = [*keys, *both]

    def side(df: DataFrame) -> DataFrame:
        formed = df.select("*", *[_FORMS[_kind(left, right, c)](c).alias(f"__f_{c}") for c in hashed])
        key = F.xxhash64(F.lit(2), *[F.col(f"__f_{k}") for k in keys], *[F.col(f"__f_{k}").isNull() for k in keys])
        return formed.select(*df.columns, F.pmod(key, F.lit(fanout)).alias("__coarse"), F.pmod(key, F.lit(fanout * fanout)).alias("__fine"),
                             *[c.alias(f"__d_{n}") for n, c in _row_digest([f"__f_{c}" for c in hashed]).items()])

    digest = [f"__d_{h}{i}" for i in range(2) for h in ("low", "high")]
    sides, none = [side(left), side(right)], left.limit(0)
    for level in ("__coarse", "__fine"):
        found = _differing(*sides, level, digest).toPandas()[level].tolist()  # at most fanout, then fanout for each of these
        if not found:
            return reconcile(none, right.limit(0), keys, columns, atol, rtol)
        listed = left.sparkSession.createDataFrame([(x,) for x in found], f"{level} bigint")
        sides = [s.join(F.broadcast(listed), level, "left_semi") for s in sides]
    back = [s.select(*df.columns) for s, df in zip(sides, (left, right))]
    return reconcile(*back, keys, columns, atol, rtol)
