"""Packing by optimal length buckets.

A sequence is a piece of at most ``max_len`` words of a document (longer documents give several
pieces, none is cut short). A dynamic program over the histogram of piece lengths of the whole
table chooses the ``n_buckets`` upper bounds that minimise the padding; batches of at most
``token_budget`` padded words are then filled inside each bucket, in order of (doc_id, piece).

The histogram has at most ``max_len`` rows whatever the input, so it may come to the driver.
Positions inside a bucket need no single sorted task: pieces are range-partitioned, each
partition counts its pieces per bucket, and the running totals of these few counts give every
partition the position at which it goes on.

With ``length_col`` the sequences are measured by a column, such as the tokens that an encoder has counted, and no text is read; a
null or negative length is none.

Defined results: a document without words (null or blank text) gives one row with zero words,
bucket 0 and no batch. Repeated rows are separate pieces. Null ids sort first. An empty table
gives an empty result. Columns other than id and text are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

MAX_LEN, N_BUCKETS, TOKEN_BUDGET = 2048, 8, 65_536
SPACE = r"[\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words (runs without ASCII white space); 0 for null."""
    body = F.regexp_replace(F.coalesce(text, F.lit("")), rf"^{SPACE}|{SPACE}$", "")
    return F.when(body == "", F.lit(0)).otherwise(F.size(F.split(body, SPACE))).cast("bigint")


def bucket_bounds(histogram: dict[int, int], n_buckets: int) -> list[int]:
    """Ascending upper bounds, at most ``n_buckets``, that minimise the padded total.

    Among equally good choices the last bucket is the longest run, then the one before it, and so
    on; fewer buckets win over more at the same padding.
    """
    lengths = np.array(sorted(x for x in histogram if x > 0), np.int64)
    if not len(lengths):
        return []
    counts = np.concatenate([[0], np.cumsum([histogram[int(x)] for x in lengths])]).astype(np.int64)
    n = len(lengths)
    best = np.concatenate([[0], lengths * counts[1:]])  # padded total of the first j lengths in one bucket
    best_all, cuts, used = [best], [], 1
    for _ in range(min(n_buckets, n) - 1):
        nxt, cut = best.copy(), np.zeros(n + 1, np.int64)
        for j in range(1, n + 1):
            total = best[:j] + lengths[j - 1] * (counts[j] - counts[:j])
            cut[j] = int(np.argmin(total))
            nxt[j] = total[cut[j]]
        cuts.append(cut)
        best_all.append(nxt)
        best = nxt
        if best_all[-1][n] < best_all[used - 1][n]:
            used = len(best_all)
    bounds, j = [], n
    for k in range(used - 1, 0, -1):
        bounds.append(int(lengths[j - 1]))
        j = int(cuts[k - 1][j])
    if j:
        bounds.append(int(lengths[j - 1]))
    return sorted(bounds)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_len: int = MAX_LEN,
         n_buckets: int = N_BUCKETS, token_budget: int = TOKEN_BUDGET, length_col: str | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, n_words (or what ``length_col`` counts), bucket (padded length), batch, place in the batch."""
    if token_budget < max_len:
        raise ValueError("token_budget must hold at least one sequence of max_len")
    words = word_count(F.col(text_col)) if length_col is None else F.greatest(F.coalesce(F.col(length_col).cast("bigint"), F.lit(0)), F.lit(0))
    sized = docs.select(F.col(id_col).alias("doc_id"), words.alias("words"))
    last = F.greatest(F.lit(0), F.ceil(F.col("words") / max_len) - 1).cast("int")
    pieces = stored(
        sized.select("doc_id", "words", F.explode(F.sequence(F.lit(0), last)).alias("piece"))
        .select("doc_id", "piece", F.least(F.lit(max_len), F.col("words") - F.col("piece") * max_len).alias("n_words")),
        "pieces")
    histogram = {r["n_words"]: r["n"] for r in pieces.groupBy("n_words").agg(F.count("*").alias("n")).collect()}
    bounds = bucket_bounds(histogram, n_buckets)
    bucket = F.lit(0)
    for b in reversed(bounds):
        bucket = F.when((F.col("n_words") > 0) & (F.col("n_words") <= b), F.lit(b)).otherwise(bucket)
    order = ["doc_id", "piece", "n_words"]
    ranged = stored(
        pieces.withColumn("bucket", bucket.cast("int")).repartitionByRange(*order)
        .sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()), "ranged")
    runs = ranged.groupBy("bucket", "part").agg(F.count("*").alias("n"))
    before = runs.select("bucket", "part", (
        F.sum("n").over(Window.partitionBy("bucket").orderBy("part")) - F.col("n")).alias("before"))
    here = F.row_number().over(Window.partitionBy("bucket", "part").orderBy(*order))
    at = F.col("before") + F.col("here") - 1
    per = F.floor(F.lit(token_budget) / F.col("bucket")).cast("bigint")
    return (ranged.withColumn("here", here).join(before, ["bucket", "part"])
            .select("doc_id", "piece", "n_words", "bucket",
                    F.when(F.col("bucket") > 0, F.floor(at / per).cast("bigint")).alias("batch"),
                    F.when(F.col("bucket") > 0, (at % per).cast("bigint")).alias("place"))
            .withColumnRenamed("doc_id", id_col))


def oracle_sql(max_len: int = MAX_LEN, n_buckets: int = N_BUCKETS, token_budget: int = TOKEN_BUDGET) -> str:
    """The same over table ``documents`` in DuckDB SQL: the dynamic program as one step per bucket."""
    steps = ["s1 AS (SELECT b AS j, len * below AS cost, [len] AS bounds FROM h)"]
    for k in range(2, n_buckets + 1):
        steps.append(
            f"s{k} AS (SELECT j, cost, bounds FROM (SELECT h.b AS j, p.cost + h.len * (h.below - q.below) AS cost, "
            f"list_append(p.bounds, h.len) AS bounds, row_number() OVER (PARTITION BY h.b ORDER BY "
            f"p.cost + h.len * (h.below - q.below), p.j) AS rn FROM h JOIN s{k - 1} p ON p.j < h.b "
            f"JOIN h q ON q.b = p.j) WHERE rn = 1)")
    ends = " UNION ALL ".join(f"SELECT {k} AS k, cost, bounds FROM s{k} WHERE j = (SELECT max(b) FROM h)"
                              for k in range(1, n_buckets + 1))
    return f"""
WITH w AS (SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS words FROM documents),
p AS (SELECT doc_id, words, unnest(range(0, greatest(1, (words + {max_len - 1}) // {max_len})))::INT AS piece FROM w),
pieces AS (SELECT doc_id, piece, least({max_len}, words - piece * {max_len})::BIGINT AS n_words FROM p),
c AS (SELECT n_words AS len, count(*) AS n FROM pieces WHERE n_words > 0 GROUP BY 1),
h AS MATERIALIZED (SELECT len, row_number() OVER (ORDER BY len) AS b, (sum(n) OVER (ORDER BY len))::BIGINT AS below FROM c),
{", ".join(x.replace(" AS (SELECT", " AS MATERIALIZED (SELECT", 1) for x in steps)},
best AS (SELECT bounds FROM ({ends}) ORDER BY cost, k LIMIT 1),
bounds AS (SELECT unnest(bounds) AS bound FROM best),
x AS (SELECT doc_id, piece, n_words, coalesce((SELECT min(bound) FROM bounds WHERE n_words > 0 AND bound >= n_words), 0)::INT AS bucket FROM pieces),
r AS (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY doc_id, piece, n_words) - 1 AS pos FROM x)
SELECT doc_id, piece, n_words, bucket,
  CASE WHEN bucket > 0 THEN (pos // ({token_budget} // bucket))::BIGINT END AS batch,
  CASE WHEN bucket > 0 THEN (pos % ({token_budget} // bucket))::BIGINT END AS place FROM r"""
