"""Messages numbered in order within their key: 1, 2, 3 ... without a gap, however many rows a key has.

A producer that walks through a file sends a store's sales in their order. Tasks that write side by side don't, and a key that one
task must order by itself is as slow as its largest store. Here rows are dealt by ranges of (key, order): each task sorts one run,
a large key is cut into consecutive runs. A row's number is its place in its run plus the rows that the key has in
the runs before. Only a run's first key can have such rows, so the list of what to add has at most a row for each run.

The messages are moved once. Numbers are fixed when the sorted runs are written, so a task that is run again gives
the same ones.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .messages import encode_messages

RUNS = "key string, value string, run int, place bigint"


def _placed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the task's run and each row's place among its key's rows in it; keys come sorted."""
    run, last, seen = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        key, n = batch.column(0), batch.num_rows
        if not n:
            continue
        new = np.concatenate([[key[0].as_py() != last], pc.not_equal(key[1:], key[:-1]).to_numpy(zero_copy_only=False)]).astype(bool)
        start = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        place = np.arange(n) - start
        place[:int(np.argmax(new)) if new.any() else n] += seen  # the key that the last batch ended with goes on
        last, seen = key[n - 1].as_py(), int(place[-1]) + 1
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(n, run, np.int32)), pa.array(place)], ["key", "value", "run", "place"])


def ordered_messages(df: DataFrame, staging: str, key: str = "tienda_id", order_by: Sequence[str] = ("fecha", "id"),
                     runs: int | None = None, columns: list[str] | None = None) -> DataFrame:
    """(key, value, seq): every row as a keyed JSON message with its number within the key, by ``order_by``.

    ``staging`` is a new folder on shared storage; it holds the sorted runs, which the result reads. Rows that are equal in
    key and order are numbered in any order. A NULL key is the key ``''``; NULLs come first in the order. ``runs`` is the number of
    runs (the session's shuffle partitions).
    """
    by = [F.col(f"`{c}`") for c in order_by]
    encoded = encode_messages(df, key, columns, also=[c.alias(f"by{i}") for i, c in enumerate(by)])
    sort = ["key", *[f"by{i}" for i in range(len(by))]]
    dealt = encoded.repartitionByRange(runs, *sort) if runs else encoded.repartitionByRange(*sort)
    sorted_runs = dealt.sortWithinPartitions(*sort).select("key", "value")
    sorted_runs.mapInArrow(_placed, RUNS).write.parquet(staging)
    placed = df.sparkSession.read.schema(RUNS).parquet(staging)
    before = Window.partitionBy("key").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    # at most a row for each run: the key that it continues
    more = placed.groupBy("key", "run").agg(F.count(F.lit(1)).alias("n")).select("key", "run", F.sum("n").over(before).alias("before")).where("before > 0")
    numbered = placed.join(F.broadcast(more), ["key", "run"], "left")
    seq = (F.col("place") + F.coalesce("before", F.lit(0)) + 1).alias("seq")
    return numbered.select("key", "value", seq)


def in_order(messages: DataFrame) -> DataFrame:
    """The messages so that each task, hence each file or sender, has those of a key by increasing number."""
    return messages.sortWithinPartitions("key", "seq")


def as_ordered_messages(messages: DataFrame) -> DataFrame:
    """(key, value, headers) as a broker sink takes them; the header ``seq`` carries the number as text, so that a consumer
    can tell a gap or a repeat, and put the messages of a key that several tasks sent in order."""
    header = F.struct(F.lit("seq").alias("key"), F.col("seq").cast("string").cast("binary").alias("value"))
    return messages.select(F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"), F.array(header).alias("headers"))


def sequence_faults(messages: DataFrame) -> DataFrame:
    """(key, n, distinct_n, first_seq, last_seq) of the keys whose numbers are not 1 to n, each once."""
    told = messages.groupBy("key", "seq").agg(F.count(F.lit(1)).alias("copies"))
    per_key = told.groupBy("key").agg(F.sum("copies").alias("n"), F.count(F.lit(1)).alias("distinct_n"),
                                      F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"))
    return per_key.where("n <> distinct_n OR first_seq <> 1 OR last_seq <> n")
