"""Sharding by a permutation-filled lookup table.

Every shard has its own permutation of the slots of a prime-sized table (an offset and a step
drawn from its name). The shards take turns; at its turn a shard claims the first slot of its
permutation that is still free, until the table is full. A key's slot is its hash modulo the
table size, its shard the slot's owner: one lookup, even shares, and few keys move when the list
of shards changes. The table has a fixed number of entries whatever the data, so broadcasting it
is bounded by construction.

Defined results: a null key is hashed as the empty text; repeated keys go to the same shard; an
empty table gives an empty result; columns other than the key are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TABLE_SIZE = 65_537  # a prime
SHARDS = tuple(f"shard-{i:03d}" for i in range(100))


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def lookup_table(shards: Sequence[str] = SHARDS, size: int = TABLE_SIZE) -> np.ndarray:
    """The owner (index into ``shards``) of every slot."""
    if not _is_prime(size):
        raise ValueError("size must be a prime: a step must visit every slot")
    if not shards or len(set(shards)) != len(shards) or len(shards) > size:
        raise ValueError("shards must be distinct names, at least one and at most size of them")
    digests = [hashlib.md5(name.encode()).digest() for name in shards]
    place = [int.from_bytes(d[:8], "little") % size for d in digests]
    step = [int.from_bytes(d[8:], "little") % (size - 1) + 1 for d in digests]
    owner = np.full(size, -1, np.int32)
    claimed = 0
    while True:
        for shard in range(len(shards)):
            while owner[place[shard]] >= 0:
                place[shard] = (place[shard] + step[shard]) % size
            owner[place[shard]] = shard
            claimed += 1
            if claimed == size:
                return owner


def slot_of(key: Column, size: int = TABLE_SIZE) -> Column:
    """Slot of a key: the first 60 bits of the MD5 of its text, modulo the table size."""
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 15)
    return F.pmod(F.conv(digits, 16, 10).cast("bigint"), F.lit(size)).cast("int")


def place(df: DataFrame, key: str = "doc_id", shards: Sequence[str] = SHARDS, size: int = TABLE_SIZE) -> DataFrame:
    """(key, slot, shard) for every row."""
    owner = lookup_table(shards, size)
    table = df.sparkSession.createDataFrame(
        [(slot, shards[o]) for slot, o in enumerate(owner.tolist())], "slot int, shard string")
    keyed = df.select(F.col(key).alias("key")).withColumn("slot", slot_of(F.col("key"), size))
    return keyed.join(F.broadcast(table), "slot").select(F.col("key").alias(key), "slot", "shard")
