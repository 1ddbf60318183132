"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash over the last seven bytes ends a chunk wherever it falls into one residue class of
the block size, so boundaries depend on nearby content only and an edit changes the signature where
it happened. Each chunk gives one of 64 characters. The block size is the smallest that makes 64 chunks or fewer of a
text by its length, or less if it makes under 32. Texts that repeat themselves may still have a boundary in every period, so a signature is
bounded: of a run of one character the first ``RUN`` stay, and the last of ``MOST`` characters covers all that is left of the
text. A signature has 256 characters at most, which ordinary texts never reach, and comparing two takes a
bounded time whatever the texts are. A fingerprint is ``block:signature:signature``,
the second signature taken at twice the block size. Two fingerprints are compared at the block sizes
they share: likeness is one minus the insert/delete distance over the joined length of the
signatures, and 0 unless the signatures have a run of seven characters in common (a third of the
shorter one, but three at least, if that is less), which unrelated texts practically never have.

Both hashes of a text are computed at once for all positions with wrap-around 64-bit arithmetic:
chunk hashes are differences of a running sum of byte values times powers of an odd number, brought
to a common scale by powers of its inverse.

The edited text of a document takes its tail from the next document in descending id order.
Documents are dealt once into contiguous id ranges and sorted inside; the first document of each
range also goes, as a copy, to the end of the range before it, so that every document meets its
successor without a global sort in one task and the texts are shuffled once.

Defined results: a null text counts as empty; the empty text has the fingerprint ``4::`` and equal
fingerprints have likeness 1. Documents of equal id are ordered by text. A document of null id has
no place in the order: what follows it is the empty text. A table of one row has
itself as next. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SMALLEST, WINDOW, LENGTH, COMMON = 4, 7, 64, 7  # block sizes are powers of two
RUN, MOST = 3, 4 * LENGTH
ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
STEP = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
PIECE = 1 << 16
RANGES_PER_PARTITION = 4

_up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(PIECE - 1, STEP)]))
_down = np.cumprod(np.concatenate([[np.uint64(1)], np.full(PIECE - 1, BACK)]))


def _powers(base: np.ndarray, factor: np.uint64, n: int) -> np.ndarray:
    if n <= PIECE:
        return base[:n]
    rows = -(-n // PIECE)
    ahead = np.uint64(pow(int(factor), PIECE, 1 << 64))
    scale = np.cumprod(np.concatenate([[np.uint64(1)], np.full(rows - 1, ahead)]))
    return (scale[:, None] * base[None, :]).ravel()[:n]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def fingerprint(text: bytes) -> str:
    """``block:signature:signature at twice the block size``."""
    n = len(text)
    block = SMALLEST
    while block * LENGTH < n:
        block *= 2
    if not n:
        return f"{block}::"
    byte = np.frombuffer(text, np.uint8).astype(np.uint64) + np.uint64(1)
    total = np.concatenate([[np.uint64(0)], np.cumsum(byte * _powers(_up, STEP, n), dtype=np.uint64)])
    scale = _powers(_down, BACK, n + 1)
    # what the last seven bytes (fewer at the start) up to each position are, wherever they stand
    rolling = total[1:].copy()
    if n > WINDOW:
        rolling[WINDOW:] = (total[WINDOW + 1:] - total[1:-WINDOW]) * scale[1:-WINDOW]
    rolling = _mixed(rolling)

    def signature(size: int) -> tuple[str, int]:
        """(the signature, the number of chunks)."""
        cut = np.flatnonzero(rolling & np.uint64(size - 1) == np.uint64(size - 1)) + 1
        if len(cut) == 0 or cut[-1] != n:
            cut = np.append(cut, n)
        first = np.concatenate([[0], cut[:-1]])

        def letters(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            return ALPHABET[(_mixed((total[b] - total[a]) * scale[a]) >> np.uint64(40)).astype(np.int64) & 63]

        chunk = letters(first, cut)
        again = np.zeros(len(chunk), bool)
        if len(chunk) > RUN:  # a run of one letter stands for itself RUN times
            again[RUN:] = np.all([chunk[RUN:] == chunk[RUN - k:-k] for k in range(1, RUN + 1)], 0)
        kept = np.flatnonzero(~again)
        if len(kept) > MOST:  # the last letter covers all that is left
            rest = cut[kept[MOST - 2]:kept[MOST - 2] + 1]
            return (chunk[kept[:MOST - 1]].tobytes() + letters(rest, np.array([n])).tobytes()).decode(), len(chunk)
        return chunk[kept].tobytes().decode(), len(chunk)

    one, chunks = signature(block)
    while block > SMALLEST and chunks < LENGTH // 2:
        block //= 2
        one, chunks = signature(block)
    return f"{block}:{one}:{signature(block * 2)[0]}"


def _common_run(a: str, b: str) -> bool:
    short = min(len(a), len(b))
    if not short:
        return False
    k = min(COMMON, short, max(3, short // 3))
    seen = {a[i:i + k] for i in range(len(a) - k + 1)}
    return any(b[i:i + k] in seen for i in range(len(b) - k + 1))


def signature_likeness(a: str, b: str) -> float:
    """1 - (insert/delete distance) / (joined length), by the longest common subsequence in bit-parallel form."""
    if a == b:
        return 1.0
    if not _common_run(a, b):
        return 0.0
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & where.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return 2 * (len(a) - row.bit_count()) / (len(a) + len(b))


def likeness(x: str, y: str) -> float:
    """Likeness of two fingerprints, from 0 to 1; 0 where their block sizes are not compatible."""
    if x == y:
        return 1.0
    (bx, x1, x2), (by, y1, y2) = x.split(":"), y.split(":")
    bx, by = int(bx), int(by)
    if bx == by:
        return max(signature_likeness(x1, y1), signature_likeness(x2, y2))
    if bx == 2 * by:
        return signature_likeness(x1, y2)
    if by == 2 * bx:
        return signature_likeness(x2, y1)
    return 0.0


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by as much of the start of the following text."""
    cut = len(text) // 3
    return text[:len(text) - cut] + following[:cut]


def _dealt(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows (doc_id, text, range, copy): descending id ranges, each with a copy of the next range's first rows."""
    d = docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                    F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    n = RANGES_PER_PARTITION * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids = (d.select("doc_id").where("doc_id is not null").repartitionByRange(n, F.col("doc_id").desc())
           .withColumn("range", F.spark_partition_id()))
    # one row for each range; their number is set by the caller's partitions, not by the data
    ends = ids.groupBy("range").agg(F.max("doc_id").alias("head"), F.min("doc_id").alias("low")).orderBy("range").collect()
    heads = {r["head"]: (at - 1) % len(ends) for at, r in enumerate(ends)}
    lows = np.array([-r["low"] for r in ends], np.int64)

    @F.pandas_udf("array<int>")
    def ranges(doc_id: pd.Series, spare: pd.Series) -> pd.Series:
        known = doc_id.notna().to_numpy()
        ids = doc_id.where(doc_id.notna(), 0).astype("int64")
        home = np.where(known, np.searchsorted(lows, -ids.to_numpy(), "left"), -1 - spare.to_numpy() % n)
        return pd.Series([[at, heads[i]] if ok and i in heads else [at] for ok, i, at in zip(known, ids, home.tolist())])

    # a row without an id has any place: its text's hash spreads such rows
    spare = F.crc32(F.col("text").cast("binary"))
    return d.select("doc_id", "text", F.posexplode(ranges("doc_id", spare)).alias("copy", "range"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: its fingerprint, that of its edited text, and its likeness to that and to the next document's.

    Columns: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.
    """
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the last two keys give documents of equal id one order, the copies as well
    dealt = _dealt(docs, id_col, text_col).repartition(n, "range").sortWithinPartitions(
        "range", "copy", F.col("doc_id").desc(), "text")
    schema = (f"{id_col} bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
              "edited_fingerprint string, near_edited double, near_next double")

    def row(doc_id: int | None, text: str, own: str, following: str, after: str) -> tuple:
        new = edited(text, following).encode()
        mark = fingerprint(new)
        return (doc_id, len(text), hashlib.sha256(new).hexdigest(), own, mark, likeness(own, mark), likeness(own, after))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, at = None, None  # the document whose successor is still to come
        nothing = fingerprint(b"")
        for batch in batches:
            out = []
            for doc_id, text, copy, where in zip(*(c.to_pylist() for c in batch.columns)):
                if where < 0:
                    out.append(row(doc_id, text, fingerprint(text.encode()), "", nothing))
                    continue
                if copy and waiting is None:
                    continue  # a further row of the id that the next range starts with
                own = fingerprint(text.encode())
                if waiting is not None:
                    out.append(row(*waiting, text, own))
                waiting, at = (None, None) if copy else ((doc_id, text, own), where)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 7, (
                    pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()))],
                names=[id_col, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
        if waiting is not None:
            raise RuntimeError(f"range {at} lacks its closing row")

    return dealt.select("doc_id", "text", "copy", "range").mapInArrow(run, schema)
