"""SimHash near-duplicates by pivot distance tables.

A fingerprint has a bit set if the bit is set in more than half of the 64-bit hashes of the text's
word shingles. Documents whose fingerprints differ in at most ``max_bits`` bits are linked, and
every document learns the smallest id it can reach.

Only different fingerprints are compared; equal ones are folded first, so a group of copies of any
size is one row. Fingerprints meet as follows: the 64 bits are cut into ``BANDS`` bands, and since
two bits can touch two bands at most, linked fingerprints agree on all bands but some two. Each
fingerprint is dealt once for every choice of two bands left out, keyed by the other bits. A meeting
place then holds at most 2**14 different fingerprints (the bits of two bands), whatever the input:
no hot bucket can form, nothing is capped and no link is missed.

Inside a meeting place the pivot distance table discards: the Hamming distances to ``PIVOTS`` fixed
reference fingerprints are computed once per fingerprint, and since a distance to a pivot changes by
at most the distance of two fingerprints, pairs whose largest coordinate difference exceeds
``max_bits`` are discarded; the survivors are verified by their own bit distance. Only a spanning
forest of the links found leaves a meeting place. The bands come first because the table is a poor place to meet:
distances to a pivot spread over few values (standard deviation 4), so cells of width 4 leave 0.42 of all pairs together
and, to lose no link over their borders, need 1.5 copies of every fingerprint a pivot. A millionth of the pairs takes 16
pivots and 660 copies; two bands left out of ten take 45 copies and leave 2^-51.

Defined results: words are runs without ASCII white space, A-Z lower-cased; fewer words than a
shingle form one shingle; no words (null, empty, blank) give fingerprint 0, linked like any other.
Repeated rows are documents of the same fingerprint. A null id keeps its row; the component is the
smallest id that is not null, or null. An empty table gives an empty result. Other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, stored

SHINGLE, SEED, MAX_BITS, BANDS, PIVOTS = 3, 42, 2, 10, 16
AT_ONCE = 1 << 20  # pairs held at a time


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of a text."""
    words = (text or "").encode().lower().split()  # both only concern ASCII in bytes
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-shingle]])
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), (ends[shingle - 1:] - 1).tolist())],
                      "<u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE,
                     key_col: str | None = None) -> DataFrame:
    """(doc_id, fp) with the fingerprint as a signed 64-bit integer, and a string column as ``key`` if one is named."""
    more = [] if key_col is None else ["key"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp, pa.int64()), *batch.columns[2:]],
                                             ["doc_id", "fp", *more])

    return docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string"), *([key_col] if more else []),
    ).mapInArrow(run, "doc_id bigint, fp bigint" + (", key string" if more else ""))


def band_masks(max_bits: int = MAX_BITS, bands: int = BANDS) -> list[int]:
    """Bit masks that keep all bands but ``max_bits`` of them, for every choice."""
    if not 0 <= max_bits < bands <= 64:
        raise ValueError("max_bits must be below the number of bands")
    edge = [64 * i // bands for i in range(bands + 1)]
    band = [((1 << edge[i + 1]) - 1) ^ ((1 << edge[i]) - 1) for i in range(bands)]
    full = (1 << 64) - 1
    return [full ^ sum(band[i] for i in out) for out in combinations(range(bands), max_bits)]


def pivots(n: int = PIVOTS) -> np.ndarray:
    """Fixed reference fingerprints."""
    return np.array([xxhash.xxh64_intdigest(b"pivot %d" % i, SEED) for i in range(n)], np.uint64)


def distance_table(fps: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Hamming distances of every fingerprint to every reference fingerprint."""
    return np.bitwise_count(fps[:, None] ^ reference[None, :]).astype(np.int8)


def _near(fps: np.ndarray, i: np.ndarray, j: np.ndarray, table: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (i, j) that pass the table, then the bit distance."""
    for c in range(table.shape[1]):
        keep = np.abs(table[i, c] - table[j, c]) <= max_bits
        i, j = i[keep], j[keep]
    keep = np.bitwise_count(fps[i] ^ fps[j]) <= max_bits
    return i[keep], j[keep]


def forest(n: int, links: Iterable[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """For each of n members the smallest member joined to it by the links."""
    low = np.arange(n)
    for i, j in links:
        while True:
            a, b = low[i], low[j]
            if (a == b).all():
                break
            top, bottom = np.maximum(a, b), np.minimum(a, b)
            np.minimum.at(low, top, bottom)
            low = np.minimum(low, low[low])
            while (low != low[low]).any():
                low = low[low]
    return low


def _pairs_of(first: np.ndarray, size: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs inside groups of consecutive members, in pieces of about AT_ONCE."""
    start = np.repeat(first, size)
    left = start + np.arange(len(start)) - np.repeat(np.cumsum(size) - size, size)
    count = start + np.repeat(size, size) - 1 - left  # members of the own group after it
    cum = np.cumsum(count)
    at = 0
    while at < len(left):
        to = max(at + 1, int(np.searchsorted(cum, (cum[at - 1] if at else 0) + AT_ONCE, "right")))
        n = count[at:to]
        i = np.repeat(left[at:to], n)
        j = i + 1 + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        yield i, j
        at = to


def linked(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b) edges whose components are those of the links between different fingerprints of column ``fp``."""
    masks = [int(np.uint64(m).view(np.int64)) for m in band_masks(max_bits)]
    reference = pivots()
    dealt = fps.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("k", "key"))
    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None  # rows of the meeting place that the next batch may go on with
        for batch in batches:
            k, key, fp = (batch.column(c).to_numpy(zero_copy_only=False) for c in range(3))
            if rest is not None:
                k, key, fp = (np.concatenate([x, y]) for x, y in zip(rest, (k, key, fp)))
            new = np.flatnonzero((k[1:] != k[:-1]) | (key[1:] != key[:-1])) + 1
            cut = int(new[-1]) if len(new) else 0
            rest = (k[cut:], key[cut:], fp[cut:])
            if cut:
                yield edges(np.concatenate([[0], new]), fp[:cut].view(np.uint64))
        if rest is not None:
            yield edges(np.array([0, len(rest[0])]), rest[2].view(np.uint64))

    def edges(bounds: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        size = np.diff(bounds)
        first, size = bounds[:-1][size > 1], size[size > 1]
        used = np.zeros(len(fp) + 1, np.int64)
        np.add.at(used, first, 1)
        np.add.at(used, first + size, -1)
        used = np.cumsum(used[:-1]) > 0
        fp, first = fp[used], np.concatenate([[0], np.cumsum(size)[:-1]]) if len(size) else first
        table = distance_table(fp, reference)
        low = forest(len(fp), (_near(fp, i, j, table, max_bits) for i, j in _pairs_of(first, size)))
        moved = np.flatnonzero(low != np.arange(len(fp)))
        a, b = fp[low[moved]].view(np.int64), fp[moved].view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return dealt.select("k", "key", "fp").repartition(n, "k", "key").sortWithinPartitions("k", "key").mapInArrow(
        run, "a bigint, b bigint")


def _groups(marked: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, component, component_id) of the fingerprints of ``marked`` (doc_id, fp); component is a fingerprint of the group."""
    classes = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("low")), "fp-classes")
    joined = components(linked(classes.select("fp"), max_bits), "fp-components")
    named = classes.join(joined, classes.fp == joined.id, "left").select(
        "fp", "low", F.coalesce("component", "fp").alias("component"))
    smallest = named.groupBy("component").agg(F.min("low").alias("component_id"))
    return stored(named.join(smallest, "component").select("fp", "component", "component_id"), "fp-labels")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """Per document: id, fingerprint (16 hex digits), component_id."""
    marked = stored(with_fingerprint(docs, id_col, text_col, shingle), "fingerprints")
    return marked.join(_groups(marked, max_bits), "fp").select(
        F.col("doc_id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component, that of the smallest id and then the smallest text; all columns are kept.

    A row without an id stays only where no row of its component has one. Rows that share an id but not
    a component are different documents. Texts are compared only where rows of one component share its id.
    """
    text = F.col(text_col).cast("string")
    key = F.concat(F.coalesce(F.col(id_col).cast("bigint").cast("string"), F.lit("")), F.lit(":"),
                   F.coalesce(F.md5(text.cast("binary")), F.lit("")))  # of the id and text of a row
    keyed = docs.withColumn("__key", key)
    marked = stored(with_fingerprint(keyed, id_col, text_col, key_col="__key"), "keyed-fingerprints")
    first = marked.join(_groups(marked), "fp").where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(
        "component", F.col("key").alias("__key")).distinct()
    first = stored(first, "first-rows")
    counted = stored(first.groupBy("component").agg(F.min("__key").alias("__key"), F.count("*").alias("n")), "first-keys")
    keep, tied = counted.where("n = 1").select("__key"), counted.where("n > 1").select("component")
    if not tied.isEmpty():
        texts = keyed.select("__key", text.alias("text")).join(first.join(tied, "component"), "__key")
        smallest = texts.groupBy("component").agg(F.min(F.struct("text", "__key")).alias("low"))
        keep = keep.unionByName(smallest.select("low.__key"))
    return keyed.dropDuplicates(["__key"]).join(keep, "__key").select(docs.columns)
