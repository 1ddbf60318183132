"""Removal of repeated passages by merging Burrows-Wheeler transforms.

A byte is removed if it lies in a string of ``LENGTH`` bytes that also starts in a document with a
smaller id. The strings are judged on the input; the kept bytes are joined.

How suffixes of all documents are compared without sorting them all, in five steps over tables in
the shared folder:

1. Documents are put into packs of about ``PACK_BYTES`` (one row each, compressed), written once.
2. Every window of LENGTH bytes is given an anchor: the smallest hash among its GRAM-byte substrings.
   Equal windows have equal anchors. Each pack sends its different anchors with their number of
   documents, and each anchor found in a single document is struck off, with the windows that have it.
3. Consecutive windows of one anchor form a short string. Each pack sends its different strings, with
   the smallest document id that has them, to the bucket of their anchor. All occurrences of a
   window are then in one bucket. An anchor in more than ``HOT`` documents (the edge of a very common passage has as
   many different strings as documents) is dealt window by window instead, keyed by the window, so no
   bucket grows with the size of a group.
4. In a bucket the strings are cut into shards. Each shard's suffixes are sorted once and give its
   transform. The transforms are merged by interleave refinement: starting from the shards one after another,
   each round reads the transform's symbol at every place of the interleave and moves the places to the
   symbol's section, stably, which sorts the suffixes of all shards by one more symbol. Boundaries appear
   between prefixes that differ, so the round in which a place is first alone tells its longest common prefix;
   the places between two boundaries after round LENGTH are a repeated interval, and the smallest document
   id in it belongs to all its windows. Places that are alone between boundaries, or whose prefix has run into
   the start of their string, can be in no repeated interval and leave the interleave.
5. The answers go back to the packs, which take out what is covered.

What moves per pack is bounded by the pack. Nothing is sampled, and there is no limit on the number of
repeats of a string.

Defined results: a null text has no bytes. A document with a null id has no place in the order: it loses nothing
and takes nothing from others. Rows of equal id do not take from each other. Texts shorter than LENGTH lose
nothing. An empty table gives an empty result. Other columns may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import stored

LENGTH, GRAM = 50, 24
PACK_BYTES, BUCKET_ANCHORS, BUCKET_BYTES, SHARD_BYTES = 2 << 20, 2 << 20, 8 << 20, 64 << 10
SECTIONS = 32  # of a bucket, merged one after another: their arrays stay in the processor's cache
HOT = 2000
KEY_SYMBOLS = 8  # symbols in one sort key
DROP_EVERY = 2  # rounds after which places that are alone leave the interleave
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xBF58476D1CE4E5B9)]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x *= _ODD[2]
    x ^= x >> np.uint64(29)
    return x


def _part(key: np.ndarray, parts: int) -> np.ndarray:
    """Which of ``parts`` even sections of the key space each key is in; keeps the order of keys."""
    return ((key >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int32)


def _squeeze(*arrays: np.ndarray | bytes, level: int = 1) -> bytes:
    body = [a if isinstance(a, bytes) else np.ascontiguousarray(a).tobytes() for a in arrays]
    head = np.array([len(body), *map(len, body)], np.int64).tobytes()
    return zstandard.ZstdCompressor(level=level).compress(head + b"".join(body))


def _spread(blob: bytes, *types: str) -> list:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    size = np.frombuffer(raw, np.int64, n, 8)
    at = np.concatenate([[0], np.cumsum(size)]) + 8 * (n + 1)
    return [raw[a:b] if t == "bytes" else np.frombuffer(raw[a:b], t) for a, b, t in zip(at[:-1], at[1:], types)]


# ---- step 1: packs -----------------------------------------------------------------------------


def _packs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(pack, n_bytes, body): rows of ``docs`` with their texts, as one compressed record batch a pack."""
    at = docs.columns.index(text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        waiting: list[pa.RecordBatch] = []
        held = 0

        def out() -> pa.RecordBatch:
            table = pa.Table.from_batches(waiting).combine_chunks()
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema) as writer:
                writer.write_table(table)
            body = zstandard.ZstdCompressor(level=1).compress(sink.getvalue().to_pybytes())
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([held], pa.int64()), pa.array([body], pa.binary())],
                ["pack", "n_bytes", "body"])

        for batch in batches:
            size = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            first, total = 0, np.cumsum(size)
            while first < batch.num_rows:
                room = PACK_BYTES - held + (total[first - 1] if first else 0)
                to = min(batch.num_rows, int(np.searchsorted(total, room, "left")) + 1)
                waiting.append(batch.slice(first, to - first))
                held += int(total[to - 1] - (total[first - 1] if first else 0))
                first = to
                if held >= PACK_BYTES:
                    yield out()
                    number, held, waiting = number + 1, 0, []
        if waiting:
            yield out()

    return docs.mapInArrow(run, "pack bigint, n_bytes bigint, body binary")


class _Pack:
    """The documents of one pack, their bytes in one array."""

    def __init__(self, body: bytes, id_col: str, text_col: str) -> None:
        raw = zstandard.ZstdDecompressor().decompress(body, max_output_size=0)
        self.table = pa.ipc.open_stream(raw).read_all()
        text = self.table.column(text_col).cast(pa.large_binary())
        self.texts = [x or b"" for x in text.to_pylist()]
        size = np.array([len(t) for t in self.texts], np.int64)
        self.start = np.concatenate([[0], np.cumsum(size)])
        self.bytes = b"".join(self.texts)
        ids = self.table.column(id_col).to_pylist()
        self.known = np.array([x is not None for x in ids], bool)
        self.ids = np.array([x or 0 for x in ids], np.int64)

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Runs of consecutive windows with one anchor: (anchor, first window, number of windows, document)."""
        none = np.zeros(0, np.int64)
        n = len(self.bytes)
        if n < LENGTH:
            return none.astype(np.uint64), none, none, none
        a = np.frombuffer(self.bytes, np.uint8)
        eight = np.lib.stride_tricks.as_strided(a, (n - 7, 8), (1, 1)).copy().view("<u8").ravel()
        h = np.zeros(n - GRAM + 1, np.uint64)
        for at, odd in zip(range(0, GRAM, 8), _ODD):
            h += eight[at:at + len(h)] * odd
        del eight
        h = _mixed(h)
        span, size = LENGTH - GRAM + 1, 1
        while size * 2 <= span:
            h = np.minimum(h[:-size], h[size:])
            size *= 2
        if size < span:
            h = np.minimum(h[:len(h) - (span - size)], h[span - size:])
        # windows inside one document whose id is known
        inside = np.zeros(len(h) + 1, np.int8)
        first, last = self.start[:-1], self.start[1:] - LENGTH + 1
        whole = self.known & (last > first)
        np.add.at(inside, first[whole], 1)
        np.add.at(inside, last[whole], -1)
        inside = np.cumsum(inside[:-1], dtype=np.int8) > 0
        new = np.empty(len(h), bool)
        new[0] = True
        np.not_equal(h[1:], h[:-1], out=new[1:])
        new[first[whole]] = True
        new[1:] |= inside[1:] != inside[:-1]
        at = np.flatnonzero(new)
        count = np.diff(np.append(at, len(h)))
        keep = inside[at]
        at, count = at[keep], count[keep]
        # the same text repeated within itself can keep one anchor for long: such runs are cut
        most = 2 * span
        parts = -(-count // most)
        if len(parts) and parts.max() > 1:
            nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
            count = np.minimum(most, np.repeat(count, parts) - nth * most)
            at = np.repeat(at, parts) + nth * most
        doc = np.searchsorted(self.start, at, "right") - 1
        # the lowest bit is left free for a mark
        return _mixed(h[at] * _ODD[3]) & ~np.uint64(1), at, count, doc


# ---- step 2: anchors in more than one document --------------------------------------------------


def _anchors(packs: DataFrame, id_col: str, text_col: str, parts: int) -> DataFrame:
    """(part, pack, blob): the pack's different anchors in that part, with their numbers of documents."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                anchor, _, _, doc = _Pack(body.as_py(), id_col, text_col).runs()
                order = np.lexsort((doc, anchor))
                anchor, doc = anchor[order], doc[order]
                once = np.ones(len(anchor), bool)
                once[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
                anchor, count = np.unique(anchor[once], return_counts=True)
                part = _part(anchor, parts)
                edge = np.flatnonzero(np.diff(part, prepend=-1))
                cut = np.append(edge, len(part))
                blob = [anchor[a:b].tobytes() + count[a:b].astype(np.uint32).tobytes() for a, b in zip(cut[:-1], cut[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part[edge], pa.int32()), pa.array([number] * len(edge), pa.int64()),
                     pa.array(blob, pa.binary())], ["part", "pack", "blob"])

    return packs.select("pack", "body").mapInArrow(run, "part int, pack bigint, blob binary")


def _by_part(rows: DataFrame, work: Callable[[int, list[int], list[bytes]], Iterator[tuple]], types: list, schema: str) -> DataFrame:
    """Apply ``work(part, packs, blobs)`` to each part of (part, pack, blob); it yields rows of ``schema``."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, packs, blobs = None, [], []

        def out() -> pa.RecordBatch:
            cols = list(zip(*work(part, packs, blobs))) or [[]] * len(types)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

        for batch in batches:
            for p, k, b in zip(*(c.to_pylist() for c in batch.columns)):
                if part is not None and p != part:
                    yield out()
                    packs, blobs = [], []
                part = p
                packs.append(k)
                blobs.append(b)
        if packs:
            yield out()

    return rows.repartitionById(n, "part").sortWithinPartitions("part").mapInArrow(run, schema)


def _shared(hot: int, part: int, packs: list[int], blobs: list[bytes]) -> Iterator[tuple]:
    """(pack, n, blob): of each pack the anchors found in another document, the lowest bit telling hot ones."""
    anchors = [np.frombuffer(b, np.uint64, len(b) // 12) for b in blobs]
    counts = np.concatenate([np.frombuffer(b, np.uint32, len(b) // 12, len(b) // 12 * 8) for b in blobs]).astype(np.int64)
    size = [len(a) for a in anchors]
    every = np.concatenate(anchors)
    order = np.argsort(every)
    first = np.flatnonzero(np.diff(every[order], prepend=~every[order[:1]]))
    total = np.repeat(np.add.reduceat(counts[order], first), np.diff(np.append(first, len(order))))
    docs = np.empty(len(every), np.int64)
    docs[order] = total
    marked = every | (docs > hot).astype(np.uint64)
    edge = np.concatenate([[0], np.cumsum(size)])
    for pack, a, b in zip(packs, edge[:-1], edge[1:]):
        found = marked[a:b][docs[a:b] > 1]
        if len(found):
            yield pack, len(found), found.tobytes()


# ---- step 3: strings of shared anchors ----------------------------------------------------------


def _strings(packs: DataFrame, shared: DataFrame, id_col: str, text_col: str, parts: int) -> DataFrame:
    """(part, pack, blob): the pack's different strings in that part; part -1 holds its runs."""
    lists = shared.groupBy("pack").agg(F.collect_list("blob").alias("blobs"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, body, blobs in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                out = list(one(_Pack(body.as_py(), id_col, text_col), b"".join(blobs.as_py())))
                cols = list(zip(*out)) or [[], []]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.int32()), pa.array([number] * len(out), pa.int64()),
                     pa.array(cols[1], pa.binary())], ["part", "pack", "blob"])

    def one(pack: _Pack, marks: bytes) -> Iterator[tuple[int, bytes]]:
        mark = np.sort(np.frombuffer(marks, np.uint64))
        key, at, count, doc = pack.runs()
        where = np.minimum(np.searchsorted(mark, key), len(mark) - 1)
        keep = (mark[where] & ~np.uint64(1)) == key
        hot = (mark[where] & np.uint64(1)).astype(bool)[keep]
        key, at, count, doc = key[keep], at[keep], count[keep], doc[keep]
        if hot.any():  # window by window
            nth = np.arange(count[hot].sum()) - np.repeat(np.cumsum(count[hot]) - count[hot], count[hot])
            place = np.repeat(at[hot], count[hot]) + nth
            key = np.concatenate([key[~hot], np.array(
                [int.from_bytes(hashlib.blake2b(pack.bytes[p:p + LENGTH], digest_size=8).digest(), "little")
                 for p in place.tolist()], np.uint64)])
            doc = np.concatenate([doc[~hot], np.repeat(doc[hot], count[hot])])
            at = np.concatenate([at[~hot], place])
            count = np.concatenate([count[~hot], np.ones(len(place), np.int64)])
        order = np.argsort(key, kind="stable")
        key, at, count, doc = key[order], at[order], count[order], doc[order]
        known: dict[bytes, int] = {}
        raw = pack.bytes
        string = np.array([known.setdefault(raw[a:b], len(known)) for a, b in zip(at.tolist(), (at + count + LENGTH - 1).tolist())], np.int64)
        low = np.full(len(known), np.iinfo(np.int64).max)
        np.minimum.at(low, string, pack.ids[doc])
        order = np.argsort(at)  # the runs go back in the order of the text
        at, count, run = at[order], count[order], string[order]
        home = np.zeros(len(known), np.int64)
        home[string] = _part(key, parts * SECTIONS)  # equal strings have equal keys; strings are numbered in their order
        yield -1, _squeeze(np.diff(at, prepend=0).astype(np.int32), count.astype(np.int8), run.astype(np.int32))
        part, section = home // SECTIONS, (home % SECTIONS).astype(np.int8)
        edge = np.flatnonzero(np.diff(part, prepend=-1))
        texts = list(known)
        for a, b in zip(edge.tolist(), [*edge.tolist()[1:], len(part)]):
            size = np.array([len(t) for t in texts[a:b]], np.int32)
            yield int(part[a]), _squeeze(size, low[a:b], section[a:b], b"".join(texts[a:b]), level=3)

    return packs.select("pack", "body").join(lists, "pack").mapInArrow(run, "part int, pack bigint, blob binary")


# ---- step 4: merging the transforms of shards -----------------------------------------------------


class Shard:
    """Sorted suffixes of some strings and their transform. Symbols are byte values plus one; 0 ends a string."""

    def __init__(self, strings: list[bytes]) -> None:
        joined = np.frombuffer(b"\xff".join(strings) + b"\xff", np.uint8)  # no byte of UTF-8 is 0xff
        symbol = joined + np.uint8(1)  # 0xff becomes 0
        n = len(symbol)
        self.size = n
        left = _until_end(symbol)  # symbols from here to the end of the string, the end included
        key = np.zeros(n + KEY_SYMBOLS, np.uint64)
        padded = np.concatenate([symbol, np.zeros(KEY_SYMBOLS, np.uint8)])
        for k in range(KEY_SYMBOLS):
            key[:n] = (key[:n] << np.uint64(8)) | np.where(k < left, padded[k:k + n], 0).astype(np.uint64)
        order = np.argsort(key[:n])
        rank = _ranks(key[:n], order)
        reach = KEY_SYMBOLS
        while reach < LENGTH:
            ahead = np.zeros(n, np.int64)
            some = left > reach
            ahead[some] = rank[np.flatnonzero(some) + reach] + 1
            key = (rank.astype(np.uint64) << np.uint64(32)) | ahead.astype(np.uint64)
            order = np.argsort(key)
            rank = _ranks(key, order)
            reach *= 2
        self.suffix = order.astype(np.int32)
        place = np.empty(n, np.int32)
        place[order] = np.arange(n, dtype=np.int32)
        #: the symbol before each sorted suffix, and the place of the suffix that starts with it
        self.transform = symbol[order - 1]
        self.back = place[order - 1]


def _until_end(symbol: np.ndarray) -> np.ndarray:
    end = np.flatnonzero(symbol == 0)
    return np.repeat(end, np.diff(end, prepend=-1)) - np.arange(len(symbol)) + 1


def _ranks(key: np.ndarray, order: np.ndarray) -> np.ndarray:
    sorted_key = key[order]
    rank = np.empty(len(key), np.int64)
    rank[order] = np.cumsum(np.concatenate([[0], sorted_key[1:] != sorted_key[:-1]]))
    return rank


def repeated_intervals(shards: list[Shard], length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merge the shards' transforms.

    Returns (place, interval, common). ``place`` are the places, counted through the shards one after
    another, that lie in a repeated interval of the merged order at depth ``length``, ``interval`` the number
    of each one's interval. ``common[p]`` bounds the common prefix of place p with any other suffix: where a place
    was seen alone between boundaries after round h + 1, the prefix is at most h long.
    """
    offset = np.concatenate([[0], np.cumsum([s.size for s in shards])])
    n = int(offset[-1])
    # symbol and place before it, side by side
    kind = np.uint32 if n < 1 << 24 else np.uint64
    table = np.concatenate([(s.back + o).astype(kind) << kind(8) | s.transform for s, o in zip(shards, offset.tolist())])
    common = np.full(n, length, np.int16)
    place = np.arange(n)  # the interleave: at first the shards one after another
    border = np.zeros(n, bool)  # whether an interval starts here
    border[:1] = True
    for h in range(length):
        step = table.take(place)
        symbol = step.astype(np.uint8)
        order = symbol.argsort(kind="stable")
        # a prefix that would start before its string is of no use
        order = order[np.count_nonzero(symbol == 0):]
        key = np.cumsum(border, dtype=np.int64)
        key <<= 8
        key |= symbol
        key, step = key.take(order), step.take(order)
        step >>= kind(8)
        place = step.astype(np.int64)
        border = np.ones(len(place), bool)
        np.not_equal(key[1:], key[:-1], out=border[1:])
        if h % DROP_EVERY == DROP_EVERY - 1 or h == length - 1:
            alone = border.copy()
            alone[:-1] &= border[1:]
            gone = place[alone]
            common[gone] = np.minimum(common[gone], h)
            place, border = place[~alone], border[~alone]
    return place, np.cumsum(border) - 1, common


def _least(strings: list[bytes], low: np.ndarray) -> np.ndarray:
    """The smallest document id having each window of the strings, given that of each string."""
    size = np.array([len(s) for s in strings], np.int64)
    windows = size - LENGTH + 1
    at = np.concatenate([[0], np.cumsum(windows)])
    best = np.repeat(low, windows)
    cut = np.append(np.flatnonzero(np.diff((np.cumsum(size) - 1) // SHARD_BYTES, prepend=-1)), len(strings)).tolist()
    shards = [Shard(strings[a:b]) for a, b in zip(cut[:-1], cut[1:])]
    place, interval, _ = repeated_intervals(shards)
    if len(place):
        # the shards' strings, ends included, lie one after another as their places do
        begin = np.concatenate([[0], np.cumsum(size + 1)])
        position = np.concatenate([s.suffix + begin[a] for s, a in zip(shards, cut[:-1])])[place]
        owner = np.searchsorted(begin, position, "right") - 1
        window = at[owner] + position - begin[owner]
        first = np.flatnonzero(np.diff(interval, prepend=-1))
        best[window] = np.minimum.reduceat(low[owner], first)[interval]
    return best


def _merged(part: int, packs: list[int], blobs: list[bytes]) -> Iterator[tuple]:
    """(part, pack, blob): the smallest document id having each window of the pack's strings."""
    known: dict[bytes, int] = {}
    lows, own, where = [], [], []
    for blob in blobs:
        size, low, section, raw = _spread(blob, "i4", "i8", "i1", "bytes")
        end = np.cumsum(size)
        own.append(np.array([known.setdefault(raw[a:b], len(known)) for a, b in zip((end - size).tolist(), end.tolist())], np.int64))
        lows.append(low)
        where.append(section)
    index = np.concatenate(own)
    low = np.full(len(known), np.iinfo(np.int64).max)
    np.minimum.at(low, index, np.concatenate(lows))
    section = np.zeros(len(known), np.int8)
    section[index] = np.concatenate(where)
    strings = list(known)
    windows = np.array([len(s) for s in strings], np.int64) - LENGTH + 1
    at = np.concatenate([[0], np.cumsum(windows)])
    best = np.empty(at[-1], np.int64)
    order = np.argsort(section, kind="stable")
    cut = np.append(np.flatnonzero(np.diff(section[order], prepend=-1)), len(order))
    for a, b in zip(cut[:-1], cut[1:]):
        members = order[a:b]
        n = windows[members]
        nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        best[np.repeat(at[members], n) + nth] = _least([strings[i] for i in members.tolist()], low[members])
    for pack, index in zip(packs, own):
        n = windows[index]
        nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        yield part, pack, _squeeze(n.astype(np.int32), best[np.repeat(at[index], n) + nth])


# ---- step 5: taking out -----------------------------------------------------------------------------


def _removed(pack: _Pack, runs: bytes | None, answers: list[tuple[int, bytes]]) -> np.ndarray:
    """Which bytes of the pack go."""
    gone = np.zeros(len(pack.bytes) + 1, np.int32)
    if runs is not None:
        at, count, string = (x.astype(np.int64) for x in _spread(runs, "i4", "i1", "i4"))
        at = np.cumsum(at)
        doc = np.searchsorted(pack.start, at, "right") - 1
        parts = [_spread(blob, "i4", "i8") for _, blob in sorted(answers)]
        windows = np.concatenate([p[0] for p in parts]).astype(np.int64)
        best = np.concatenate([p[1] for p in parts])
        first = np.cumsum(windows) - windows
        nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        covered = best[np.repeat(first[string], count) + nth] < np.repeat(pack.ids[doc], count)
        start = (np.repeat(at, count) + nth)[covered]
        np.add.at(gone, start, 1)
        np.add.at(gone, start + LENGTH, -1)
    return np.cumsum(gone[:-1]) > 0


def _answered(docs: DataFrame, id_col: str, text_col: str, finish: Callable, schema, hot: int = HOT) -> DataFrame:
    """``finish(pack, gone)`` for every pack, a record batch of ``schema`` each."""
    spark = docs.sparkSession
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    packs = stored(_packs(docs, id_col, text_col), "packs")
    total = packs.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    density = 2 / (LENGTH - GRAM + 2)  # anchors a byte, expected
    parts = max(least, int(total * density / BUCKET_ANCHORS) + 1)
    shared = stored(_by_part(_anchors(packs, id_col, text_col, parts), partial(_shared, hot),
                             [pa.int64(), pa.int64(), pa.binary()], "pack bigint, n bigint, blob binary"), "shared")
    runs = shared.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    parts = max(least, int(runs * (LENGTH + 1 / density) / BUCKET_BYTES) + 1)
    strings = stored(_strings(packs, shared, id_col, text_col, parts), "strings")
    answers = stored(_by_part(strings.where("part >= 0"), _merged,
                              [pa.int32(), pa.int64(), pa.binary()], "part int, pack bigint, blob binary"), "answers")
    back = strings.where("part < 0").unionByName(answers).groupBy("pack").agg(
        F.collect_list(F.struct("part", "blob")).alias("parts"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body, rows in zip(batch.column(1), batch.column(2)):
                pack = _Pack(body.as_py(), id_col, text_col)
                found = [(r["part"], r["blob"]) for r in rows.as_py() or []]
                runs = next((b for p, b in found if p < 0), None)
                yield finish(pack, _removed(pack, runs, [x for x in found if x[0] >= 0]))

    return packs.select("pack", "body").join(back, "pack", "left").mapInArrow(run, schema)


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """Per document: id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256."""

    def finish(pack: _Pack, gone: np.ndarray) -> pa.RecordBatch:
        total = np.concatenate([[0], np.cumsum(gone)])
        n_removed = total[pack.start[1:]] - total[pack.start[:-1]]
        begins = gone.copy()
        begins[1:] &= ~gone[:-1]
        inner = pack.start[:-1][(pack.start[:-1] < len(gone))]
        begins[inner] = gone[inner]  # a run ends with its document
        spans = np.concatenate([[0], np.cumsum(begins)])
        n_spans = spans[pack.start[1:]] - spans[pack.start[:-1]]
        every = np.frombuffer(pack.bytes, np.uint8)
        sha = []
        for text, a, b, n in zip(pack.texts, pack.start[:-1], pack.start[1:], n_removed):
            sha.append(hashlib.sha256(every[a:b][~gone[a:b]].tobytes() if n else text).hexdigest())
        return pa.RecordBatch.from_arrays(
            [pack.table.column(0).combine_chunks().cast(pa.int64()), pa.array(np.diff(pack.start), pa.int64()),
             pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(sha, pa.string())],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    plain = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return _answered(plain, "doc_id", "text", finish,
                     "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string",
                     hot).withColumnRenamed("doc_id", id_col)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """The rows of ``docs`` with the repeated bytes taken out of their texts; all rows and columns are kept.

    Characters of which a part was removed go as a whole. A null text stays null. If ``length_col`` is
    given, it is set to the new number of code points of texts that changed.
    """
    schema: StructType = docs.schema

    def finish(pack: _Pack, gone: np.ndarray) -> pa.RecordBatch:
        every = np.frombuffer(pack.bytes, np.uint8)
        total = np.concatenate([[0], np.cumsum(gone)])
        texts, lengths = pack.table.column(text_col).to_pylist(), None
        if length_col:
            lengths = pack.table.column(length_col).to_pylist()
        for i, (a, b) in enumerate(zip(pack.start[:-1], pack.start[1:])):
            if total[b] > total[a]:
                texts[i] = every[a:b][~gone[a:b]].tobytes().decode("utf-8", "ignore")
                if lengths:
                    lengths[i] = len(texts[i])
        table = pack.table.set_column(pack.table.column_names.index(text_col), text_col, pa.array(texts, pack.table.schema.field(text_col).type))
        if lengths is not None:
            table = table.set_column(table.column_names.index(length_col), length_col,
                                     pa.array(lengths, table.schema.field(length_col).type))
        return table.combine_chunks().to_batches()[0]

    return _answered(docs, id_col, text_col, finish, schema)
