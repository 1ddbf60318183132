"""Phrase collocations by Rabin-Karp fingerprints.

A text is cut at ``.,;:!?`` and line ends into pieces and these at blanks into words, A-Z in lower case. Phrases are
contiguous words of a piece; everything is counted for each language apart. A phrase of two or more words that occurs
``least`` times is a candidate. Its score compares it with its two parts at the worst cut.

How phrases are counted without moving their texts, in four steps over tables in the shared folder:

1. Texts are put into blocks of about ``BLOCK_BYTES``, one compressed row each. A longer text is cut between pieces, or where
   none ends between words, with the next words repeated behind the cut.
2. Prefix polynomials modulo 2^64 over the bytes give every word a fingerprint, prefix polynomials over the words every phrase.
   Each block sends its different fingerprints with their counts, sorted and compressed, to the parts of the
   fingerprint space. The place in that sorted list, with the block, is the pointer to the occurrences.
3. A part adds the counts up and answers each block with a bit for every pointer: frequent or not. Two phrases of one
   fingerprint only make the sum too large, so nothing frequent is missed.
4. Blocks compute their lists again and write out the texts of the frequent pointers only. In a block all occurrences of
   a fingerprint are held against the text of the first, and those that differ are counted by themselves. Counts are
   then added by text, so that collisions between blocks fall apart too, and the sums are exact.

A phrase of any frequency has one entry a block. What is frequent, and the candidates' parts, are joined by Spark; a word that is
part of a third of all candidates meets one row on the other side, and adaptive execution splits its rows.

Rows sent in step 2 are blocks x parts, each with the entries of a block that fall in a part: about 170 at 30 GB, 5 at
1 TB. There ``block_bytes`` and ``part_entries`` should be raised with the memory of a task (64 MB and 32 million entries
give 1,200 at 1 TB and 12 at 100 TB).

Defined results: a null text is empty, a null language is ``und``. Texts without words count nothing. A word longer than a block
is held whole in memory. Repeated rows count each. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored

WORDS = 3  # in a phrase, at most
LEAST, BEST, INSIDE = 10, 2000, 50
BLOCK_BYTES, PART_ENTRIES = 4 << 20, 4 << 20
BATCH_BYTES = 8 << 20  # sent to a Python worker at a time; outside the heap, and held on both sides
SEGMENT = 1 << 18  # places whose powers are kept
CHUNK = 1 << 16  # phrases in a batch
_WORD, _BLANK, _BREAK = range(3)
_CLASS = np.zeros(256, np.uint8)
_CLASS[[0x20, 0x09]] = _BLANK
_CLASS[[*b".,;:!?", *range(0x0A, 0x0E)]] = _BREAK
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_GAP = re.compile(rb"[\x20\x09.,;:!?\x0a-\x0d]")
_BASES = {"byte": 0x9E3779B97F4A7C15, "word": 0xD6E8FEB86659FD93}
_SPREAD, _ONES = 0xBF58476D1CE4E5B9, (1 << 64) - 1
_ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def _seed(name: str) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.blake2b(name.encode(), digest_size=8).digest(), "little"))


_SYMBOL = np.array([_seed(f"byte {b}") for b in range(256)], np.uint64)
_LENGTH = [_seed(f"length {n}") for n in range(16)]


class _Polynomial:
    """Fingerprints of ranges of a sequence from its prefix polynomials, sum of value[i] * base^i modulo 2^64."""

    def __init__(self, base: int) -> None:
        def powers(b: int) -> np.ndarray:
            steps = np.full(SEGMENT, b, np.uint64)
            steps[0] = 1
            return np.cumprod(steps, dtype=np.uint64)

        self.base, self.back = base, pow(base, -1, 1 << 64)
        self.up, self.down = powers(self.base), powers(self.back)

    def of(self, values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Fingerprint of values[first:last] for each pair; ``values`` are bytes (replaced by symbols) or numbers."""
        total = np.zeros(1, np.uint64)
        at_first, at_last = np.empty(len(first), np.uint64), np.empty(len(last), np.uint64)
        for at in range(0, max(len(values), 1), SEGMENT):
            part = values[at:at + SEGMENT]
            part = _SYMBOL[part] if part.dtype == np.uint8 else part
            scale = np.array([pow(self.base, at, 1 << 64)], np.uint64)
            prefix = np.concatenate([total, np.cumsum(part * self.up[:len(part)], dtype=np.uint64) * scale + total])
            for place, out in ((first, at_first), (last, at_last)):
                a, b = np.searchsorted(place, np.array([at, at + len(part) + 1], place.dtype))  # both bounds of the segment are in it
                out[a:b] = prefix[place[a:b] - at]
            total = prefix[-1:]
        scales = np.array([pow(self.back, at, 1 << 64) for at in range(0, len(values) + SEGMENT, SEGMENT)], np.uint64)
        for at in range(0, len(first), SEGMENT):
            some = slice(at, at + SEGMENT)
            at_last[some] -= at_first[some]
            at_last[some] *= self.down[first[some] % SEGMENT] * scales[first[some] // SEGMENT]
        return at_last


@cache
def _polynomial(name: str) -> _Polynomial:
    """Made once in a worker."""
    return _Polynomial(_BASES[name])


def _mixed(x: np.ndarray, bits: int) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xC2B2AE3D27D4EB4F)
    x ^= x >> np.uint64(32)
    x &= np.uint64(_ONES >> (64 - bits))
    return x


def _begins(ordered: np.ndarray) -> np.ndarray:
    """For each element, whether it is the first of its value."""
    out = np.ones(len(ordered), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=out[1:])
    return out


class Block:
    """The words and phrases of some texts. ``runs`` are (end, end of what counts, language) of stretches of the bytes.

    A task holds one block, in few arrays of a number for each phrase: places are kept in 32 bits, as the bytes are one value
    of a row, under 2 GB, and what needs more arrays works on some elements at a time.
    """

    def __init__(self, body: bytes, runs: np.ndarray, langs: list[str], words: int = WORDS, bits: int = 64) -> None:
        self.data = data = _LOWER[np.frombuffer(body, np.uint8)]
        self.langs, self.length, self.bits = langs, words, bits
        ends, counted, lang = runs.reshape(3, -1)
        begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        kind = _CLASS[data]
        in_word = kind == _WORD
        before = np.concatenate([[False], in_word[:-1]])
        before[begins[begins < len(data)]] = False
        self.first = np.flatnonzero(in_word & ~before).astype(np.int32)
        del before
        after = np.concatenate([in_word[1:], [False]])
        after[ends - 1] = False
        self.last = np.flatnonzero(in_word & ~after).astype(np.int32) + np.int32(1)
        del after, in_word
        run = np.searchsorted(ends, self.first, "right").astype(np.int32)
        self.counts, self.lang = self.first < counted[run], lang.astype(np.int32)[run]
        # words of one piece have the same number of breaks and of runs before them
        self.piece = np.searchsorted(np.flatnonzero(kind == _BREAK).astype(np.int32), self.first).astype(np.int32) + run

    def words_of_lang(self) -> list[int]:
        return np.bincount(self.lang[self.counts], minlength=len(self.langs)).tolist()

    def phrases(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(fingerprint, first word, number of words) of every phrase that counts."""
        m = len(self.first)
        self.symbol = symbol = _mixed(_polynomial("byte").of(self.data, self.first, self.last), self.bits)
        seeds = np.array([_seed(x) for x in self.langs], np.uint64)
        sizes = range(1, min(self.length, m) + 1)
        places = [np.flatnonzero(self.counts[:m - n + 1] & (self.piece[:m - n + 1] == self.piece[n - 1:])).astype(np.int32) for n in sizes]
        key, done = np.empty(sum(map(len, places)), np.uint64), 0
        for n, at in zip(sizes, places):
            value = _polynomial("word").of(symbol, at, at + np.int32(n))
            value ^= seeds[self.lang[at]]
            value *= np.uint64(_SPREAD)
            value += _LENGTH[n]
            key[done:done + len(at)] = _mixed(value, self.bits)
            done += len(at)
        return key, np.concatenate([np.zeros(0, np.int32), *places]), np.repeat(np.array(sizes, np.int8), [len(x) for x in places])

    def entries(self) -> tuple[np.ndarray, np.ndarray]:
        """(different fingerprints in order, their counts)."""
        key = self.phrases()[0]
        key.sort()
        begins = _begins(key)
        start = np.flatnonzero(begins).astype(np.int32)
        count = np.diff(start, append=np.int32(len(key)))
        del start
        return key[begins], count

    def word_ids(self) -> tuple[np.ndarray, list[str]]:
        """(number of each word's text, the texts). Words of one fingerprint are held against the text of the first."""
        _, some, number = np.unique(self.symbol, return_index=True, return_inverse=True)
        some, number = some.astype(np.int32), number.astype(np.int32)
        size, like = self.last - self.first, some[number]
        same = size == size[like]
        for at in range(0, len(size), CHUNK):  # the bytes of some words at a time
            words = slice(at, at + CHUNK)
            n, edge = size[words], np.cumsum(size[words], dtype=np.int64)
            place = np.arange(edge[-1]) + np.repeat(self.first[words] - edge + n, n)
            other = np.minimum(place + np.repeat((self.first[like] - self.first)[words], n), len(self.data) - 1)
            differ = np.concatenate([[0], np.cumsum(self.data[place] != self.data[other])])
            same[words] &= differ[edge] == differ[edge - n]
        raw = self.data.tobytes()
        texts = [raw[a:b].decode() for a, b in zip(self.first[some].tolist(), self.last[some].tolist())]
        known: dict[str, int] = {}
        for w in np.flatnonzero(~same).tolist():  # collisions
            text = raw[self.first[w]:self.last[w]].decode()
            if text not in known:
                known[text] = len(texts)
                texts.append(text)
            number[w] = known[text]
        return number, texts

    def frequent(self, marked: np.ndarray | Callable[[np.ndarray], np.ndarray]) -> Iterator[tuple[np.ndarray, list[str], np.ndarray, np.ndarray]]:
        """(language, phrase, number of words, count) of the entries that are marked, ``CHUNK`` at a time. ``marked`` may be
        a function that gets the entries' fingerprints."""
        key, at, n = self.phrases()
        order = np.argsort(key, kind="stable").astype(np.int32)
        key = key[order]
        begins = _begins(key)
        if callable(marked):
            key = key[begins]
            marked = marked(key)
        del key
        entry = np.cumsum(begins, dtype=np.int32)
        entry -= 1
        keep = marked[entry]
        order, entry = order[keep], entry[keep]
        at, n = at[order], n[order]
        del order, keep, begins
        number, texts = self.word_ids()
        number = np.concatenate([number, np.zeros(self.length, number.dtype)])
        start = np.flatnonzero(_begins(entry)).astype(np.int32)
        count = np.diff(start, append=np.int32(len(entry)))
        del entry
        like, same = np.repeat(start, count), np.empty(len(at), bool)
        for a in range(0, len(at), SEGMENT):
            some = slice(a, a + SEGMENT)
            here, size, there = at[some], n[some], at[like[some]]
            same[some] = (size == n[like[some]]) & (self.lang[here] == self.lang[there])
            for k in range(self.length):
                same[some] &= (k >= size) | (number[here + k] == number[there + k])
        odd = np.flatnonzero(~same)  # collisions: counted by their own text
        np.subtract.at(count, np.searchsorted(start, odd, "right") - 1, 1)
        del like, same
        for a in range(0, len(start), CHUNK):
            some = start[a:a + CHUNK]
            ids, size = [number[at[some] + k].tolist() for k in range(self.length)], n[some]
            phrases = [texts[ids[0][j]] if s == 1 else " ".join([texts[x[j]] for x in ids[:s]]) for j, s in enumerate(size.tolist())]
            yield self.lang[at[some]], phrases, size, count[a:a + CHUNK]
        if len(odd):
            more = Counter((int(self.lang[at[i]]), " ".join([texts[x] for x in number[at[i]:at[i] + n[i]].tolist()]), int(n[i])) for i in odd.tolist())
            lang, phrases, size = zip(*more)
            yield np.array(lang), list(phrases), np.array(size), np.array(list(more.values()))


# ---- step 1: blocks -----------------------------------------------------------------------------


def _cuts(text: bytes, size: int, words: int) -> Iterator[tuple[int, int, int]]:
    """(begin, end of what counts, end) of stretches of a text; the last words behind a cut inside a piece are repeated."""
    more = re.compile(rb"(?:[\x20\x09]*[^\x20\x09.,;:!?\x0a-\x0d]+){0,%d}" % (words - 1))
    kinds, at = _CLASS[np.frombuffer(text, np.uint8)], 0
    while at < len(text):
        stop = len(text)
        if at + size < stop:
            window = kinds[at:at + size]
            breaks = np.flatnonzero(window == _BREAK)
            gaps = breaks if len(breaks) else np.flatnonzero(window == _BLANK)
            if len(gaps):
                stop = at + int(gaps[-1]) + 1
            elif m := _GAP.search(text, at + size):
                stop = m.end()
        end = stop if stop == len(text) or kinds[stop - 1] == _BREAK else more.match(text, stop).end()
        yield at, stop, end
        at = stop


def _block_rows(batches: Iterable[pa.RecordBatch], size: int, words: int) -> Iterator[pa.RecordBatch]:
    number, task = 0, TaskContext.get().partitionId()
    parts: list[bytes] = []
    runs: list[tuple[int, int, int]] = []
    langs: dict[str, int] = {}
    filled = 0

    def packed() -> pa.RecordBatch:
        nonlocal number, filled
        body, table, names = b"".join(parts), np.array(runs, np.int64).T.copy(), list(langs)
        n_words = Block(body, table, names, words).words_of_lang()
        row = pa.RecordBatch.from_arrays(
            [pa.array([(task << 33) + number], pa.int64()), pa.array([names], pa.list_(pa.string())),
             pa.array([n_words], pa.list_(pa.int64())), pa.array([table.tobytes()], pa.binary()),
             pa.array([zstandard.compress(body, 1)], pa.binary())], ["block", "langs", "n_words", "runs", "body"])
        number, filled = number + 1, 0
        parts.clear(), runs.clear(), langs.clear()
        return row

    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1)):
            if not (text := (text.as_py() or "").encode()):
                continue
            for a, counted, end in ([(0, len(text), len(text))] if len(text) <= size else _cuts(text, size, words)):
                parts.append(text[a:end])
                code = langs.setdefault(lang.as_py(), len(langs))
                runs.append((filled + end - a, filled + counted - a, code))
                filled += end - a
                if filled >= size:
                    yield packed()
    if parts:
        yield packed()


def _block(langs, runs, body, words: int, bits: int) -> Block:
    return Block(zstandard.decompress(body), np.frombuffer(runs, np.int64), langs, words, bits)


# ---- steps 2 and 3: fingerprints to parts, bits back -------------------------------------------


def _squeeze(key: np.ndarray, count: np.ndarray) -> bytes:
    """Sorted fingerprints and counts; the bytes of the differences are laid out by weight, which compresses."""
    steps = np.diff(key, prepend=np.uint64(0))
    return zstandard.compress(np.concatenate([x.view(np.uint8).reshape(-1, 8).T.ravel() for x in (steps, count.astype(np.uint64))]).tobytes(), 1)


def _unsqueeze(blob: bytes | pa.Buffer) -> tuple[np.ndarray, np.ndarray]:
    steps, count = (np.ascontiguousarray(x.T).view(np.uint64).ravel()
                    for x in np.frombuffer(zstandard.decompress(blob), np.uint8).reshape(2, 8, -1))
    return np.cumsum(steps, dtype=np.uint64), count.astype(np.int64)


def _edges(parts: int) -> np.ndarray:
    """The first fingerprint of each part."""
    return np.array([-(-(p << 64) // parts) for p in range(parts)], np.uint64)


def _answers(blobs: list[bytes | pa.Buffer], least: int) -> list[bytes | None]:
    """For each block's entries of a part a bit: frequent in all blocks together."""
    edge = np.cumsum([0] + [zstandard.frame_content_size(b) // 16 for b in blobs])
    key, count = np.empty(edge[-1], np.uint64), np.empty(edge[-1], np.int32)
    for blob, a, b in zip(blobs, edge[:-1], edge[1:]):
        key[a:b], count[a:b] = _unsqueeze(blob)  # a block's counts are below 2^31, like its bytes
    order = np.argsort(key, kind="stable").astype(np.int32 if len(key) < 1 << 31 else np.int64)
    key = key[order]
    begins = _begins(key)
    del key
    enough = np.add.reduceat(count[order], np.flatnonzero(begins), dtype=np.int64) >= least
    del count
    entry = np.cumsum(begins, dtype=order.dtype)
    entry -= 1
    often = np.empty(len(order), bool)
    often[order] = enough[entry]
    return [np.packbits(often[a:b]).tobytes() if often[a:b].any() else None for a, b in zip(edge[:-1], edge[1:])]


def _marked(blocks: DataFrame, words: int, least: int, parts: int, bits: int) -> DataFrame:
    """(block, marks: array of (part, bits)): which of a block's entries are frequent."""
    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = _edges(parts)
        for batch in batches:
            for block, langs, runs, body in zip(*(batch.column(i).to_pylist() for i in range(3)), batch.column(3)):
                key, count = _block(langs, runs, body.as_py(), words, bits).entries()
                at = np.append(np.searchsorted(key, edges), len(key))
                some = np.flatnonzero(np.diff(at))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some, pa.int32()), pa.array(np.full(len(some), block), pa.int64()),
                     pa.array([_squeeze(key[at[p]:at[p + 1]], count[at[p]:at[p + 1]]) for p in some], pa.binary())],
                    ["part", "block", "blob"])

    def answer(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, names, blobs = None, [], []

        def packed() -> pa.RecordBatch:
            said = [(part, b, x) for b, x in zip(names, _answers(blobs, least)) if x is not None]
            cols = list(zip(*said)) or [[]] * 3
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int64(), pa.binary()))], ["part", "block", "bits"])

        for batch in batches:
            for p, block, blob in zip(*(c.to_pylist() for c in batch.columns[:2]), batch.column(2)):
                if p != part:
                    if blobs:
                        yield packed()
                    part, names, blobs = p, [], []
                names.append(block)
                blobs.append(blob.as_buffer())
        if blobs:
            yield packed()

    sent = blocks.select("block", "langs", "runs", "body").mapInArrow(send, "part int, block bigint, blob binary")
    told = sent.repartition("part").sortWithinPartitions("part", "block").mapInArrow(answer, "part int, block bigint, bits binary")
    return stored(told, "marks").groupBy("block").agg(F.collect_list(F.struct("part", "bits")).alias("marks"))


# ---- step 4: texts of what is frequent ---------------------------------------------------------------


def _written(blocks: DataFrame, marks: DataFrame, words: int, parts: int, bits: int) -> DataFrame:
    """(lang, phrase, words, n): the frequent phrases of each block."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = _edges(parts)
        for batch in batches:
            for langs, runs, body, marks in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3)):
                def marked(key: np.ndarray) -> np.ndarray:
                    at = np.append(np.searchsorted(key, edges), len(key))
                    out = np.zeros(len(key), bool)
                    for mark in marks.as_py():
                        a, b = at[mark["part"]], at[mark["part"] + 1]
                        out[a:b] = np.unpackbits(np.frombuffer(mark["bits"], np.uint8), count=b - a).astype(bool)
                    return out

                for lang, phrases, size, count in _block(langs, runs, body.as_py(), words, bits).frequent(marked):
                    names = pa.DictionaryArray.from_arrays(pa.array(lang, pa.int32()), pa.array(langs, pa.string())).cast(pa.string())
                    yield pa.RecordBatch.from_arrays(
                        [names, pa.array(phrases, pa.string()), pa.array(size, pa.int32()), pa.array(count, pa.int64())],
                        ["lang", "phrase", "words", "n"])

    return blocks.join(marks, "block").select("langs", "runs", "body", "marks").mapInArrow(
        run, "lang string, phrase string, words int, n bigint")


@contextmanager
def _small_batches(spark: SparkSession):
    """Inside, jobs send at most about ``BATCH_BYTES`` to a Python worker at a time."""
    before = spark.conf.get(_ARROW_BYTES, None)
    spark.conf.set(_ARROW_BYTES, str(BATCH_BYTES))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_ARROW_BYTES)
        else:
            spark.conf.set(_ARROW_BYTES, before)


def frequent_phrases(docs: DataFrame, words: int = WORDS, least: int = LEAST, text_col: str = "text", lang_col: str = "lang",
                     block_bytes: int = BLOCK_BYTES, part_entries: int = PART_ENTRIES,
                     bits: int = 64) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, f) of all phrases of up to ``words`` words that occur ``least`` times, and (lang, n) words of
    each language. Both are tables in the shared folder. ``bits`` of a fingerprint are used: the result is the same for any number."""
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text"))
    with _small_batches(docs.sparkSession):
        blocks = stored(texts.mapInArrow(lambda b: _block_rows(b, block_bytes, words),
                                         "block bigint, langs array<string>, n_words array<bigint>, runs binary, body binary"), "blocks")
        totals = blocks.select(F.explode(F.arrays_zip("langs", "n_words")).alias("x")).groupBy(F.col("x.langs").alias("lang")).agg(
            F.sum("x.n_words").alias("n"))
        totals = stored(totals, "lang-words")
        total = totals.agg(F.sum("n")).first()[0] or 0
        parts = max(1, min(words * total // part_entries + 1, 1 << 24))
        written = _written(blocks, _marked(blocks, words, least, parts, bits), words, parts, bits)
        often = written.groupBy("lang", "phrase").agg(F.max("words").alias("words"), F.sum("n").alias("f")).where(F.col("f") >= least)
        return stored(often, "phrases"), totals


def collocations(docs: DataFrame, words: int = WORDS, least: int = LEAST, best: int = BEST, inside: int = INSIDE, **columns) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``best`` candidates by score.

    A candidate of which ``inside`` percent of the occurrences lie in one longer candidate is left out. The score is
    floor(1000000 a a / (l r)), with l and r the frequencies of its two parts, at the cut where that is least, of equal
    cuts the first. Computed in decimals, which hold counts below 10^15.
    """
    often, totals = frequent_phrases(docs, words, least, **columns)
    candidates = often.where("words > 1").withColumnRenamed("f", "a")
    split = F.split("phrase", " ")

    def stretch(first, n):
        return F.array_join(F.slice(split, first, n), " ")

    sides = [F.struct(F.lit(k).alias("k"), F.lit(right).alias("right"),
                      (stretch(k + 1, F.greatest(F.col("words") - k, F.lit(0))) if right else stretch(1, k)).alias("part"))
             for k in range(1, words) for right in (False, True)]
    cut = candidates.select("lang", "phrase", "a", "words", F.explode(F.filter(F.array(*sides), lambda x: x["k"] < F.col("words"))).alias("side"))
    known = often.select("lang", F.col("phrase").alias("part"), "f")
    met = cut.select("lang", "phrase", "a", "side.*").join(known, ["lang", "part"])
    found = met.groupBy("lang", "phrase").agg(F.max("a").alias("a"), *[
        F.max(F.when((F.col("k") == k) & (F.col("right") == right), F.col("f"))).alias(f"{'r' if right else 'l'}{k}")
        for k in range(1, words) for right in (False, True)])

    def at_cut(k: int):
        a, l, r = (f"CAST({c} AS DECIMAL(15,0))" for c in ("a", f"l{k}", f"r{k}"))
        score = F.expr(f"(CAST(1000000 AS DECIMAL(7,0)) * {a} * {a}) DIV ({l} * {r})")
        return F.when(F.col(f"l{k}").isNotNull(), F.struct(score.alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")))

    cuts = [at_cut(k) for k in range(1, words)]
    scored = found.withColumn("cut", F.least(*cuts) if len(cuts) > 1 else cuts[0]).select("lang", "phrase", "a", "cut.*")
    if words > 2:
        longer = candidates.where("words > 2").select("lang", "a", F.explode(F.expr(
            "array_distinct(flatten(transform(sequence(2, words - 1), n -> transform(sequence(1, words - n + 1), "
            "i -> array_join(slice(split(phrase, ' '), i, n), ' ')))))")).alias("phrase"))
        longer = longer.groupBy("lang", "phrase").agg(F.max("a").alias("most"))
        scored = scored.join(longer, ["lang", "phrase"], "left").where(
            F.col("most").isNull() | (100 * F.col("most") < inside * F.col("a")))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # a language may have a third of all candidates: the best of each share first, then the best of these
    share = F.pmod(F.xxhash64("phrase"), F.lit(1 << 8))
    some = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang", share).orderBy(*order))).where(F.col("rank") <= best)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")).where(F.col("rank") <= best)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def oracle_sql(least: int = LEAST, best: int = BEST, inside: int = INSIDE) -> str:
    """For phrases of up to three words."""
    return f"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS d,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
p AS (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM d),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS words FROM p),
g AS (SELECT lang, n, unnest(list_transform(range(1, len(words) - n + 2), lambda i: array_to_string(words[i:i + n - 1], ' '))) AS phrase
  FROM w CROSS JOIN (SELECT unnest([1, 2, 3]) AS n) WHERE len(words) >= n),
f AS MATERIALIZED (SELECT lang, phrase, any_value(n) AS words, count(*) AS f FROM g GROUP BY lang, phrase),
t AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE words = 1 GROUP BY lang),
o10 AS MATERIALIZED (SELECT * FROM f WHERE f >= {least}),
c AS MATERIALIZED (SELECT lang, phrase, words, f AS a, string_split(phrase, ' ') AS s FROM o10 WHERE words > 1),
u AS MATERIALIZED (SELECT lang, phrase, a, 1 AS k, s[1] AS x, array_to_string(s[2:], ' ') AS y FROM c
  UNION ALL SELECT lang, phrase, a, 2, array_to_string(s[1:2], ' '), s[3] FROM c WHERE words = 3),
k AS (SELECT u.lang, u.phrase, u.a, k, p.f AS l, q.f AS r, CAST((1000000 * CAST(a AS HUGEINT) * a) // (CAST(p.f AS HUGEINT) * q.f) AS BIGINT) AS score
  FROM u JOIN o10 p ON p.lang = u.lang AND p.phrase = u.x JOIN o10 q ON q.lang = u.lang AND q.phrase = u.y),
b AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
o AS (SELECT lang, phrase, max(a) AS most FROM (SELECT lang, a, unnest([array_to_string(s[1:2], ' '), array_to_string(s[2:3], ' ')]) AS phrase
  FROM c WHERE words = 3) GROUP BY lang, phrase),
z AS (SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank, b.phrase, a, l, r, score
  FROM b LEFT JOIN o ON o.lang = b.lang AND o.phrase = b.phrase WHERE most IS NULL OR 100 * most < {inside} * a)
SELECT z.lang, rank, phrase, a, l, r, n, score FROM z JOIN t ON t.lang = z.lang WHERE rank <= {best}"""
