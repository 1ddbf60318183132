"""Phrase collocations against a count in plain Python and DuckDB SQL, with forced collisions and cut texts."""

import random
import re
import tracemalloc
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from salesflow.llm import collocations

SCHEMA = "doc_id long, text string, lang string"
WORDS = ["ab", "The", "THE", "é", "É", "längst", "of", "x", "日本", "New", "york", "city", "&&&", "a" * 300, "i"]


def rows(seed=0, n=150):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        parts = []
        for _ in range(rng.randint(0, 60)):
            parts.append(rng.choice(["new York city", "of the", rng.choice(WORDS), rng.choice(WORDS)]))
            parts.append(rng.choice([" ", " ", " ", "  ", "\t ", ". ", ",", "\n", "\r\n", "! ?", "\x0b", " ", "-"]))
        out.append((i, "".join(parts), rng.choice(["en", "en", "de", None, "und"])))
    out += [(1000 + i, "copy of the hot passage, of the same words", "en") for i in range(40)]
    out += [(2000, None, "en"), (2001, "", "en"), (2002, " \t.\n", "fr"), (2003, "one", "fr"), (2004, "a b " * 3000, "de"), (2005, "x" * 5000, "en"),
            (2006, "x" * 5000 + " x. " + "the of " * 500, None), (None, "of the of the", "en"), (None, None, None), (5, out[5][1], out[5][2])]
    rng.shuffle(out)
    return out


def counts(rows, longest=3):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f.update((lang, *words[i:i + k]) for i in range(len(words) - k + 1))
    return f, n


def brute(rows, longest=3, least=10, best=2000, inside=50):
    f, n = counts(rows, longest)
    found, most = {}, Counter()
    for p, a in f.items():
        lang, words = p[0], p[1:]
        if len(words) > 1 and a >= least:
            cuts = [(1000000 * a * a // (f[(lang, *words[:k])] * f[(lang, *words[k:])]), k) for k in range(1, len(words))]
            score, k = min(cuts)
            found[p] = (score, a, f[(lang, *words[:k])], f[(lang, *words[k:])])
            for size in range(2, len(words)):
                for i in range(len(words) - size + 1):
                    sub = (lang, *words[i:i + size])
                    most[sub] = max(most[sub], a)
    out = []
    for lang in n:
        kept = sorted(((-s, -a, " ".join(p[1:]).encode(), l, r) for p, (s, a, l, r) in found.items()
                       if p[0] == lang and 100 * most[p] < inside * a))
        out += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(kept[:best])]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("options", [{}, {"bits": 6, "block_bytes": 3000}, {"block_bytes": 200, "part_entries": 500}, {"bits": 1, "block_bytes": 1 << 20}],
                         ids=["production", "collisions", "small blocks", "two fingerprints"])
def test_whole_result_against_brute_force(spark, options):
    df = spark.createDataFrame(rows(), SCHEMA).repartition(4)
    want = brute(rows())
    assert len(want) > 50
    assert got(collocations.collocations(df, **options)) == want


@pytest.mark.parametrize("words,least,best,inside", [(2, 3, 5, 50), (4, 4, 30, 80)])
def test_other_limits(spark, words, least, best, inside):
    df = spark.createDataFrame(rows(1), SCHEMA)
    assert got(collocations.collocations(df, words, least, best, inside)) == brute(rows(1), words, least, best, inside)


def test_against_sql(spark):
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar, lang varchar)")
    con.executemany("insert into documents values (?, ?, ?)", rows(2))
    assert sorted(con.execute(collocations.oracle_sql()).fetchall()) == brute(rows(2))


def test_counts_may_pass_64_bits(spark):
    """The score's decimals, for counts of 10^14."""
    a, l, r = 10**14 + 7, 2 * 10**14 + 1, 10**14 + 9
    said = spark.sql(f"SELECT (CAST(1000000 AS DECIMAL(7,0)) * CAST({a}L AS DECIMAL(15,0)) * CAST({a}L AS DECIMAL(15,0))) DIV "
                     f"(CAST({l}L AS DECIMAL(15,0)) * CAST({r}L AS DECIMAL(15,0))) AS x").first().x
    assert said == 1000000 * a * a // (l * r)


def test_fingerprints_are_position_free_and_prefix_polynomials_cross_segments():
    rng = np.random.default_rng(0)
    values = rng.integers(0, 1 << 63, collocations.SEGMENT * 2 + 77).astype(np.uint64)
    values[collocations.SEGMENT - 3:collocations.SEGMENT + 5] = values[10:18]
    first = np.array([10, collocations.SEGMENT - 3], np.int64)
    key = collocations._polynomial("word").of(values, first, first + 8)
    base = collocations._BASES["word"]
    assert key[0] == key[1] == sum(int(v) * base**i for i, v in enumerate(values[10:18])) % (1 << 64)


@pytest.mark.parametrize("size", [1, 7, 50, 400])
def test_cut_texts_count_the_same(size):
    for _, text, _ in rows(3, 40):
        raw = (text or "").encode()[:4000]
        raw = raw.decode("utf-8", "ignore").encode()
        parts, runs = [], []
        at = 0
        for a, counted, end in collocations._cuts(raw, size, 3):
            parts.append(raw[a:end])
            runs.append((at + end - a, at + counted - a, 0))
            at += end - a
        seen = Counter()
        if runs:
            block = collocations.Block(b"".join(parts), np.array(runs, np.int64).T.copy(), ["en"])
            key, _ = block.entries()
            for _, phrases, _, n in block.frequent(np.ones(len(key), bool)):
                seen.update(dict(zip(phrases, n.tolist())))
        assert seen == Counter({" ".join(p[1:]): c for p, c in counts([(0, raw.decode(), "en")])[0].items()})


@pytest.mark.parametrize("extra", ["block", "phrase", "f", "n", "rank", "part", "words"])
def test_clashing_columns_and_empty_tables(spark, extra):
    df = spark.createDataFrame(rows(4, 30), SCHEMA).withColumn(extra, F.lit("z"))
    assert got(collocations.collocations(df)) == brute(rows(4, 30))
    assert got(collocations.collocations(df.limit(0))) == []
    assert got(collocations.collocations(df.where("text is null"))) == []


def test_pointers_come_back_in_the_order_they_were_sent():
    rng = np.random.default_rng(1)
    lists = [np.unique(rng.integers(0, 50, 30).astype(np.uint64)) for _ in range(6)]
    told = collocations._answers([collocations._squeeze(k, np.ones(len(k), np.int64)) for k in lists], 4)
    total = Counter(x for k in lists for x in k.tolist())
    for k, bits in zip(lists, told):
        often = [total[x] >= 4 for x in k.tolist()]
        assert (np.unpackbits(np.frombuffer(bits, np.uint8), count=len(k)).astype(bool).tolist() if bits else [False] * len(k)) == often


def peak(run):
    """Bytes held at most, of Python and numpy."""
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_a_task_holds_few_numbers_for_each_phrase():
    """At the size of production: two workers of an executor stopped it at 64 bytes a phrase and 66 an entry."""
    rng = np.random.default_rng(0)
    vocabulary = ["".join(map(chr, rng.integers(97, 123, n))) for n in rng.integers(2, 9, 20000)]
    body = " ".join(vocabulary[i] + ("" if i % 11 else ".") for i in rng.zipf(1.3, 700_000) % 20000).encode()
    runs = np.array([[len(body)], [len(body)], [0]], np.int64)
    key, count = collocations.Block(body, runs, ["en"]).entries()
    phrases = int(count.sum())
    assert phrases > 1_900_000
    seen = []
    assert peak(lambda: collocations.Block(body, runs, ["en"]).entries()) < 45 * phrases
    assert peak(lambda: seen.extend(int(n.sum()) for *_, n in collocations.Block(body, runs, ["en"]).frequent(count >= 1))) < 45 * phrases
    assert sum(seen) == phrases
    blobs = [collocations._squeeze(x, np.ones(len(x), np.int64)) for x in np.array_split(key, 10)] * 4
    assert peak(lambda: collocations._answers(blobs, 4)) < 50 * 4 * len(key)


def test_workers_get_small_batches_and_the_setting_comes_back(spark):
    before = spark.conf.get(collocations._ARROW_BYTES)
    with pytest.raises(ZeroDivisionError), collocations._small_batches(spark):
        texts = spark.range(0, 2000, 1, 1).selectExpr("repeat('abc ', 5000) AS s")
        sizes = texts.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.nbytes]}) for b in batches), "n long").collect()
        assert sum(r.n for r in sizes) > 40e6 and max(r.n for r in sizes) < 2 * collocations.BATCH_BYTES
        1 / 0
    assert spark.conf.get(collocations._ARROW_BYTES) == before
