import random
from itertools import combinations

import duckdb
import pytest

from salesflow.llm import packing

from .data import crowded, documents, frame, sorted_rows


def padded(histogram, bounds):
    return sum(n * min(b for b in bounds if b >= x) for x, n in histogram.items())


@pytest.mark.parametrize("seed", range(8))
def test_bounds_are_optimal(seed):
    rng = random.Random(seed)
    histogram = {rng.randint(1, 60): rng.randint(1, 30) for _ in range(rng.randint(1, 11))}
    for k in (1, 2, 3, 4):
        bounds = packing.bucket_bounds(histogram, k)
        best = min(padded(histogram, [*c, max(histogram)]) for m in range(k) for c in combinations(sorted(histogram)[:-1], m))
        assert len(bounds) <= k and bounds[-1] == max(histogram) and padded(histogram, bounds) == best
    assert packing.bucket_bounds({0: 5}, 3) == [] and packing.bucket_bounds({}, 3) == []


def oracle(rows):
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", rows)
    return con.execute(packing.oracle_sql()).fetchall()


def test_whole_result_against_sql_and_budget(spark):
    rows = [r for r in documents() if r[0] is not None]
    got = sorted_rows(packing.pack(frame(spark, rows)))
    assert got == sorted(oracle(rows), key=str)
    batches = {}
    for _, _, n, bucket, batch, place in got:
        if bucket:
            assert 0 < n <= bucket
            batches.setdefault((bucket, batch), []).append(place)
        else:
            assert n == 0 and batch is None and place is None
    for (bucket, _), places in batches.items():
        assert sorted(places) == list(range(len(places))) and len(places) * bucket <= packing.TOKEN_BUDGET
    words = {}
    for i, _, n, *_ in got:
        words[i] = words.get(i, 0) + n
    assert sum(words.values()) == sum(len((t or "").replace(" ", "_").split()) for _, t in rows)


def test_nulls_extra_columns_and_empty_table(spark):
    rows = documents(2, 20)
    df = crowded(frame(spark, rows))
    got = packing.pack(df, max_len=64, n_buckets=3, token_budget=128).collect()
    assert {r.doc_id for r in got} == {i for i, _ in rows}
    assert max(r.n_words for r in got) == 64 and len({r.bucket for r in got} - {0}) <= 3
    assert packing.pack(df.limit(0)).collect() == []
    with pytest.raises(ValueError):
        packing.pack(df, max_len=10, token_budget=9)


def test_a_length_column_is_packed_like_texts_of_that_length(spark):
    rows = [r for r in documents(6, 40) if r[0] is not None]
    counted = [(i, len((t or "").replace("\xa0", "_").split()) if t else None) for i, t in rows]
    df = spark.createDataFrame(counted, "doc_id long, n_tokens int")
    by_text = packing.pack(frame(spark, rows), max_len=64, token_budget=256)
    assert sorted_rows(packing.pack(df, max_len=64, token_budget=256, length_col="n_tokens")) == sorted_rows(by_text)
    odd = spark.createDataFrame([(1, -5), (2, None), (3, 3)], "doc_id long, n_tokens int")
    assert [(r.doc_id, r.n_words) for r in packing.pack(odd, length_col="n_tokens").orderBy("doc_id").collect()] == [(1, 0), (2, 0), (3, 3)]
