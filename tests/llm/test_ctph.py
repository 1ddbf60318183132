import hashlib
import random
import time

import pytest

from salesflow.llm import ctph

from .data import crowded, documents, frame, sorted_rows


def brute(rows):
    rows = [(i, t or "") for i, t in rows]
    order = sorted((r for r in rows if r[0] is not None), key=lambda r: (-r[0], r[1].encode()))
    after = {}
    out = []
    for k, (i, t) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        out.append((i, t, after))
    out += [(i, t, "") for i, t in rows if i is None]
    got = []
    for i, t, nxt in out:
        cut = len(t) // 3
        e = (t[:len(t) - cut] + nxt[:cut]).encode()
        a, b, c = ctph.fingerprint(t.encode()), ctph.fingerprint(e), ctph.fingerprint(nxt.encode())
        got.append((i, len(t), hashlib.sha256(e).hexdigest(), a, b, ctph.likeness(a, b), ctph.likeness(a, c)))
    return sorted(got, key=str)


@pytest.mark.parametrize("parts", ["2", "8"])
def test_whole_result_against_brute_force(spark, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        rows = documents()
        assert sorted_rows(ctph.fingerprints(frame(spark, rows))) == brute(rows)
        few = [(1, "one row only " * 9)]
        assert sorted_rows(ctph.fingerprints(frame(spark, few))) == brute(few)
        nulls = [(None, "a"), (None, None)]
        assert sorted_rows(ctph.fingerprints(frame(spark, nulls))) == brute(nulls)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_extra_columns_and_empty_table(spark):
    rows = documents(4, 20)
    df = crowded(frame(spark, rows))
    assert sorted_rows(ctph.fingerprints(df)) == brute(rows)
    assert ctph.fingerprints(df.limit(0)).collect() == []


def prose(rng, n):
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(n)).encode()


def test_likeness_tells_edits_from_other_texts():
    rng = random.Random(0)
    for n in (60, 400, 5000):
        a, b = prose(rng, n), prose(rng, n)
        cut = len(a) * 2 // 3
        assert ctph.likeness(ctph.fingerprint(a), ctph.fingerprint(a[:cut] + b[:len(a) - cut])) > 0.4
        assert ctph.likeness(ctph.fingerprint(a), ctph.fingerprint(b)) < 0.3
        assert ctph.likeness(ctph.fingerprint(a), ctph.fingerprint(a)) == 1.0


def test_chunks_do_not_depend_on_their_place():
    rng = random.Random(1)
    body = prose(rng, 2000)
    for lead in (b"", b"x" * 37, prose(rng, 12_000)):
        block = 128
        one = ctph.fingerprint(body)
        moved = ctph.fingerprint(lead + body)
        assert block and ctph.likeness(one, moved) > (0.9 if len(lead) < 100 else -1)


def slow_subsequence(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_signature_likeness_is_the_insert_delete_distance():
    rng = random.Random(2)
    for _ in range(200):
        core = "".join(rng.choices("ABCDE", k=8))
        a, b = core + "".join(rng.choices("ABCDE", k=rng.randint(0, 50))), "".join(rng.choices("ABCDE", k=rng.randint(0, 50))) + core
        got = ctph.signature_likeness(a, b)
        assert got == (1.0 if a == b else 2 * slow_subsequence(a, b) / (len(a) + len(b)))
    assert ctph.likeness("4:ABC:AB", "64:ABC:AB") == 0.0 and ctph.likeness("4::", "4::") == 1.0


@pytest.mark.parametrize("unit", ["abc ", "the same line over and over again, with its end\n", "ab" * 40 + "\n", "a"])
def test_long_repetitive_texts_have_bounded_signatures(unit):
    """Sixteen MB: fingerprinted and compared in linear time."""
    rng = random.Random(5)
    text = unit * (16_000_000 // len(unit))
    tail = text[:len(text) * 2 // 3] + prose(rng, 800_000).decode()[:len(text) // 3]
    start = time.process_time()
    a, b = ctph.fingerprint(text.encode()), ctph.fingerprint(tail.encode())
    told = ctph.likeness(a, b)
    assert time.process_time() - start < 20  # a quadratic comparison takes many minutes
    assert max(map(len, (*a.split(":")[1:], *b.split(":")[1:]))) <= ctph.MOST
    assert 0 <= told <= 1 and ctph.likeness(a, a) == 1.0


def test_comparing_takes_a_bounded_time():
    rng = random.Random(6)
    a, b = ("".join(rng.choices("ABCDEFGH", k=ctph.MOST)) for _ in range(2))
    start = time.process_time()
    for _ in range(100):
        ctph.likeness(f"4:{a}:{b}", f"4:{b}:{a}")
    assert time.process_time() - start < 2


def test_runs_are_folded_and_the_last_letter_covers_the_rest():
    rng = random.Random(7)
    assert "AAAA" not in ctph.fingerprint(b"-" * 5000 + prose(rng, 500))
    long = b"abcdefgh" * 2000 + prose(rng, 3)
    # what comes after the last boundary that has a letter still changes the fingerprint
    assert ctph.fingerprint(long + b"x") != ctph.fingerprint(long + b"y")


def test_ordinary_texts_are_never_cut():
    rng = random.Random(8)
    for n in (10, 100, 1000, 10_000):
        parts = ctph.fingerprint(prose(rng, n)).split(":")
        assert len(parts[1]) < 2 * ctph.LENGTH and len(parts[2]) < 2 * ctph.LENGTH
