import hashlib

import numpy as np
import pytest

from salesflow.llm import sharding

from .data import crowded, documents, frame


def slow_table(shards, size):
    """Each shard's whole preference list, walked in turns."""
    lists = []
    for name in shards:
        d = hashlib.md5(name.encode()).digest()
        start, step = int.from_bytes(d[:8], "little") % size, int.from_bytes(d[8:], "little") % (size - 1) + 1
        lists.append([(start + k * step) % size for k in range(size)])
    owner, free = [None] * size, size
    while free:
        for s, prefer in enumerate(lists):
            slot = next((x for x in prefer if owner[x] is None), None)
            if slot is not None:
                owner[slot] = s
                free -= 1
    return owner


@pytest.mark.parametrize("n", [1, 2, 5, 13])
def test_table_against_preference_lists(n):
    names = [f"s{i}" for i in range(n)]
    assert sharding.lookup_table(names, 13).tolist() == slow_table(names, 13)
    assert sharding.lookup_table(names, 101).tolist() == slow_table(names, 101)


def test_shares_are_even_and_few_slots_move():
    full = sharding.lookup_table()
    count = np.bincount(full)
    assert count.max() - count.min() <= 1
    fewer = sharding.lookup_table(sharding.SHARDS[:-1])
    stay = full != len(sharding.SHARDS) - 1
    assert (full[stay] != fewer[stay]).mean() < 0.1


def test_every_row_is_placed(spark):
    rows = documents()
    got = sharding.place(crowded(frame(spark, rows)).drop("key"))
    got = [tuple(r) for r in got.collect()]
    assert sorted((r[0] for r in got), key=str) == sorted((i for i, _ in rows), key=str)
    owner = sharding.lookup_table()
    for key, slot, shard in got:
        want = int(hashlib.md5(str("" if key is None else key).encode()).hexdigest()[:15], 16) % sharding.TABLE_SIZE
        assert slot == want and shard == sharding.SHARDS[owner[slot]]
    assert sharding.place(frame(spark, rows).limit(0)).collect() == []


@pytest.mark.parametrize("shards,size", [(["a"], 10), ([], 13), (["a", "a"], 13), ([str(i) for i in range(14)], 13)])
def test_bad_tables(shards, size):
    with pytest.raises(ValueError):
        sharding.lookup_table(shards, size)
