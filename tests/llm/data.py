"""Small tables that the operators' tests share."""

import random

WORDS = ["ab", "the", "é", "längst", "of", "x", "日本", "and", "License", "zu", "&&&", "Ou"]


def text(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def documents(seed=1, n=120):
    """Rows (doc_id, text) with copies, near copies, shared passages, nulls, empty and very long texts, repeated rows."""
    rng = random.Random(seed)
    passage = [text(rng, 40) for _ in range(3)]
    rows = []
    for i in range(n):
        t = text(rng, rng.randint(0, 50))
        if rng.random() < 0.4:
            p, c = rng.choice(passage), rng.randint(0, len(t))
            t = t[:c] + p[rng.randint(0, len(p) // 2):] + t[c:]
        rows.append((i, t))
    base = text(rng, 200)
    rows += [(1000 + i, base) for i in range(5)]
    rows += [(1100 + i, base + f" {'ab' if i % 2 else 'of'}") for i in range(4)]
    rows += [(1200, ""), (1201, None), (1202, " \n\t "), (1203, "one"), (1204, "one two"), (1205, "A b C d"),
             (1206, "Ou " * 5000), (1207, text(rng, 8000)), (None, base), (None, None), (7, rows[7][1]), (8, "other text")]
    rng.shuffle(rows)
    return rows


SCHEMA = "doc_id long, text string"


def frame(spark, rows=None, parts=5):
    rows = documents() if rows is None else rows
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def crowded(df):
    """The same table with columns whose names operators use inside."""
    from pyspark.sql import functions as F

    out = df
    for name in ("fp", "pack", "part", "component", "low", "words", "bucket", "n", "copy", "range", "key", "id", "cid",
                 "code", "slot", "fingerprint", "score", "lang", "source"):
        if name not in df.columns:
            out = out.withColumn(name, F.lit("x"))
    return out


def sorted_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def reach(ids, links):
    """Smallest id reachable from each id."""
    up = {i: i for i in ids}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in links:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {i: top(i) for i in ids}
