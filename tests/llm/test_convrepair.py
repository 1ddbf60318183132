"""Conversation repair against exhaustive search, a plain dynamic program and the definition of each column."""

import hashlib
import random
import re
import zlib
from itertools import product

import pytest
from pyspark.sql import functions as F

from salesflow.llm import convrepair

SCHEMA = "conv_id long, turn long, role string, text string"
INF = (10**9, "")


def turns(seed=0, conversations=60):
    rng = random.Random(seed)
    rows = []
    for c in range(conversations):
        for k in range(rng.randint(0, 9)):
            if rng.random() < 0.9:
                rows.append((c, k, rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""]),
                             rng.choice(["Hi.", "Why?", "cut", "cut", "", " \t\n", None, "End! \n", "日本。", f"No {k}.", f"x{k}"])))
    rows += [(200, None, "user", "a."), (200, None, "assistant", "b."), (200, 3, "user", "a."), (200, 3, "user", "a."), (200, 3, "system", "z.")]
    rows += [(None, k, "user" if k % 2 else "assistant", f"t{k}.") for k in range(12)] + [(None, None, None, None)]
    rows += [(300, k, rng.choice(["user", "assistant"]), "same.") for k in range(400)]
    rows += [(301, k, rng.choice(["user", "assistant", "system"]), f"{k}" + rng.choice([".", ""])) for k in range(700)]
    rows += [(302, 5, "user", "tie.")] * 300 + [(303, -4, "user", "long " * 40_000 + "."), (303, 9, "assistant", "x.")]
    rng.shuffle(rows)
    return rows


def damaged(rows):
    out = []
    for c, t, r, x in rows:
        r, x = " " if r is None else r, " " if x is None else x
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        x = "" if kind == 1 else re.sub("[.!?]", "", x) if kind == 2 else x
        out += [(c, t, "user" if kind == 4 else r, x)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def fault(row, seen):
    last = re.findall(r"[^\x20\x09-\x0D]", row[1])
    return "blank" if not last else "duplicate" if row in seen else "truncated" if last[-1] not in ".!?" else ""


def plain(rows, faults):
    """Least (cost, audit) by a dynamic program over tuples, and the repaired turns."""
    letter = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    new = (2, 2, 3, 2)
    best = [(0, "", ()), INF + ((),), INF + ((),), (0, "", ())]

    def inserts(w):
        for _ in range(3):
            w = [min(w[s], (w[new[s]][0] + 3, "I" + w[new[s]][1], (("user" if new[s] == 2 else "assistant", ""),) + w[new[s]][2])) for s in range(4)]
        return w

    best = inserts(best)
    for (role, text), bad in zip(reversed(rows), reversed(faults)):
        now = []
        for s in range(4):
            options = [(best[s][0] + 4, "D" + best[s][1], best[s][2])]
            if bad in ("", "truncated"):
                more = 3 if bad else 0
                t = new[s]
                options.append((best[t][0] + 3 + more, "R" + best[t][1], (("user" if t == 2 else "assistant", text),) + best[t][2]))
                if role[:1] in letter[s]:
                    t = letter[s][role[:1]]
                    options.append((best[t][0] + more, "K" + best[t][1], ((role, text),) + best[t][2]))
            now.append(min(options))
        best = inserts(now)
    return best[0]


def brute(rows, damage=damaged):
    left = damage(rows)
    out = []
    for c in {r[0] for r in rows}:
        mine = sorted((r[1:] for r in left if r[0] == c), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
        seen, faults = set(), []
        for _, r, x in mine:
            faults.append(fault((r, x), seen))
            seen.add((r, x))
        numbers = [t for t, _, _ in mine if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        cost, audit, fixed = plain([m[1:] for m in mine], faults)
        text = "\n".join(f"{r}:{x}" for r, x in fixed)
        out.append((c, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit,
                    hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("chunk", [convrepair.CHUNK, 3])
def test_whole_result_against_brute_force(spark, chunk, monkeypatch):
    monkeypatch.setattr(convrepair, "CHUNK", chunk)
    rows = turns()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got(convrepair.report(convrepair.damage(df))) == brute(rows)


def code_of(role, bad):
    return chr(65 + 4 * {"s": 0, "u": 1, "a": 2}.get(role, 3) + ["", "truncated", "blank", "duplicate"].index(bad))


@pytest.mark.parametrize("chunk", [256, 1, 2])
def test_decisions_against_exhaustive_search(chunk, monkeypatch):
    """Every edit of every turn, and up to two turns put in at every place."""
    monkeypatch.setattr(convrepair, "CHUNK", chunk)
    kinds = [(r, f) for r in "suax" for f in ("", "truncated", "blank")]
    rng = random.Random(3)
    cases = [()] + [(k,) for k in kinds] + [tuple(rng.choice(kinds) for _ in range(2)) for _ in range(40)]
    cases += [tuple(rng.choice(kinds) for _ in range(3)) for _ in range(25)]
    gaps = [("", 0, "")] + [("I", 3, a) for a in "ua"] + [("II", 6, a + b) for a in "ua" for b in "ua"]
    for case in cases:
        edits = [[("D", 4, "")] + ([] if f == "blank" else [(e, c + 3 * (f == "truncated"), x) for e, c, x in (("K", 0, r), ("R", 3, "u"), ("R", 3, "a"))])
                 for r, f in case]
        steps = [gaps]
        for e in edits:
            steps += [e, gaps]
        best = min((sum(c for _, c, _ in way), "".join(a for a, _, _ in way)) for way in product(*steps)
                   if re.fullmatch("(s?(ua)+)?", "".join(x for _, _, x in way)))
        assert convrepair.decide("".join(code_of(*k) for k in case)) == best


def test_long_conversations_take_linear_integers():
    """Chunked or whole, the decision is the same."""
    rng = random.Random(9)
    codes = "".join(chr(65 + rng.randrange(16)) for _ in range(3000))
    chunked = convrepair.decide(codes)
    low, weights = convrepair._chunk_weights(codes, [0, convrepair.NEVER, convrepair.NEVER, 0], True)
    assert weights[0] >> low == chunked[0]
    letters = bin(weights[0] & ((1 << low) - 1))[2:].zfill(low)
    audit = "".join(convrepair.LETTER[int(letters[i:i + 3], 2)] for i in range(0, low, 3) if letters[i:i + 3] != "000")
    assert audit == chunked[1]


def test_repaired_turns_follow_the_pattern(spark):
    rows = turns(5, 30)
    df = convrepair.damage(spark.createDataFrame(rows, SCHEMA))
    decided = convrepair.decisions(df)
    told = {r.conv_id: r for r in decided.collect()}
    fixed = {}
    for r in sorted(convrepair.repair(df, decided).collect(), key=lambda r: (str(r.conv_id), r.place)):
        fixed.setdefault(r.conv_id, []).append(r)
    assert set(told) == {r[0] for r in rows}
    for c, rs in fixed.items():
        assert [r.place for r in rs] == list(range(len(rs)))
        assert re.fullmatch("s?(ua)+", "".join(r.role[0] for r in rs))
        assert [r.edit for r in rs] == [{"K": "keep", "R": "rerole", "I": "insert"}[x] for x in told[c].audit if x != "D"]
    hashes = {c: hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in rs).encode()).hexdigest() for c, rs in fixed.items()}
    empty = hashlib.sha256(b"").hexdigest()
    assert all(h.repaired_sha256 == hashes.get(h.conv_id, empty) for h in convrepair.digests(df, decided).collect())


@pytest.mark.parametrize("extra", ["c", "t", "d", "at", "digest", "audit", "codes", "place", "blank"])
def test_clashing_columns_and_empty_table(spark, extra):
    rows = turns(2, 10)[:80]
    df = spark.createDataFrame(rows, SCHEMA).withColumn(extra, F.lit(1))
    assert got(convrepair.report(convrepair.damage(df))) == brute(rows)
    assert convrepair.report(convrepair.damage(df.limit(0))).collect() == []


def test_undamaged_turns_and_text_ids(spark):
    df = spark.createDataFrame([("a", 1, "user", "Hi."), ("a", 2, "assistant", "Yes."), (None, 1, "assistant", "No.")],
                               "conv_id string, turn long, role string, text string")
    told = {r.conv_id: (r.cost, r.audit) for r in convrepair.report(df).collect()}
    assert told == {"a": (0, "KK"), None: (3, "IK")}
