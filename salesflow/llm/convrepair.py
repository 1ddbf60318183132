"""Repair of conversation structure: the cheapest edits that make the roles alternate.

The initials of a conversation's roles shall read as nothing, or as an optional s (system) and then pairs ua (user,
assistant). Each turn is kept, given another role or deleted; turns without text may be put in anywhere. Blank turns and
turns seen before must go; a turn that ends without ``.``, ``!`` or ``?`` costs more to leave in. Of the cheapest
edits those with the least audit (their initials in order, by ASCII) are taken.

Both demands are one number: the high digits of an integer carry the cost, its low digits the audit, one digit of three bits for
a letter (D 1, I 2, K 3, R 4) in a field of fixed width, the first letter highest, zeros after the last. The least
integer is then the answer, and a plain dynamic program over the graph (turn, state of the pattern), from the last turn back,
decides everything: putting a letter in front adds its cost above and moves the letters down by a digit.

Long conversations are decided in chunks of ``CHUNK`` turns, from the last to the first, so that integers stay short and the
work is linear: a chunk starts from the costs that the chunk behind it has for each state, with empty letters. This is exact. Edits
put in between two chunks belong to the chunk behind, so the letters of a chunk end with those of a turn; two letter
strings for the same turns at the same cost are then never the start of one another (they would differ by inserts, which
cost), and equal strings lead to the same state. What follows therefore never decides between them.

How it runs: texts are judged where they are read. Turns without their texts (a digest stands for each) are folded, told
whether they were seen before, and sorted by conversation; one stream decides each conversation, with a byte for each
turn in memory. The texts are shuffled once, sorted, and edited as they stream by. A conversation may have any number of
turns; as its audit and its hash are one value each, it is written by one task.

Order of turns: by turn number, missing numbers first, then role, then the SHA-256 of the text.

Defined results: a null role or text is one space. A role with another initial than s, u or a can't be kept. Turns of null
conversation id are one conversation. Repeated rows are duplicates of the first. An empty table gives an empty
result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

CHUNK = 256
SPACES = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
DIGIT = {"D": 1, "I": 2, "K": 3, "R": 4}
LETTER = {n: x for x, n in DIGIT.items()}
BITS, MOST_INSERTS = 3, 2
# states of the pattern: nothing yet, after s, after u, after a; what a new turn becomes there; where a kept turn leads
NEW = (2, 2, 3, 2)
KEPT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
FULL = (0, 3)
ROLE = {2: "user", 3: "assistant"}
INITIALS = "sua-"
FINE, CUT, BLANK, DUPLICATE = range(4)
NEVER = 1 << 62  # a cost that no edits reach


def damage(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): turns damaged by the CRC of ``conv_id:turn``; a dropped one has 0 copies."""
    def filled(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn")).cast("binary")) % 20
    return turns.select(
        "conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(filled("role")).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(filled("text"), ".!?", "")).otherwise(filled("text")).alias("text"),
        F.when(kind == 0, F.lit(0)).when(kind == 3, F.lit(2)).otherwise(F.lit(1)).alias("copies"))


def _turns(df: DataFrame) -> DataFrame:
    """The columns in their defined form, with the digest that orders equal turns."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    copies = F.col("copies").cast("bigint") if "copies" in df.columns else F.lit(1).cast("bigint")
    return df.select("conv_id", F.col("turn").cast("bigint").alias("turn"),
                     F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
                     text.alias("text"), copies.alias("copies"), F.unhex(F.sha2(text, 256)).alias("digest"))


def coded(df: DataFrame) -> DataFrame:
    """(conv_id, turn, role, digest, codes) of different turns; ``codes`` has a letter for each copy, which tells the role's
    initial and the first fault. No text is moved, and equal turns are folded where they are read."""
    t = _turns(df)
    bare = F.rtrim(F.col("text"), F.lit(SPACES))
    t = t.select("conv_id", "turn", "role", "digest", "copies", (bare == "").alias("blank"),
                 (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("cut"))
    t = t.groupBy("conv_id", "turn", "role", "digest").agg(
        F.sum("copies").alias("copies"), F.max("blank").alias("blank"), F.max("cut").alias("cut"))
    place = F.struct(F.col("turn").isNotNull().alias("has"), "turn")
    first = t.where("copies > 0").groupBy("conv_id", "role", "digest").agg(F.min(place).alias("at")).select(
        F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), F.col("at.turn").alias("t"),
        F.lit(True).alias("first"))
    # joined by the whole key, which neither side has twice: a text said any number of times is no hot key
    t = t.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & F.col("turn").eqNullSafe(F.col("t"))
               & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d")), "left")
    again = F.when(F.col("blank"), F.lit(BLANK)).otherwise(F.lit(DUPLICATE))
    fault = F.when(F.col("blank") | F.col("first").isNull(), again).when(F.col("cut"), F.lit(CUT)).otherwise(F.lit(FINE))
    letter = F.left("role", F.lit(1))
    initial = F.when(letter == "s", F.lit(0)).when(letter == "u", F.lit(1)).when(letter == "a", F.lit(2)).otherwise(F.lit(3))

    def code(f: Column) -> Column:
        return F.char(initial * 4 + f + 65)

    codes = F.when(F.col("copies") > 0, F.concat(code(fault), F.repeat(code(again), (F.col("copies") - 1).cast("int"))))
    return t.select("conv_id", "turn", "role", "digest", F.coalesce(codes, F.lit("")).alias("codes"))


def _chunk_weights(codes: str, behind: list[int], last: bool) -> tuple[int, list[int]]:
    """(width of the letters, the least weight of the chunk's turns and of all behind for each state before them)."""
    low = BITS * ((MOST_INSERTS + 1) * len(codes) + MOST_INSERTS)
    mask, top = (1 << low) - 1, low - BITS

    def front(letter: str, cost: int, weight: int) -> int:
        return (((weight >> low) + cost) << low) + (DIGIT[letter] << top) + ((weight & mask) >> BITS)

    def inserted(w: list[int]) -> list[int]:
        """Least weights when turns may be put in first."""
        for _ in range(MOST_INSERTS):
            w = [min(x, front("I", INSERT, w[NEW[s]])) for s, x in enumerate(w)]
        return w

    weights = [c << low for c in behind]
    if last:
        weights = inserted(weights)
    for code in reversed(codes):
        kind, fault = divmod(ord(code) - 65, 4)
        now = [front("D", DELETE, w) for w in weights]
        if fault in (FINE, CUT):
            more = TRUNCATED if fault == CUT else 0
            for s in range(4):
                options = [now[s], front("R", REROLE + more, weights[NEW[s]])]
                to = KEPT[s].get(INITIALS[kind])
                if to is not None:
                    options.append(front("K", KEEP + more, weights[to]))
                now[s] = min(options)
        weights = inserted(now)
    return low, weights


def decide(codes: str) -> tuple[int, str]:
    """(cost, audit) of the cheapest edits of one conversation, given by its code letters."""
    behind = [0 if s in FULL else NEVER for s in range(4)]
    starts = range(0, max(len(codes), 1), CHUNK)
    solved = []
    for at in reversed(starts):
        low, weights = _chunk_weights(codes[at:at + CHUNK], behind, at == starts[-1])
        solved.append((at, low, weights))
        behind = [w >> low for w in weights]
    state, audit = 0, []
    for at, low, weights in reversed(solved):
        turns, weight = iter(codes[at:at + CHUNK]), weights[state]
        for shift in range(low - BITS, -1, -BITS):
            if not (digit := weight >> shift & 7):
                break
            audit.append(LETTER[digit])
            state = _step(state, audit[-1], turns)
    return behind[0], "".join(audit)


def _step(state: int, letter: str, codes: Iterator[str]) -> int:
    """The state after an edit; ``codes`` are the turns still to come."""
    if letter == "I":
        return NEW[state]
    initial = INITIALS[(ord(next(codes)) - 65) // 4]
    return state if letter == "D" else NEW[state] if letter == "R" else KEPT[state][initial]


class _Conversation:
    """What is noted of a conversation while its turns stream by."""

    def __init__(self) -> None:
        self.codes: list[str] = []
        self.low = self.high = None
        self.numbers = 0

    def add(self, turn: int | None, codes: str) -> None:
        if codes:
            self.codes.append(codes)
            if turn is not None and turn != self.high:  # turns come in order
                self.low = turn if self.low is None else self.low
                self.high, self.numbers = turn, self.numbers + 1

    def row(self) -> tuple:
        codes = "".join(self.codes)
        faults = [sum(codes.count(chr(65 + 4 * i + f)) for i in range(4)) for f in (BLANK, DUPLICATE, CUT)]
        initials = codes.translate({65 + c: INITIALS[c // 4] for c in range(16)})
        illegal = max(len(codes) - 1, 0) - sum(initials.count(pair) for pair in ("su", "ua", "au"))
        gaps = self.high - self.low + 1 - self.numbers if self.numbers else 0
        return gaps, *faults, illegal, *decide(codes)


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _decisions(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind, told, open_id, talk = None, [], None, None

    def packed() -> pa.RecordBatch:
        cols = list(zip(*told))
        return pa.RecordBatch.from_arrays(
            [pa.array(cols[0], kind), *(pa.array(c, pa.int64()) for c in cols[1:-1]), pa.array(cols[-1], pa.string())],
            ["conv_id", *COUNTS, "audit"])

    for batch in batches:
        kind = batch.column(0).type
        for conv, turn, codes in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if talk is None or conv != open_id:
                if talk is not None:
                    told.append((open_id, *talk.row()))
                open_id, talk = conv, _Conversation()
            talk.add(turn, codes)
        if told:
            yield packed()
            told = []
    if talk is not None:
        told.append((open_id, *talk.row()))
        yield packed()


def decisions(turns: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of every conversation; ``copies`` tells how often
    each turn stands (once, where there is no such column)."""
    kind = dict(turns.dtypes)["conv_id"]
    order = coded(turns).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "digest")
    return order.select("conv_id", "turn", "codes").mapInArrow(
        _decisions, f"conv_id {kind}, {', '.join(f'{c} bigint' for c in COUNTS)}, audit string")


def _edited(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, place, turn, role, text, edit) of every turn that stays or comes; (conv_id, None...) opens a conversation."""
    conv, audit, at, state, place = None, "", 0, 0, 0

    def insert() -> tuple:
        nonlocal at, state, place
        at, state, place = at + 1, NEW[state], place + 1
        return conv, place - 1, None, ROLE[state], "", "insert"

    for batch in batches:
        for new, told, turn, role, text, copies in zip(*(c.to_pylist() for c in batch.columns)):
            if told is not None:  # the audit comes before the turns
                while at < len(audit):
                    yield insert()
                conv, audit, at, state, place = new, told, 0, 0, 0
                yield conv, None, None, None, None, None
                continue
            for _ in range(copies):
                while audit[at] == "I":
                    yield insert()
                letter, at = audit[at], at + 1
                if letter != "D":
                    state = NEW[state] if letter == "R" else KEPT[state][role[0]]
                    place += 1
                    yield conv, place - 1, turn, *((ROLE[state], text, "rerole") if letter == "R" else (role, text, "keep"))
    while at < len(audit):
        yield insert()


def _streamed(turns: DataFrame, decided: DataFrame) -> DataFrame:
    """The audit of each conversation, then its turns in order: the one shuffle of texts."""
    said = _turns(turns).where("copies > 0").select("conv_id", F.lit(None).cast("string").alias("audit"), "turn", "role", "text", "copies", "digest")
    heads = decided.select("conv_id", "audit", *[F.lit(None).cast(said.schema[c].dataType).alias(c) for c in said.columns[2:]])
    both = said.unionByName(heads).repartition("conv_id")
    return both.sortWithinPartitions("conv_id", F.col("audit").isNull(), "turn", "role", "digest").drop("digest")


def repair(turns: DataFrame, decided: DataFrame) -> DataFrame:
    """(conv_id, place, turn, role, text, edit) of the repaired conversations; ``decided`` is what ``decisions`` gave for the
    same turns (stored, if it is used twice). Edit is keep, rerole or insert, place counts from 0."""
    kind = dict(turns.dtypes)["conv_id"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = None
        rows: list[tuple] = []

        def noted() -> Iterator[pa.RecordBatch]:
            nonlocal types
            for batch in batches:
                types = [batch.column(0).type, pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
                yield batch

        def packed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                              ["conv_id", "place", "turn", "role", "text", "edit"])

        for row in _edited(noted()):
            if row[1] is not None:
                rows.append(row)
            if len(rows) == 1000:
                yield packed()
                rows = []
        if rows:
            yield packed()

    return _streamed(turns, decided).mapInArrow(
        run, f"conv_id {kind}, place bigint, turn bigint, role string, text string, edit string")


def digests(turns: DataFrame, decided: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): the hash of each repaired conversation, its ``role:text`` joined by newlines."""
    kind = dict(turns.dtypes)["conv_id"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, hashes, id_type, sha = [], [], None, None

        def noted() -> Iterator[pa.RecordBatch]:
            nonlocal id_type
            for batch in batches:
                id_type = batch.column(0).type
                yield batch

        for conv, place, _, role, text, _ in _edited(noted()):
            if place is None:
                if sha is not None:
                    hashes.append(sha.hexdigest())
                ids.append(conv)
                sha = hashlib.sha256()
            else:
                sha.update((b"\n" if place else b"") + f"{role}:{text}".encode())
            if len(ids) > 1000:
                yield pa.RecordBatch.from_arrays([pa.array(ids[:-1], id_type), pa.array(hashes)], ["conv_id", "repaired_sha256"])
                ids, hashes = ids[-1:], []
        if sha is not None:
            hashes.append(sha.hexdigest())
            yield pa.RecordBatch.from_arrays([pa.array(ids, id_type), pa.array(hashes)], ["conv_id", "repaired_sha256"])

    return _streamed(turns, decided).mapInArrow(run, f"conv_id {kind}, repaired_sha256 string")


def report(turns: DataFrame) -> DataFrame:
    """What was found in each conversation, its cheapest edits and the hash of the repaired text."""
    decided = stored(decisions(turns), "conversations")
    hashed = digests(turns, decided).withColumnRenamed("conv_id", "c")
    return decided.join(hashed, F.col("conv_id").eqNullSafe(F.col("c")), "left").drop("c")
