"""Chat formatting with rotated perspectives.

For every participant of a conversation the whole dialogue is rendered once with that speaker as
the assistant and every other speaker as a named user; turns of the ``system`` role stay system
turns. The loss mask covers what the assistant says (text and closing tag) as spans of code points.

A row holds at most ``MAX_TURNS`` consecutive turn numbers: longer dialogues go on in a next part
with the same speaker. Where turn numbers repeat, a part of more than ``MAX_TURNS`` turns goes on in a
next piece, so no row gathers an unbounded conversation whatever the numbers are. The work is built-in
expressions only: one shuffle of texts, by (conversation, part), to which the distinct speakers come.

The rows of a speaker, taken by part and piece, join to the whole dialogue: a row's mask counts from its own
start, which is the length of the texts before it.

Only the format's own tags are tags. Where ``<`` is followed by bars in a text or a name, one bar is added (``<|`` becomes
``<||``), so no text reads as a tag and taking one bar away gives the text back; in names a backslash is
doubled and a line break becomes a backslash and ``n``. Spans count the text as written.

Defined results: a null text is rendered as empty, a null role is the speaker ``unknown``, a null
turn number counts as 0, equal turn numbers are ordered by role and text, repeated rows are rendered
as often as they occur. Nothing tells what a turn of null conversation id belongs to: it is a dialogue
by itself, so any number of such turns is no group. A conversation with
system turns only gives no row, an empty table no rows. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_TURNS = 256
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def plain(text: Column) -> Column:
    """Text in which nothing reads as a tag."""
    return F.regexp_replace(text, r"<(\|+)", "<|$1")


def plain_name(name: Column) -> Column:
    """A name on one line in which nothing reads as a tag."""
    return plain(F.replace(F.replace(name, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def rotate(turns: DataFrame, max_turns: int = MAX_TURNS) -> DataFrame:
    """(conv_id, part, piece, speaker, n_turns, text, mask: array of [from, to) code points, n_masked)."""
    t = turns.select(
        "conv_id", F.coalesce(F.col("turn").cast("bigint"), F.lit(0)).alias("turn"),
        F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("part", F.floor(F.col("turn") / max_turns).cast("bigint"))
    nth = F.row_number().over(Window.partitionBy("conv_id", "part").orderBy("turn", "role", "text"))
    turn = F.struct("turn", "role", "text")
    dialogue = (t.where("conv_id is not null").withColumn("piece", F.floor((nth - 1) / max_turns).cast("bigint"))
                .groupBy("conv_id", "part", "piece").agg(F.array_sort(F.collect_list(turn)).alias("turns")))
    heard = t.where("role <> 'system'")
    speakers = heard.where("conv_id is not null").select("conv_id", F.col("role").alias("speaker")).distinct()
    # the few columns of who speaks go to the parts, so that texts move once and a long conversation stays spread
    voices = t.where("conv_id is not null").select("conv_id", "part").distinct().join(speakers, "conv_id")
    alone = heard.where("conv_id is null").select(
        "conv_id", "part", F.lit(0).cast("bigint").alias("piece"), F.array(turn).alias("turns"), F.col("role").alias("speaker"))
    said = dialogue.join(voices, ["conv_id", "part"]).unionByName(alone)
    said = said.withColumn("turns", F.transform(
        "turns", lambda x: F.struct(x["turn"].alias("turn"), x["role"].alias("role"), plain(x["text"]).alias("text"))))
    said = said.withColumn("heads", F.transform("turns", lambda x: F.concat(
        F.lit(OPEN),
        F.when(x["role"] == F.col("speaker"), F.lit("assistant"))
        .when(x["role"] == "system", F.lit("system"))
        .otherwise(F.concat(F.lit("user name="), plain_name(x["role"]))), F.lit("\n"))))
    said = said.withColumn("text", F.array_join(F.transform(
        F.arrays_zip("heads", "turns"), lambda x: F.concat(x["heads"], x["turns"]["text"], F.lit(CLOSE))), ""))
    size = F.zip_with("heads", "turns", lambda h, x: F.struct(
        F.length(h).cast("bigint").alias("head"), (F.length(x["text"]) + len(CLOSE)).cast("bigint").alias("body"),
        (x["role"] == F.col("speaker")).alias("own")))
    start = F.struct(F.lit(0).cast("bigint").alias("at"),
                     F.array().cast("array<struct<from:bigint,to:bigint>>").alias("spans"))
    walked = F.aggregate(size, start, lambda acc, x: F.struct(
        (acc["at"] + x["head"] + x["body"]).alias("at"),
        F.when(x["own"], F.concat(acc["spans"], F.array(F.struct(
            (acc["at"] + x["head"]).alias("from"), (acc["at"] + x["head"] + x["body"]).alias("to")))))
        .otherwise(acc["spans"]).alias("spans")))
    return said.withColumn("mask", walked["spans"]).select(
        "conv_id", "part", "piece", "speaker", F.size("turns").cast("bigint").alias("n_turns"), "text", "mask",
        F.aggregate("mask", F.lit(0).cast("bigint"), lambda a, s: a + s["to"] - s["from"]).alias("n_masked"))


def digest(turns: DataFrame) -> DataFrame:
    """``rotate`` with the mask as text, so that rows can be compared across engines."""
    return rotate(turns).withColumn("mask", F.array_join(F.transform(
        "mask", lambda s: F.concat_ws("-", s["from"].cast("string"), s["to"].cast("string"))), ","))


ORACLE = f"""
WITH a AS (SELECT conv_id, coalesce(turn, 0) AS turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text,
    floor(coalesce(turn, 0) / {MAX_TURNS})::BIGINT AS part,
    CASE WHEN conv_id IS NULL THEN row_number() OVER () ELSE 0 END AS lone FROM conversations),
t AS (SELECT *, ((row_number() OVER (PARTITION BY conv_id, lone, part ORDER BY turn, role, text) - 1) // {MAX_TURNS})::BIGINT AS piece FROM a),
s AS (SELECT DISTINCT conv_id AS c, lone AS l, role AS speaker FROM t WHERE role <> 'system'),
p AS (SELECT t.*, speaker, role = speaker AS own, '{OPEN}' || CASE WHEN role = speaker THEN 'assistant'
    WHEN role = 'system' THEN 'system' ELSE 'user name=' || regexp_replace(replace(replace(role, '\\', '\\\\'), chr(10), '\\n'), '<(\\|+)', '<|\\1', 'g') END || chr(10) AS head,
    regexp_replace(text, '<(\\|+)', '<|\\1', 'g') AS body
  FROM t JOIN s ON t.conv_id IS NOT DISTINCT FROM s.c AND lone = l),
q AS (SELECT *, length(head) AS hl, length(body) + {len(CLOSE)} AS bl,
    sum(length(head) + length(body) + {len(CLOSE)}) OVER (PARTITION BY conv_id, lone, part, piece, speaker ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS till FROM p)
SELECT conv_id, part, piece, speaker, count(*)::BIGINT AS n_turns,
  string_agg(head || body || '<|im_end|>' || chr(10), '' ORDER BY turn, role, text) AS text,
  coalesce(string_agg((till - bl)::BIGINT::VARCHAR || '-' || till::BIGINT::VARCHAR, ',' ORDER BY turn, role, text, till) FILTER (own), '') AS mask,
  coalesce(sum(bl) FILTER (own), 0)::BIGINT AS n_masked
FROM q GROUP BY conv_id, lone, part, piece, speaker"""
