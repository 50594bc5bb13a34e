"""Preference formatting, in DataFrame functions only.

A pair is a chosen and a rejected conversation in long form: one row per turn.
Both sides are counted per (pair, turn, role, text); the first turn where the
counts differ is the fork.  What stands before it is the longest common turn
prefix and is rendered once, as prompt; the rest of each side is rendered as its
completion, with the spans of assistant text that a loss should count.

Every step is a partial aggregate or a join on the pair; a conversation of any
length is rendered ``CHUNK`` turn numbers a row, so none is collected whole."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwright.llm.shared import query, table

#: Turn numbers that one output row covers.
CHUNK = 256
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def _turns(df: DataFrame, key: str) -> DataFrame:
    """Null turn numbers come first, null roles are ``unknown``, null texts
    are empty; marks that would pass for a turn's ends are defused."""
    return df.where(F.col(key).isNotNull()).select(
        F.col(key).cast("bigint").alias("pair_id"), F.coalesce(F.col("turn").cast("bigint"), F.lit(-1)).alias("turn"),
        F.coalesce("role", F.lit("unknown")).alias("role"),
        F.replace(F.coalesce("text", F.lit("")), F.lit("<|"), F.lit("< |")).alias("text"))


def _side(parts: Column, name: str) -> Column:
    return F.filter(parts, lambda p: p["part"] == name)


def _head(p: Column) -> Column:
    return F.concat(F.lit(OPEN), p["role"], F.lit("\n"))


def _rendered(parts: Column) -> Column:
    return F.array_join(F.transform(parts, lambda p: F.concat(
        _head(p), p["text"], F.lit(CLOSE + "\n"))), "")


def _masked(parts: Column) -> Column:
    """start:end of the assistant texts, each with its closing mark, in code
    points of the rendered side."""
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))

    def step(acc, p):
        start = acc["at"] + F.length(_head(p))
        end = start + F.length(p["text"]) + len(CLOSE)
        span = F.concat_ws(":", start.cast("string"), end.cast("string"))
        return F.struct((end + 1).alias("at"), F.when(p["role"] == "assistant", F.array_append(acc["spans"], span))
                        .otherwise(acc["spans"]).alias("spans"))
    return F.aggregate(parts, zero, step, lambda acc: F.array_join(acc["spans"], ","))


def format_pairs(chosen: DataFrame, rejected: DataFrame, key: str = "pair_id", chunk: int = CHUNK) -> DataFrame:
    """Format pairs given in long form: both frames have the pair's key, turn
    (number), role and text.

    One row per pair and ``chunk`` turn numbers: pair_id, chunk, fork (turn at
    which the sides part; null if they never do), n_prompt (turns of the common
    prefix in this row), prompt, chosen and rejected (rendered texts),
    chosen_mask and rejected_mask (spans ``start:end`` in code points, comma
    joined).  A side that is missing or ends at the fork is an empty text.
    Rows that tie at one turn number belong together, ordered by role and text;
    repeated rows stay repeated.  Turns without a key are ignored; an empty
    table gives an empty one; extra columns are ignored."""
    both = (_turns(chosen, key).withColumns({"c": F.lit(1), "r": F.lit(0)})
            .unionAll(_turns(rejected, key).withColumns({"c": F.lit(0), "r": F.lit(1)})))
    cells = both.groupBy("pair_id", "turn", "role", "text").agg(F.sum("c").alias("c"), F.sum("r").alias("r"))
    forks = cells.groupBy("pair_id").agg(F.min(F.when(F.col("c") != F.col("r"), F.col("turn"))).alias("fork"))
    placed = cells.join(forks, "pair_id")
    shared = F.col("fork").isNull() | (F.col("turn") < F.col("fork"))
    part = lambda name, n: F.array_repeat(F.lit(name), n.cast("int"))
    placed = placed.withColumn("part", F.explode(F.when(shared, part("prompt", F.col("c"))).otherwise(
        F.concat(part("chosen", F.col("c")), part("rejected", F.col("r"))))))
    rows = (placed.groupBy("pair_id", F.floor(F.col("turn") / chunk).cast("bigint").alias("chunk"))
            .agg(F.first("fork").alias("fork"),
                 F.array_sort(F.collect_list(F.struct("turn", "role", "text", "part"))).alias("parts")))
    side = {n: _side(F.col("parts"), n) for n in ("prompt", "chosen", "rejected")}
    return rows.select(
        "pair_id", "chunk", "fork", F.size(side["prompt"]).cast("bigint").alias("n_prompt"),
        *[_rendered(side[n]).alias(n) for n in side],
        _masked(side["chosen"]).alias("chosen_mask"), _masked(side["rejected"]).alias("rejected_mask"))


def answer_pairs(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chosen and rejected sides from one table of conversations (conv_id,
    turn, role, text): a conversation up to its last assistant turn is chosen;
    the same turns with the last answer of the neighbouring conversation (ids
    2k and 2k+1) in its place are rejected.  Without a neighbour the rejected
    side ends before the answer; conversations without an answer make no pair."""
    t = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("pair_id"), F.coalesce(F.col("turn").cast("bigint"), F.lit(-1)).alias("turn"),
        "role", "text")
    last = t.where("role = 'assistant'").groupBy("pair_id").agg(F.max("turn").alias("last"))
    own = t.join(last, "pair_id").where("turn <= last")
    answers = own.where("turn = last and role = 'assistant'").select(
        F.col("pair_id").bitwiseXOR(F.lit(1).cast("bigint")).alias("pair_id"), "role", "text")
    other = answers.join(last, "pair_id").select("pair_id", F.col("last").alias("turn"), "role", "text")
    cols = ["pair_id", "turn", "role", "text"]
    return own.select(*cols), own.where("turn < last").select(*cols).unionByName(other.select(*cols))


OP9_SQL = f"""
WITH t AS (SELECT conv_id AS pair_id, coalesce(turn, -1) AS turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
last AS (SELECT pair_id, max(turn) AS last FROM t WHERE role = 'assistant' GROUP BY pair_id),
own AS (SELECT t.*, last.last FROM t JOIN last USING (pair_id) WHERE turn <= last.last),
sides AS (
  SELECT pair_id, turn, role, text, 1 AS c, 0 AS r FROM own
  UNION ALL SELECT pair_id, turn, role, text, 0, 1 FROM own WHERE turn < own.last
  UNION ALL SELECT l.pair_id, l.last, o.role, o.text, 0, 1 FROM own o JOIN last l ON l.pair_id = xor(o.pair_id, 1)
            WHERE o.turn = o.last AND o.role = 'assistant'),
cells AS (
  SELECT pair_id, turn, coalesce(role, 'unknown') AS role, replace(coalesce(text, ''), '<|', '< |') AS text,
         sum(c) AS c, sum(r) AS r FROM sides GROUP BY ALL),
forks AS (SELECT pair_id, min(CASE WHEN c <> r THEN turn END) AS fork FROM cells GROUP BY pair_id),
parts AS (
  SELECT *, unnest(CASE WHEN fork IS NULL OR turn < fork THEN repeat(['prompt'], c::BIGINT)
                        ELSE list_concat(repeat(['chosen'], c::BIGINT),
                                         repeat(['rejected'], r::BIGINT)) END) AS part
  FROM cells JOIN forks USING (pair_id)),
pieces AS (
  SELECT pair_id, fork, turn // {CHUNK} - CASE WHEN turn < 0 THEN 1 ELSE 0 END AS chunk, part, turn, role, text,
         '{OPEN}' || role || chr(10) AS head, row_number() OVER () AS n FROM parts),
placed AS (
  SELECT *, length(head) + length(text) + {len(CLOSE) + 1} AS size,
         sum(length(head) + length(text) + {len(CLOSE) + 1}) OVER (
           PARTITION BY pair_id, chunk, part ORDER BY turn, role, text, n) AS upto FROM pieces)
SELECT pair_id, chunk, any_value(fork) AS fork, count(*) FILTER (part = 'prompt') AS n_prompt,
  coalesce(string_agg(head || text || '{CLOSE}' || chr(10), '' ORDER BY turn, role, text) FILTER (part = 'prompt'), '') AS prompt,
  coalesce(string_agg(head || text || '{CLOSE}' || chr(10), '' ORDER BY turn, role, text) FILTER (part = 'chosen'), '') AS chosen,
  coalesce(string_agg(head || text || '{CLOSE}' || chr(10), '' ORDER BY turn, role, text) FILTER (part = 'rejected'), '') AS rejected,
  coalesce(string_agg((upto - size + length(head))::BIGINT || ':' || (upto - 1)::BIGINT, ',' ORDER BY upto)
           FILTER (part = 'chosen' AND role = 'assistant'), '') AS chosen_mask,
  coalesce(string_agg((upto - size + length(head))::BIGINT || ':' || (upto - 1)::BIGINT, ',' ORDER BY upto)
           FILTER (part = 'rejected' AND role = 'assistant'), '') AS rejected_mask
FROM placed GROUP BY pair_id, chunk
"""


@query("op9_preference_formatting", OP9_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_pairs(*answer_pairs(table(spark, sf_dir, "conversations")))
