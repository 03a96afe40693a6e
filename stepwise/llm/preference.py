"""Preference pairs: one shared prompt and two completions with loss spans, in built-in functions only.

A pair is two conversations, chosen and rejected. Turns are taken in order; the longest
prefix of equal turns (role and text) is rendered once as the prompt, the rest of each side
is its completion. Only turns of the assistant are trained on; ``*_spans`` holds their
character ranges ``[start, stop)`` in the completion.

Defined cases: a null text is empty and a null role is ``user``; turns with equal numbers
are ordered by role and text, repeated turns stay; a null turn number comes first; turns
without a pair id belong to no pair and are left out; a side without turns has an empty
completion; equal conversations give two empty completions. Other columns are ignored.

A table without pairs gets them from :func:`spliced`: another conversation takes over after
a number of turns that a hash of the id draws.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TRAINED = "assistant"
#: Ids of a block are consecutive numbers; a partner comes from the same block.
BLOCK = 1024


def turns(df: DataFrame, pair: str, turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Conversation rows in the columns the formatter reads."""
    return df.where(F.col(pair).isNotNull()).select(
        F.col(pair).alias("pair_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("user")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )


def spliced(chosen: DataFrame) -> DataFrame:
    """Rejected sides for conversations that have none, from :func:`turns` in its columns.

    Of a conversation of n turns the first s stay, s from 0 to n - 1 by the MD5 of the id. The
    turns after the first s of its partner follow; that is the next id that exists in the same
    block of 1024 ids, for the last one the first. A partner with s turns or fewer adds none,
    nor does a conversation alone in its block. Every conversation is the partner of one, so no
    group grows, and the turn numbers of the result are positions.
    """
    at = Window.partitionBy("pair_id").orderBy("turn", "role", "text")
    placed = chosen.select("pair_id", F.row_number().over(at).alias("turn"), "role", "text")
    block = F.floor(F.col("pair_id") / BLOCK)
    following = F.lead("pair_id").over(Window.partitionBy(block).orderBy("pair_id"))
    drawn = F.conv(F.substring(F.md5(F.col("pair_id").cast("string")), 1, 4), 16, 10).cast("long")
    plan = chosen.groupBy("pair_id").agg(F.count(F.lit(1)).alias("n")).select(
        "pair_id",
        (drawn % F.col("n")).alias("kept"),
        F.coalesce(following, F.min("pair_id").over(Window.partitionBy(block))).alias("partner"),
    )
    head = placed.join(plan.select("pair_id", "kept"), "pair_id").where("turn <= kept")
    others = plan.where("partner <> pair_id").select(F.col("pair_id").alias("owner"), "kept", F.col("partner").alias("pair_id"))
    tail = placed.join(others, "pair_id").where("turn > kept")
    columns = ["turn", "role", "text"]
    return head.select("pair_id", *columns).unionByName(tail.select(F.col("owner").alias("pair_id"), *columns))


def render(turn: Column) -> Column:
    """``<|role|>``, a line break, the text, ``<|end|>``, a line break."""
    return F.concat(F.lit("<|"), turn["role"], F.lit("|>\n"), turn["text"], F.lit("<|end|>\n"))


def _join(parts: Column) -> Column:
    return F.array_join(F.transform(parts, render), "")


def _spans(parts: Column) -> Column:
    """Ranges of what is trained: the text and end mark of the assistant's turns."""
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,stop:int>>").alias("spans"))

    def step(state, turn):
        body = state["at"] + F.length(turn["role"]) + F.lit(5)
        stop = state["at"] + F.length(render(turn))
        span = F.array(F.struct(body.cast("int").alias("start"), (stop - F.lit(1)).cast("int").alias("stop")))
        return F.struct(
            stop.cast("int").alias("at"),
            F.when(turn["role"] == TRAINED, F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"),
        )

    return F.aggregate(parts, zero, step, lambda s: s["spans"])


def format_preferences(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """One row per pair id of either side.

    Returns pair_id, prompt_turns, prompt, chosen, rejected, chosen_spans, rejected_spans.
    Both inputs come from :func:`turns`. One shuffle on the pair id gathers the turns, which
    are together in the output row anyway.
    """
    both = chosen.withColumn("side", F.lit(0)).unionByName(rejected.withColumn("side", F.lit(1)))
    one = F.struct("turn", "role", "text")
    sides = both.groupBy("pair_id").agg(
        *(F.sort_array(F.collect_list(F.when(F.col("side") == i, one))).alias(n) for i, n in enumerate(("c", "r")))
    )
    n = F.least(F.size("c"), F.size("r"))
    same = F.zip_with(
        F.slice("c", F.lit(1), n), F.slice("r", F.lit(1), n), lambda a, b: (a["role"] == b["role"]) & (a["text"] == b["text"])
    )
    first_other = F.array_position(same, F.lit(False)).cast("int")
    prefix = sides.withColumn("prompt_turns", F.when(first_other > 0, first_other - 1).otherwise(n))
    rest = {s: F.slice(s, F.col("prompt_turns") + 1, F.greatest(F.size(s), F.lit(1))) for s in ("c", "r")}
    return prefix.select(
        "pair_id",
        "prompt_turns",
        _join(F.slice("c", F.lit(1), F.col("prompt_turns"))).alias("prompt"),
        _join(rest["c"]).alias("chosen"),
        _join(rest["r"]).alias("rejected"),
        _spans(rest["c"]).alias("chosen_spans"),
        _spans(rest["r"]).alias("rejected_spans"),
    )
