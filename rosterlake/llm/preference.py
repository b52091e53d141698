"""Preference formatting: one prompt, two masked completions.

The turns that open both the chosen and the rejected conversation are rendered
once, as the prompt. What follows is rendered for each side, with the spans of
the characters that training should see: the words of the assistant and the
mark that closes them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

TURN = "array<struct<role:string,text:string>>"
# fixed values of the template
OPEN, AFTER_ROLE, CLOSE = "<|", "|>\n", "<|end|>\n"
LEARNER = "assistant"


def conversations(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """(key, turns): a conversation's turns in order, as roles and texts.

    Null roles and texts are empty; turns of one number follow by role and
    text; a null turn number comes first.
    """
    row = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"),
                   F.coalesce("text", F.lit("")).alias("text"))
    listed = turns.select(key, row.alias("t")).groupBy(key).agg(
        F.sort_array(F.collect_list("t")).alias("t"))
    return listed.select(key, F.transform("t", lambda t: F.struct(
        t["role"].alias("role"), t["text"].alias("text"))).cast(TURN).alias("turns"))


def _render(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), turn["role"], F.lit(AFTER_ROLE), turn["text"], F.lit(CLOSE))


def render(turns: Column) -> Column:
    return F.concat_ws("", F.transform(turns, _render))


def masks(turns: Column) -> Column:
    """start-stop, ... of the characters of the rendered turns to learn."""
    start = F.struct(F.lit(0).cast("long").alias("at"),
                     F.array().cast("array<string>").alias("spans"))

    def step(acc: Column, t: Column) -> Column:
        begin = acc["at"] + F.char_length(F.concat(F.lit(OPEN), t["role"], F.lit(AFTER_ROLE)))
        stop = begin + F.char_length(t["text"]) + F.lit(len(CLOSE))
        span = F.concat(begin.cast("string"), F.lit("-"), stop.cast("string"))
        return F.struct(stop.cast("long").alias("at"), F.when(
            t["role"] == LEARNER, F.concat(acc["spans"], F.array(span)))
            .otherwise(acc["spans"]).alias("spans"))
    return F.aggregate(turns, start, step, lambda acc: F.concat_ws(",", acc["spans"]))


def common_turns(a: Column, b: Column) -> Column:
    """Leading turns that are equal in both."""
    n = F.least(F.size(a), F.size(b))
    differs = F.transform(F.slice(a, F.lit(1), n), lambda t, i: ~F.coalesce(
        t == F.element_at(b, i + 1), F.lit(False)))
    at = F.array_position(differs, True)
    return F.when(at == 0, n).otherwise(at - 1).cast("int")


def format_pairs(pairs: DataFrame) -> DataFrame:
    """``pairs`` (any columns, chosen, rejected as lists of turns) rendered.

    The prompt ends before the first turn that differs. If one side only opens
    the other, its completion is empty; two equal sides have two empty
    completions; a null side is empty.
    """
    rest = [c for c in pairs.columns if c not in ("chosen", "rejected")]
    empty = F.array().cast(TURN)
    df = pairs.select(*rest, *[F.coalesce(c, empty).alias(c) for c in ("chosen", "rejected")])
    df = df.withColumn("n_common", common_turns(F.col("chosen"), F.col("rejected")))
    tail = lambda c: F.slice(c, F.col("n_common") + 1, F.size(c))
    df = df.select(*rest, "n_common",
                   F.slice("chosen", F.lit(1), F.col("n_common")).alias("opening"),
                   tail(F.col("chosen")).alias("c"), tail(F.col("rejected")).alias("r"))
    return df.select(*rest, "n_common", render(F.col("opening")).alias("prompt"),
                     render(F.col("c")).alias("chosen"), masks(F.col("c")).alias("chosen_mask"),
                     render(F.col("r")).alias("rejected"), masks(F.col("r")).alias("rejected_mask"))


def swapped_answers(turns: DataFrame) -> DataFrame:
    """(conv_id, chosen, rejected) from a plain conversation table: a rejected
    conversation ends in the last answer of the conversation numbered next, or
    in an empty one where there is none.

    A conversation without an answer is its own rejected one. Conversations
    without a number are one group and take an empty answer.
    """
    listed = conversations(turns.select("conv_id", "turn", "role", "text"))
    learned = F.transform("turns", lambda t: t["role"] == LEARNER)
    last = F.size("turns") - F.array_position(F.reverse(learned), True).cast("int") + 1
    has = F.array_contains(learned, True)
    df = listed.select("conv_id", "turns", F.when(has, last).alias("last"))
    answers = df.where("last IS NOT NULL").select(
        (F.col("conv_id") - 1).alias("conv_id"),
        F.element_at("turns", F.col("last"))["text"].alias("answer"))
    df = df.join(answers, "conv_id", "left")
    wrong = F.concat(F.slice("turns", F.lit(1), F.col("last") - 1), F.array(F.struct(
        F.lit(LEARNER).alias("role"), F.coalesce("answer", F.lit("")).alias("text"))).cast(TURN))
    return df.select("conv_id", F.col("turns").alias("chosen"),
                     F.when(F.col("last").isNotNull(), wrong).otherwise(F.col("turns"))
                     .alias("rejected"))
