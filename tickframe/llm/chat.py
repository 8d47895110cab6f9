"""Preference formatting: pairs of conversations as one prompt and two masked completions.

Runs on DataFrame functions alone.  The prompt is the longest common turn prefix
of the chosen and the rejected conversation, rendered once; the turns after it
are rendered as the two completions, each with the character spans that a loss
should count: the texts and end marks of its assistant turns.

Cases: a null role or text is empty; turns are ordered by number (nulls last),
then role and text, so repeated and tied turns have one order; two equal
conversations are all prompt with empty completions; a conversation without an
assistant turn makes no pair; rows with a null conversation id belong to no
conversation and make no pair; an empty table makes no pairs; further columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickframe.llm.arrays import with_running
from tickframe.llm.blocks import stored

HEAD, BREAK, END = "<|", "|>\n", "<|end|>\n"
TURNS = "array<struct<role: string, text: string>>"


def conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): each conversation's turns in order, one row each."""
    one = F.struct(F.col("turn").isNull().alias("late"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return turns.filter("conv_id is not null").select("conv_id", one.alias("t")).groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t")) \
        .select("conv_id", F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def with_previous(ids: DataFrame) -> DataFrame:
    """(conv_id, previous): each of the distinct ids and the largest below it (none: null).

    Ids are ordered within ranges; the first of a range gets the last of the
    range before it, from a table of one row per range.
    """
    ranged = stored(ids.repartitionByRange("conv_id").select("conv_id", F.spark_partition_id().alias("part")))
    ends = ranged.groupBy("part").agg(F.max("conv_id").alias("top")) \
        .select("part", F.lag("top").over(Window.orderBy("part")).alias("before"))
    within = F.lag("conv_id").over(Window.partitionBy("part").orderBy("conv_id"))
    return ranged.withColumn("below", within).join(ends, "part").select("conv_id", F.coalesce("below", "before").alias("previous"))


def preference_pairs(turns: DataFrame) -> DataFrame:
    """(pair_id, chosen, rejected): a conversation up to its last assistant turn, and the same with that turn
    replaced by the last assistant turn of the next conversation that has one, by id (none: without it)."""
    whole = conversations(turns)
    last = F.array_max(F.transform("turns", lambda t, i: F.when(t["role"] == "assistant", i + 1)))
    chosen = whole.withColumn("n", last).filter("n is not null").select("conv_id", "n", F.slice("turns", 1, F.col("n")).alias("chosen"))
    neighbours = with_previous(turns.filter("role = 'assistant' and conv_id is not null").select("conv_id").distinct())
    other = chosen.join(neighbours, "conv_id").filter("previous is not null") \
        .select(F.col("previous").alias("conv_id"), F.element_at("chosen", -1).alias("swap"))
    return chosen.join(other, "conv_id", "left").select(
        F.col("conv_id").alias("pair_id"), "chosen",
        F.concat(F.slice("chosen", F.lit(1), F.col("n") - 1), F.when(F.col("swap").isNull(), F.array().cast(TURNS)).otherwise(F.array("swap"))).alias("rejected"))


def _rendered(turn: Column) -> Column:
    return F.concat(F.lit(HEAD), turn["role"], F.lit(BREAK), turn["text"], F.lit(END))


def format_pairs(pairs: DataFrame) -> DataFrame:
    """Per pair: prompt_turns, prompt, chosen, rejected, and the masks as arrays of (start, end)."""
    both = F.least(F.size("chosen"), F.size("rejected"))
    differ = F.transform(F.when(both > 0, F.sequence(F.lit(1), both)).otherwise(F.array().cast("array<int>")),
                         lambda i: F.element_at("chosen", i).eqNullSafe(F.element_at("rejected", i)))
    at = F.array_position(differ, False)
    df = pairs.select("pair_id", "chosen", "rejected").withColumn("prompt_turns", F.when(at > 0, at - 1).otherwise(both).cast("int"))
    df = df.withColumn("prompt", F.concat_ws("", F.transform(F.slice("chosen", F.lit(1), F.col("prompt_turns")), _rendered)))
    for side in ("chosen", "rejected"):
        df = df.withColumn("_t", F.slice(side, F.col("prompt_turns") + 1, F.size(side)))
        df = df.withColumn("_r", F.transform("_t", _rendered)).withColumn("_n", F.transform("_r", lambda r: F.length(r).cast("long")))
        df = with_running(df, "_n", "_s")
        head = F.transform("_t", lambda t, i: F.struct(
            t["role"].alias("role"), (F.element_at("_s", i + 1) + F.length(t["role"]) + len(HEAD + BREAK)).alias("start"),
            (F.element_at("_s", i + 1) + F.element_at("_n", i + 1)).alias("end")))
        mask = F.transform(F.filter(head, lambda x: x["role"] == "assistant"), lambda x: F.struct(x["start"], x["end"]))
        df = df.withColumn(f"{side}_mask", mask).withColumn(side, F.concat_ws("", "_r")).drop("_t", "_r", "_n", "_s")
    return df
