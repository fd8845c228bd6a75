"""Operator 3: preference formatting of chosen and rejected conversations, in DataFrame functions alone.

The longest common prefix of turns (same place, role and text) is rendered once as prompt; what
follows is rendered as the chosen and the rejected completion, each with a mask: the spans of the
assistant's own text, on which a loss is taken.

The first turn that differs is a minimum over turns, so finding it gathers no conversation. A
segment comes out in parts of PART turn numbers with the place where each part starts; a conversation of any
length is never one group.

Null roles and texts count as empty ones and equal each other. Turns are ordered by number, then role and text; rows that
repeat within one side count once, and rows without a pair or a turn are left out. A side without
turns after the prompt has no completion row, an empty prompt no prompt row. Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PART = 512
OPEN, CLOSE, END = "<|", "|>\n", "<|end|>\n"


def rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), role, F.lit(CLOSE), text, F.lit(END))


def preference_pairs(chosen: DataFrame, rejected: DataFrame, learn_from: str = "assistant", part: int = PART) -> DataFrame:
    """(pair_id, segment, part, start, text, mask) of chosen and rejected (pair_id, turn, role, text).

    `segment` is prompt, chosen or rejected; `start` is where the part begins in its segment;
    `mask` is the list of (start, end) in the part, ends exclusive, that a loss is taken on.
    """

    def turns(side: DataFrame, name: str) -> DataFrame:
        return side.where("pair_id IS NOT NULL AND turn IS NOT NULL").select(
            "pair_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), F.lit(name).alias("side")
        )

    both = turns(chosen, "chosen").unionByName(turns(rejected, "rejected"))
    # One row per side and text: the sides agree on a turn if each of its rows is on both.
    lines = both.groupBy("pair_id", "turn", "role", "text").agg(F.max(F.col("side") == "chosen").alias("on_chosen"), F.max(F.col("side") == "rejected").alias("on_rejected"))
    fork = lines.where("NOT (on_chosen AND on_rejected)").groupBy("pair_id").agg(F.min("turn").alias("fork"))
    split = lines.join(fork, "pair_id", "left").withColumn("shared", F.coalesce(F.col("turn") < F.col("fork"), F.lit(True)))
    segment = F.when(F.col("shared"), F.array(F.lit("prompt"))).otherwise(
        F.filter(F.array(F.when(F.col("on_chosen"), "chosen"), F.when(F.col("on_rejected"), "rejected")), lambda s: s.isNotNull())
    )
    placed = split.select("pair_id", F.explode(segment).alias("segment"), F.floor(F.col("turn") / part).alias("part"), "turn", "role", "text")
    line = F.struct("turn", "role", "text")
    parts = placed.groupBy("pair_id", "segment", "part").agg(F.array_sort(F.collect_list(line)).alias("lines"))
    whole = F.array_join(F.transform("lines", lambda x: rendered(x.role, x.text)), "")
    head = F.length(F.lit(OPEN)) + F.length(F.lit(CLOSE))
    empty = F.array().cast("array<struct<start: int, end: int>>")
    # A fold over the part's turns: the place reached and the spans so far.
    folded = F.aggregate(
        F.col("lines"),
        F.struct(F.lit(0).alias("at"), empty.alias("spans")),
        lambda acc, x: F.struct(
            (acc.at + F.length(rendered(x.role, x.text))).alias("at"),
            F.when(
                x.role == learn_from,
                F.concat(acc.spans, F.array(F.struct((acc.at + head + F.length(x.role)).alias("start"), (acc.at + head + F.length(x.role) + F.length(x.text)).alias("end")))),
            )
            .otherwise(acc.spans)
            .alias("spans"),
        ),
        lambda acc: acc.spans,
    )
    mask = F.when(F.col("segment") == "prompt", empty).otherwise(folded)
    out = parts.select("pair_id", "segment", "part", whole.alias("text"), mask.alias("mask"))
    before = Window.partitionBy("pair_id", "segment").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("text").cast("long")).over(before), F.lit(0))
    return out.withColumn("start", start).select("pair_id", "segment", "part", "start", "text", "mask")
