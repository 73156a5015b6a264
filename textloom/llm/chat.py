"""Multi-party dialogues rendered once from the view of every participant."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
SYSTEM = "system"
# Turns that one output row holds; a longer dialogue goes on in the next part.
PART_TURNS = 1000


def _plain(text: Column) -> Column:
    """Text in which no marker can be read."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))


def numbered_turns(turns: DataFrame, speaker: str = "role", part_turns: int = PART_TURNS) -> DataFrame:
    """``conv_id, position, part, speaker, text`` of all turns, each conversation in order.

    Turns are counted in blocks of their turn number, and blocks added up, so a long conversation is
    numbered by many tasks.
    """
    rows = turns.select("conv_id", "turn", F.col(speaker).cast("string").alias("speaker"), "text").distinct()
    rows = rows.withColumn("block", F.floor(F.col("turn") / F.lit(part_turns)))
    sizes = rows.groupBy("conv_id", "block").agg(F.count(F.lit(1)).alias("n"))
    earlier = F.sum("n").over(Window.partitionBy("conv_id").orderBy("block")) - F.col("n")
    bases = sizes.select(
        F.col("conv_id").alias("_conv"), F.col("block").alias("_block"), earlier.alias("base")
    )
    inside = Window.partitionBy("conv_id", "block").orderBy("turn", "speaker", "text")
    placed = rows.withColumn("place", F.row_number().over(inside)).join(
        bases, F.col("conv_id").eqNullSafe(F.col("_conv")) & F.col("block").eqNullSafe(F.col("_block"))
    )
    placed = placed.withColumn("position", F.col("base") + F.col("place") - 1)
    part = F.floor(F.col("position") / F.lit(part_turns))
    return placed.select("conv_id", "position", part.alias("part"), "speaker", "text")


def perspective_turns(turns: DataFrame, speaker: str = "role", part_turns: int = PART_TURNS) -> DataFrame:
    """Every turn as each participant sees it.

    ``conv_id, perspective, part, position, header, body, own``: the participant's own turns are the
    assistant's, all others a user's with the speaker's name; system turns stay system turns.
    """
    numbered = numbered_turns(turns, speaker, part_turns)
    people = turns.select("conv_id", F.col(speaker).cast("string").alias("perspective"))
    people = people.where(F.col("perspective").isNotNull() & (F.col("perspective") != SYSTEM)).distinct()
    people = people.withColumnRenamed("conv_id", "_conv")
    seen = numbered.join(people, F.col("conv_id").eqNullSafe(F.col("_conv")))
    own = F.coalesce(F.col("speaker") == F.col("perspective"), F.lit(False))
    name = F.regexp_replace(_plain(F.coalesce("speaker", F.lit("unknown"))), r"\s", "_")
    role = (
        F.when(own, F.lit("assistant"))
        .when(F.col("speaker") == SYSTEM, F.lit(SYSTEM))
        .otherwise(F.concat(F.lit("user name="), name))
    )
    return seen.select(
        "conv_id",
        "perspective",
        "part",
        "position",
        F.concat(F.lit(START), role, F.lit("\n")).alias("header"),
        F.concat(_plain(F.col("text")), F.lit(END)).alias("body"),
        own.alias("own"),
    )


def rotated_dialogues(turns: DataFrame, speaker: str = "role", part_turns: int = PART_TURNS) -> DataFrame:
    """``conv_id, perspective, part, n_turns, text, mask`` for every participant of every conversation.

    ``text`` is the dialogue with that participant as assistant; ``mask`` lists the character ranges
    (``first`` included, ``last`` not) that are trained on: the participant's own words with their end
    marker, the line end behind it not. Ranges count from the start of the row's text. A dialogue of
    more than ``part_turns`` turns goes on in the next ``part``, so no row grows with its conversation.

    Edge cases: a turn that is repeated in all of conversation, number, speaker and text counts once; turns of
    one number follow by speaker and text; a null text is empty; a null speaker is the user "unknown" and
    no participant; system turns never are; a conversation without participants has no rows; a null
    ``conv_id`` is a conversation; marker openings inside texts and names are broken by a blank; an empty
    table gives no rows; other columns are ignored.
    """
    seen = perspective_turns(turns, speaker, part_turns)
    length = F.char_length("header") + F.char_length("body") + 1
    row = Window.partitionBy("conv_id", "perspective", "part").orderBy("position")
    last = F.sum(length).over(row)
    first = last - 1 - F.char_length("body")
    segment = F.concat("header", "body", F.lit("\n"))
    placed = seen.select(
        "conv_id", "perspective", "part", "position", "own", segment.alias("segment"),
        first.alias("first"), (last - 1).alias("last"),
    )
    span = F.when(F.col("own"), F.struct("first", "last"))
    return placed.groupBy("conv_id", "perspective", "part").agg(
        F.count(F.lit(1)).alias("n_turns"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("position", "segment"))), lambda x: x["segment"]), "").alias("text"),
        F.sort_array(F.collect_list(span)).alias("mask"),
    )


def mask_string(mask: Column) -> Column:
    """Ranges as ``first-last`` joined by commas."""
    return F.array_join(F.transform(mask, lambda m: F.concat_ws("-", m["first"], m["last"])), ",")
