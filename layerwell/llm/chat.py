"""Multi-party perspective rotation of dialogues.

Every participant of a conversation gets the dialogue from its own point of view: its turns
are the assistant's and are trained on, all others are turns of users with a name, system turns stay
system turns. A dialogue is one row per turn with the turn's rendered text, its place in the
whole rendering, and the part of it that the loss is taken on; joined in order, the texts are the
dialogue. No row or task holds a whole conversation, so one may have any length.

Turns meet the speakers of their conversation in salted parts, and places are running sums over
ranges of (conversation, perspective, turn), so a conversation with a third of all turns is
spread over many tasks.

Defined results: a null text is an empty turn; a null speaker is called ``unknown``; a null conversation id
is a conversation of its own; null turn numbers come first; turns with one number are ordered by speaker and text, repeated
rows are repeated turns; a conversation of system turns only has no participant and no rows; an
empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerwell.llm.common import running_totals
from layerwell.session import materialize

SALTS = 64
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def perspectives(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", speaker_col: str = "role", text_col: str = "text",
    system: str = "system",
) -> DataFrame:
    """Per conversation, participant and turn: conv_id, perspective, turn, role, name, segment, start, end, mask_start, mask_end.

    ``start`` and ``end`` count code points of the whole rendering, end exclusive; the mask bounds are
    null where nothing is trained on.
    """
    rows = turns.select(
        F.col(conv_col).isNull().alias("no_conv"),
        F.coalesce(F.col(conv_col).cast("string"), F.lit("")).alias("conv"),
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(speaker_col), F.lit("unknown")).alias("name"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    ).withColumn("salt", F.pmod(F.xxhash64("turn", "text"), F.lit(SALTS)))
    speakers = rows.where(F.col("name") != system).select("no_conv", "conv", F.col("name").alias("perspective")).distinct()
    parts = rows.select("no_conv", "conv", "salt").distinct().join(speakers, ["no_conv", "conv"])
    own = F.col("name") == F.col("perspective")
    is_system = F.col("name") == system
    role = F.when(is_system, F.lit("system")).when(own, F.lit("assistant")).otherwise(F.lit("user"))
    head = F.concat(F.lit(OPEN), role, F.when(role == "user", F.concat(F.lit(" name="), F.col("name"))).otherwise(F.lit("")), F.lit("\n"))
    seen = rows.join(parts, ["no_conv", "conv", "salt"]).select(
        "no_conv", "conv", "conv_id", "perspective", "turn", role.alias("role"), "name",
        F.concat(head, F.col("text"), F.lit(CLOSE + "\n")).alias("segment"),
        F.length(head).alias("head"),
    )
    seen = seen.withColumn("size", F.length("segment").cast("long"))
    dialogue, order = ["no_conv", "conv", "perspective"], ["turn", "name", "segment"]
    ranged = seen.repartitionByRange(*dialogue, *order).withColumn("slice", F.spark_partition_id())
    placed = running_totals(materialize(ranged, "turns"), dialogue, "slice", order, "size")
    start, end = F.col("before"), F.col("before") + F.col("size")
    mine = F.col("role") == "assistant"
    return placed.select(
        "conv_id", "perspective", "turn", "role", "name", "segment", start.alias("start"), end.alias("end"),
        F.when(mine, start + F.col("head")).alias("mask_start"), F.when(mine, end - 1).alias("mask_end"),
    )


def chunks(rendered: DataFrame, size: int = 32_768) -> DataFrame:
    """Consecutive text of the dialogues: conv_id, perspective, chunk, start, text, masks (mask_start, mask_end).

    A chunk holds the turns that start within ``size`` characters, so a group is bounded by that and one turn.
    """
    turn = F.struct("start", "segment", "mask_start", "mask_end")
    grouped = rendered.groupBy("conv_id", "perspective", F.floor(F.col("start") / size).alias("chunk"))
    ordered = grouped.agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    masks = F.filter(F.transform("turns", lambda t: F.struct(t["mask_start"], t["mask_end"])), lambda m: m["mask_start"].isNotNull())
    return ordered.select(
        "conv_id", "perspective", "chunk", F.element_at("turns", 1)["start"].alias("start"),
        F.array_join(F.transform("turns", lambda t: t["segment"]), "").alias("text"), masks.alias("masks"),
    )
