"""Chat formatting by perspective rotation.

For every participant of a conversation the whole dialogue is rendered once:
that speaker as ``assistant``, everyone else as a named user, and only the
speaker's own turns marked for training. Fixed roles (the system prompt) are
no participants; they stand in every perspective unchanged.

A rendering is given as its segments, one row per perspective and turn with its
place in the whole, so a conversation of any length spreads over many tasks:
turns are grouped into blocks of neighbouring turn numbers, a window runs within a block,
and the blocks' lengths are summed apart. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
FIXED_ROLES = ("system",)
UNNAMED = "unknown"
#: Turn numbers that one window covers.
BLOCK = 256


def inert(text: Column) -> Column:
    """The text with its own control marks broken, so that it cannot open or close a turn."""
    return F.replace(text, F.lit("<|"), F.lit("< |"))


def plain_name(role: Column) -> Column:
    return F.regexp_replace(role, r"[^A-Za-z0-9_.-]", "_")


def rotate(turns: DataFrame, fixed_roles: tuple[str, ...] = FIXED_ROLES) -> DataFrame:
    """``conv_id, perspective, turn, role, segment, start, stop, train_start, train_stop`` from ``conv_id, turn, role, text``.

    Concatenating a perspective's segments by ``start`` gives its text; places
    count code points, ends are exclusive. ``train_start`` and ``train_stop``
    bound the part that counts for the loss (a turn's text and its end mark) and are
    null for the turns of others. Turns stand in the order of turn (null first),
    role and text; repeated rows are repeated turns. A null role is the speaker
    ``unknown``, a null text is empty, and rows without a conv_id form a conversation of
    their own. A conversation of fixed roles alone has no participant, hence no
    rows. Control marks within a text are broken up by a blank. Other columns
    are ignored.
    """
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(UNNAMED)).alias("role"), inert(F.coalesce("text", F.lit(""))).alias("body"))
    fixed = F.col("role").isin(*fixed_roles)
    speakers = rows.where(~fixed).select(F.col("conv_id").alias("of"), F.col("role").alias("perspective")).distinct()
    seen = rows.join(speakers, F.col("conv_id").eqNullSafe(F.col("of"))).drop("of")
    own = F.col("role") == F.col("perspective")
    header = F.concat(F.lit(START), F.when(own, "assistant").when(fixed, F.col("role")).otherwise(F.concat(F.lit("user name="), plain_name(F.col("role")))), F.lit("\n"))
    seen = seen.select(
        "conv_id",
        "perspective",
        "turn",
        "role",
        "body",
        own.alias("own"),
        F.char_length(header).alias("head"),
        F.concat(header, "body", F.lit(END + "\n")).alias("segment"),
        F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-(2**62))).alias("block"),
    ).withColumn("size", F.char_length("segment").cast("long"))
    sizes = seen.groupBy("conv_id", "perspective", "block").agg(F.sum("size").alias("all"))
    earlier = Window.partitionBy("conv_id", "perspective").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(F.col("conv_id").alias("c"), F.col("perspective").alias("p"), F.col("block").alias("b"), F.coalesce(F.sum("all").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("conv_id", "perspective", "block").orderBy(F.asc_nulls_first("turn"), "role", "body").rowsBetween(Window.unboundedPreceding, -1)
    placed = seen.withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    placed = placed.join(before, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("perspective") == F.col("p")) & (F.col("block") == F.col("b")))
    start = F.col("before") + F.col("within")
    stop = start + F.col("size")
    return placed.select(
        "conv_id",
        "perspective",
        "turn",
        "role",
        "segment",
        start.alias("start"),
        stop.alias("stop"),
        F.when(F.col("own"), start + F.col("head")).alias("train_start"),
        F.when(F.col("own"), stop - 1).alias("train_stop"),
    )
