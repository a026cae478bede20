"""Chat formatting: the dialogue from every participant's side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.session import materialize

START, END = "<|im_start|>", "<|im_end|>"


def numbered_turns(turns: DataFrame, conv: str, turn: str) -> DataFrame:
    """Adds ``__at``: the place of a message in its conversation, from 0, by turn (null last), role and
    text.  Ranges of (conversation, turn) are numbered apart and then shifted, so that a conversation
    that holds much of the table is spread over tasks."""
    order = [F.col(turn).asc_nulls_last(), F.col("role").asc_nulls_last(), F.col("text").asc_nulls_last()]
    ranged = materialize(
        turns.repartitionByRange(F.col(conv).asc_nulls_last(), *order).withColumn("__part", F.spark_partition_id())
        .withColumn("__in", F.row_number().over(Window.partitionBy("__part", conv).orderBy(*order))), "turns")
    before = ranged.groupBy(conv, "__part").agg(F.count(F.lit(1)).alias("__n"))
    before = before.withColumn("__before", F.sum("__n").over(Window.partitionBy(conv).orderBy("__part")) - F.col("__n"))
    before = before.select(F.col(conv).alias("__conv"), F.col("__part").alias("__p"), "__before")
    return (ranged.join(before, (F.col("__part") == F.col("__p")) & F.col(conv).eqNullSafe(F.col("__conv")))
            .withColumn("__at", F.col("__before") + F.col("__in") - 1)
            .drop("__part", "__in", "__before", "__conv", "__p"))


def rotate_perspectives(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                        text: str = "text", segment_turns: int = 512) -> DataFrame:
    """One row for each participant of a conversation and each ``segment_turns`` messages of it:
    conversation, participant, segment, n_turns, n_chars, n_masked, rendered and mask.

    Participants are all distinct roles but ``system``.  In a participant's rendering its own messages
    are the assistant's, ``system`` stays system, and all others are users with their role as name.
    ``mask`` lists [start, end) in characters of ``rendered`` to train on: the participant's own words
    and the end marks after them.  A conversation of up to ``segment_turns`` messages is one row;
    the segments of a longer one follow each other and joined are the whole dialogue, so no task or
    row grows with a conversation.

    A null role is the participant ``unknown``; a null text is an empty message; ``<|`` in texts and
    names becomes ``< |`` so that no text can forge a mark.  Messages are ordered by turn (null last), then
    role and text; repeated rows are repeated messages.  A null conversation id is a conversation.
    Conversations of system messages alone have no participant and give no row.  Extra columns are
    left out.
    """
    plain = lambda c: F.replace(c, F.lit("<|"), F.lit("< |"))
    rows = turns.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"),
                        plain(F.coalesce(F.col(role).cast("string"), F.lit("unknown"))).alias("role"),
                        plain(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("text"))
    numbered = numbered_turns(rows, "conv", "turn")
    speakers = (rows.filter("role != 'system'").groupBy("conv", "role").agg(F.lit(1).alias("one"))
                .select(F.col("conv").alias("__conv"), F.col("role").alias("participant")))
    views = numbered.join(speakers, F.col("conv").eqNullSafe(F.col("__conv"))).drop("__conv")
    own = F.col("role") == F.col("participant")
    head = F.when(own, F.lit("assistant")).when(F.col("role") == "system", F.lit("system")) \
            .otherwise(F.concat(F.lit("user name="), F.col("role")))
    views = views.select(
        "conv", "participant", F.floor(F.col("__at") / segment_turns).cast("long").alias("segment"), "__at",
        own.alias("own"), F.concat(F.lit(START), head, F.lit("\n")).alias("head"), "text")
    size = F.length("head") + F.length("text") + F.lit(len(END) + 1)
    order = Window.partitionBy("conv", "participant", "segment").orderBy("__at")
    views = views.withColumn("__from", F.sum(size).over(order) - size + F.length("head"))
    message = F.struct(
        F.col("__at").alias("at"), F.concat("head", "text", F.lit(END + "\n")).alias("shown"), F.col("own").alias("own"),
        F.col("__from").alias("start"), (F.col("__from") + F.length("text") + F.lit(len(END))).alias("end"))
    grouped = views.groupBy("conv", "participant", "segment").agg(F.sort_array(F.collect_list(message)).alias("m"))
    out = grouped.select(
        F.col("conv").alias(conv), "participant", "segment", F.size("m").cast("long").alias("n_turns"),
        F.array_join(F.transform("m", lambda x: x["shown"]), "").alias("rendered"),
        F.transform(F.filter("m", lambda x: x["own"]), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))).alias("mask"))
    return out.withColumn("n_chars", F.length("rendered").cast("long")).withColumn(
        "n_masked", F.aggregate("mask", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"]))
