"""Collapse of cumulative snapshots, then chat rendering.

A log often holds a conversation once per turn, each time a little longer. For every turn a digest of
the conversation up to it is kept rolling: the exclusive or of digests of (place, role, text), which
can be summed piece by piece. A conversation whose whole digest is that of a shorter prefix of another
one is dropped by an anti-join; of equal conversations the smallest id stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed marks of the rendered format.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def turns_in_order(turns: DataFrame, chunk: int = 4096) -> DataFrame:
    """`(conv_id, place, n, d1, d2, role, text)`: place from 1, n turns in all, rolling digests d1, d2.

    Turns are ordered by turn number, then role and text, nulls first. To keep windows small when one
    conversation has very many turns, places and digests run inside chunks of turn numbers, and the
    totals of the chunks before are added.
    """
    rows = turns.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).where("conv_id IS NOT NULL")
    rows = rows.withColumn("chunk", F.coalesce(F.floor(F.col("turn") / chunk), F.lit(-(1 << 62))).cast("long"))
    inside = Window.partitionBy("conv_id", "chunk").orderBy("turn", "role", "text")
    counts = rows.groupBy("conv_id", "chunk").agg(F.count("*").alias("in_chunk"))
    earlier = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy("conv_id")
    starts = counts.select(
        "conv_id",
        "chunk",
        F.coalesce(F.sum("in_chunk").over(earlier), F.lit(0)).alias("before"),
        F.sum("in_chunk").over(every).alias("n"),
    )
    placed = (
        rows.withColumn("nth", F.row_number().over(inside).cast("long"))
        .join(starts, ["conv_id", "chunk"])
        .withColumn("place", F.col("before") + F.col("nth"))
    )
    digest = lambda salt: F.xxhash64(F.lit(salt), "place", "role", "text")
    running = inside.rowsBetween(Window.unboundedPreceding, 0)
    placed = placed.withColumns({f"r{i}": F.bit_xor(digest(i)).over(running) for i in (1, 2)})
    whole = (
        placed.groupBy("conv_id", "chunk")
        .agg(*(F.bit_xor(digest(i)).alias(f"x{i}") for i in (1, 2)))
        .select(
            "conv_id",
            "chunk",
            *(F.coalesce(F.bit_xor(f"x{i}").over(earlier), F.lit(0)).alias(f"x{i}") for i in (1, 2)),
        )
    )
    return placed.join(whole, ["conv_id", "chunk"]).select(
        "conv_id",
        "place",
        "n",
        *(F.col(f"r{i}").bitwiseXOR(F.col(f"x{i}")).alias(f"d{i}") for i in (1, 2)),
        "role",
        "text",
    )


def maximal(ordered: DataFrame) -> DataFrame:
    """`(conv_id, n, n_same)` of conversations that are no proper prefix of another.

    n_same is how many equal conversations the row stands for. Both sides of the anti-join are reduced
    to one row per digest first, so common first turns or conversations move no more than others.
    """
    prefixes = (
        ordered.groupBy(F.col("place").alias("n"), "d1", "d2")
        .agg(F.max("n").alias("longest"))
        .where("longest > n")
    )
    ends = (
        ordered.where("place = n")
        .groupBy("n", "d1", "d2")
        .agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_same"))
    )
    return ends.join(prefixes, ["n", "d1", "d2"], "left_anti").select("conv_id", "n", "n_same")


def rendered_turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), role, F.lit("\n"), text, F.lit(CLOSE), F.lit("\n"))


def render(turns: DataFrame, part_turns: int = 4096) -> DataFrame:
    """`(conv_id, part, n_turns, n_same, rendered)`: the maximal conversations as chat text.

    A conversation of more than `part_turns` turns comes in several parts, so no row holds an
    unbounded text; joined in order of `part` they are the whole. Null roles and texts count as empty
    ones; turns without a conversation id are left out, as they belong to none; a null turn number
    comes first; ties are ordered by role and text; an empty table gives no rows; other columns are
    not read.
    """
    ordered = turns_in_order(turns.select("conv_id", "turn", "role", "text"))
    kept = maximal(ordered)
    parts = (
        ordered.select("conv_id", "place", "role", "text")
        .join(kept, "conv_id")
        .groupBy("conv_id", F.floor((F.col("place") - 1) / part_turns).cast("long").alias("part"))
        .agg(
            F.first("n").alias("n_turns"),
            F.first("n_same").alias("n_same"),
            F.array_sort(
                F.collect_list(F.struct("place", rendered_turn(F.col("role"), F.col("text")).alias("t")))
            ).alias("turns"),
        )
    )
    return parts.select(
        "conv_id", "part", "n_turns", "n_same",
        F.array_join(F.transform("turns", lambda x: x["t"]), "").alias("rendered"),
    )
