"""Chat formatting with cumulative-snapshot collapse; DataFrame functions only.

A chat service that logs the whole conversation at each answer leaves snapshots that prefix longer ones. Every turn gets
a rolling hash of its conversation up to it: the exclusive or, in a running window, of two 64-bit hashes of (position,
role, text). A conversation whose last hash is a hash inside a longer one is such a snapshot; an anti-join drops it, and
the conversations left are rendered. Identical conversations keep the smallest conv_id.

Turns are ordered by (turn, role, text), null turns first; ties in turn are so ordered by role and text. Exactly repeated
rows count once. Null role or text: empty. Rows without conv_id are left out. An empty table gives no rows. Other columns
are ignored. Prefix hashes are made distinct before the join, so a first turn that a third of all conversations share is
one row there; only the turns of one conversation have to meet in a task, where the window streams them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored

#: Marks around a turn.
TURN_START, TURN_END = "<|im_start|>", "<|im_end|>"


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, n (1, 2, ...), role, text."""
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    again = F.lag("turn").over(order).eqNullSafe(F.col("turn")) & (F.lag("role").over(order) == F.col("role")) & (F.lag("text").over(order) == F.col("text"))
    kept = rows.withColumn("again", F.coalesce(again, F.lit(False))).where("not again")
    return kept.select("conv_id", F.row_number().over(order).alias("n"), "role", "text")


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """conv_id, n, h1, h2 of the conversation up to turn n, and whether it is the last."""
    order = Window.partitionBy("conv_id").orderBy("n")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    hashed = turns.select("conv_id", "n", F.xxhash64("n", "role", "text").alias("a"), F.xxhash64(F.lit(7), "text", "n", "role").alias("b"))
    return hashed.select(
        "conv_id", "n", F.bit_xor("a").over(so_far).alias("h1"), F.bit_xor("b").over(so_far).alias("h2"), F.lead("n").over(order).isNull().alias("last")
    )


def maximal(conversations: DataFrame) -> DataFrame:
    """conv_id, n_turns, n_copies of the conversations that no longer one begins with."""
    return _maximal(numbered_turns(conversations))


def _maximal(turns: DataFrame) -> DataFrame:
    hashes = stored(prefix_hashes(turns), "prefix_hashes")
    key = ["n", "h1", "h2"]
    whole = hashes.where("last").groupBy(*key).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies"))
    inner = hashes.where("not last").select(*key).distinct()
    return whole.join(inner, key, "left_anti").select("conv_id", F.col("n").cast("long").alias("n_turns"), "n_copies")


def rendered_turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit(TURN_START), role, F.lit("\n"), text, F.lit(TURN_END + "\n"))


def render(conversations: DataFrame) -> DataFrame:
    """conv_id, n_turns, n_copies, text (all turns rendered) of the maximal conversations."""
    numbered = stored(numbered_turns(conversations), "numbered_turns")
    turns = numbered.join(_maximal(numbered), "conv_id")
    parts = F.array_sort(F.collect_list(F.struct("n", rendered_turn(F.col("role"), F.col("text")).alias("part"))))
    whole = turns.groupBy("conv_id").agg(F.first("n_turns").alias("n_turns"), F.first("n_copies").alias("n_copies"), parts.alias("parts"))
    return whole.select("conv_id", "n_turns", "n_copies", F.array_join("parts.part", "").alias("text"))
