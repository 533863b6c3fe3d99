"""Chat formatting after cumulative-snapshot collapse."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def format_conversations(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """Rows (conv_id, n_turns, chat): the maximal logged conversations, rendered.

    Logs hold snapshots: a conversation may be logged again with more turns. One whose turns are
    the first turns of a longer one goes; of conversations with equal turns the smallest id stays.
    Turns are ordered by number, then role, then text; equal rows count once; numbers need not be
    consecutive and only give the order. A null turn number sorts first, null role or text read
    as empty. Rows without conversation id belong to no conversation and are left out. A turn
    renders as ``<|role|>``, line feed, text, line feed; turns follow each other.

    Each prefix is told by two hashes over (position, role, text) of its turns, rolled on by
    exclusive or; the anti-join compares those, so texts are only moved to render.
    """
    own = turns.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    ordered = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    so_far = Window.partitionBy("conv_id").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = own.dropDuplicates().withColumn("at", F.row_number().over(ordered))
    hashed = numbered.select("conv_id", "at", *(F.xxhash64(F.lit(salt), "at", "role", "text").alias(f"h{salt}") for salt in (1, 2)))
    rolled = hashed.select(
        "conv_id",
        "at",
        F.bit_xor("h1").over(so_far).alias("prefix_a"),
        F.bit_xor("h2").over(so_far).alias("prefix_b"),
        F.count("*").over(Window.partitionBy("conv_id")).alias("n_turns"),
    )
    whole = rolled.filter("at = n_turns").groupBy("prefix_a", "prefix_b", "n_turns").agg(F.min("conv_id").alias("conv_id"))
    longer = rolled.filter("at < n_turns").select("prefix_a", "prefix_b", F.col("at").cast("long").alias("n_turns")).distinct()
    maximal = whole.join(longer, ["prefix_a", "prefix_b", "n_turns"], "left_anti").select("conv_id", "n_turns")
    kept = numbered.join(maximal, "conv_id")
    chat = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "role", "text"))), lambda t: F.concat(F.lit("<|"), t["role"], F.lit("|>\n"), t["text"], F.lit("\n"))), "")
    return kept.groupBy("conv_id").agg(F.first("n_turns").alias("n_turns"), chat.alias("chat"))

