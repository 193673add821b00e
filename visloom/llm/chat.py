"""Chat formatting with cumulative-snapshot collapse.

Loggers often store a conversation again after every turn, so that a conversation is a prefix of longer
ones. Turn i of a conversation gets a digest of its place, role and text, and the running sum of digests
is the hash of the first i turns (four lanes of 31 bits, so equal hashes mean equal prefixes). Conversations
whose whole hash is the hash of a proper prefix of another one, or the whole hash of another one of smaller
id, are dropped by anti-joins; what stays is rendered. The hashes are written once and read by both joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import new_dir, store

LANES = 4
_MASK = (1 << 31) - 1
START, END = "<|turn|>", "<|end|>"


def _digest(lane: int) -> Column:
    """31 bits of (place, role, text); null and empty differ."""
    return F.xxhash64(F.lit(lane), "place", F.col("role").isNull(), "role", F.col("text").isNull(), "text").bitwiseAND(_MASK)


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """turns with their place in the conversation (1, 2, ...) and prefix hash p0..p3 up to them.

    Places follow turn (null first); repeated turns are ordered by role and text, so ties are settled.
    """
    order = W.partitionBy("conv_id").orderBy("turn", "role", "text")
    placed = turns.withColumn("place", F.row_number().over(order))
    digests = placed.select("*", *(_digest(i).alias(f"d{i}") for i in range(LANES)))
    return digests.select(*placed.columns, *(F.sum(f"d{i}").over(W.partitionBy("conv_id").orderBy("place")).alias(f"p{i}") for i in range(LANES)))


def collapse(turns: DataFrame) -> DataFrame:
    """conv_id, n_turns of the maximal conversations: no other conversation continues or, with a smaller id, repeats them."""
    keys = ["place", *(f"p{i}" for i in range(LANES))]
    prefixes = prefix_hashes(turns).withColumn("n", F.max("place").over(W.partitionBy("conv_id"))).select("conv_id", *keys, "n")
    prefixes = store(prefixes, new_dir(turns.sparkSession, "chats"), "prefixes")
    whole = prefixes.where("place = n").drop("n")
    continued = prefixes.where("place < n").select(*keys).distinct()
    first = whole.groupBy(*keys).agg(F.min("conv_id").alias("conv_id"))
    return first.join(continued, keys, "left_anti").select("conv_id", F.col("place").cast("long").alias("n_turns"))


def render(turns: DataFrame) -> DataFrame:
    """conv_id, chat: all turns in order, each `START role newline text END newline`; a null role or text is empty."""
    order = F.struct(F.col("turn").isNotNull().alias("known"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    sorted_turns = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(order)).alias("t"))
    line = lambda x: F.concat(F.lit(START), x["role"], F.lit("\n"), x["text"], F.lit(f"{END}\n"))
    return sorted_turns.select("conv_id", F.array_join(F.transform("t", line), "").alias("chat"))


def format_chats(conversations: DataFrame) -> DataFrame:
    """conv_id, n_turns, chat of maximal conversations (conv_id, turn, role, text).

    Rows with a null conv_id belong to no conversation and are left out. Repeated rows are turns of their
    own. A conversation's text is one value, so one conversation has to fit into a row; conversations
    themselves may be any number, also with one first turn or one whole text in common.
    """
    turns = conversations.select("conv_id", "turn", "role", "text").where("conv_id IS NOT NULL")
    kept = collapse(turns)
    chats = render(turns.join(kept, "conv_id", "left_semi"))
    return kept.join(chats, "conv_id").select("conv_id", "n_turns", "chat", F.length("chat").cast("long").alias("n_chars"))
