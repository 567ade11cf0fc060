"""Collapse logged snapshots of growing conversations and render those that remain.

Loggers often store a conversation again after each turn. A turn's hash depends on its position, role and
text; the running exclusive-or over a conversation's turns is the hash of its prefix. A conversation goes
if its whole hash (two independent 64-bit halves) is the hash of a proper prefix of another one, or if an
equal conversation has a smaller id. What remains is rendered.

Turns are ordered by ``turn``, then role and text, so gaps in the numbers and repeated numbers do no harm;
null turns come first. Exactly repeated rows count once. A null role or text counts as empty. Rows without
a conversation id are left out, as nothing says which turns belong together. Extra columns are ignored, and
an empty table gives no rows.

A conversation is walked in range slices, so one with a third of all rows spreads over many tasks. It is
rendered slice by slice too; only the last step puts its slices into one text, which may not be longer than
Spark's limit of 2 GB for a value (the job fails then, nothing is cut).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..operators import slices
from ..session import checkpointed

PREFIX = ["n_turns", "h1", "h2"]
# The marks around a rendered turn.
TURN_FORMAT = "<|{role}|>\n{text}<|end|>\n"


def ordered_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, slice, place): distinct turns in range slices; ``place`` grows along a conversation.

    The frame is checkpointed, so slices and places are fixed.
    """
    clean = (
        turns.where(F.col("conv_id").isNotNull())
        .select(
            "conv_id",
            "turn",
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        )
        .distinct()
    )
    order = ["conv_id", "turn", "role", "text"]
    sorted_ = clean.repartitionByRange(*order).sortWithinPartitions(*order)
    return checkpointed(
        sorted_.withColumn(slices.SLICE, F.spark_partition_id()).withColumn("place", F.monotonically_increasing_id())
    )


def turn_prefixes(ordered: DataFrame) -> DataFrame:
    """(conv_id, n_turns, h1, h2): each turn's number and the hash of all turns up to it. Texts stay behind."""
    by, order = ["conv_id"], ["place"]

    def content(half: int) -> Column:
        return F.xxhash64(F.lit(half), "role", "text").alias(f"c{half}")

    narrow = ordered.select("conv_id", slices.SLICE, "place", content(1), content(2))
    numbered = slices.run(narrow, by, order, {"n_turns": slices.row_numbers()}, keep_slice=True)
    hashes = {f"h{half}": slices.running_xor(F.xxhash64(F.lit(half), "n_turns", "c1", "c2")) for half in (1, 2)}
    return slices.run(numbered, by, order, hashes).select("conv_id", *PREFIX)


def maximal(prefixes: DataFrame) -> DataFrame:
    """Ids of the conversations that are no prefix of a longer one; of equal ones, the smallest id.

    Prefixes are made distinct before the anti-join, so an opening that a third of all conversations
    share is one row on that side.
    """
    whole = prefixes.groupBy("conv_id").agg(F.max(F.struct(*PREFIX)).alias("last")).select("conv_id", "last.*")
    finals = whole.groupBy(*PREFIX).agg(F.min("conv_id").alias("conv_id"))
    ends = whole.select("conv_id", F.col("n_turns").alias("total"))
    proper = prefixes.join(ends, "conv_id").where(F.col("n_turns") < F.col("total")).select(*PREFIX).distinct()
    return finals.join(proper, PREFIX, "left_anti").select("conv_id", "n_turns")


def render(ordered: DataFrame, kept: DataFrame) -> DataFrame:
    """(conv_id, n_turns, text): each kept conversation as one text in turn order."""
    before_role, rest = TURN_FORMAT.split("{role}")
    before_text, after_text = rest.split("{text}")
    piece = F.concat(F.lit(before_role), "role", F.lit(before_text), "text", F.lit(after_text))
    pieces = ordered.join(kept.select("conv_id"), "conv_id", "left_semi").select(
        "conv_id", slices.SLICE, F.struct("place", piece.alias("piece")).alias("turn")
    )

    def joined(parts: Column, name: str) -> Column:
        return F.array_join(F.sort_array(F.collect_list(parts))[name], "")

    chunks = pieces.groupBy("conv_id", slices.SLICE).agg(F.count(F.lit(1)).alias("n"), joined(F.col("turn"), "piece").alias("chunk"))
    return chunks.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"), joined(F.struct(slices.SLICE, "chunk"), "chunk").alias("text")
    )


def collapse_snapshots(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, text) of the maximal conversations, rendered."""
    ordered = ordered_turns(turns)
    return render(ordered, maximal(turn_prefixes(ordered)))
