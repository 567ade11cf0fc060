"""Connected components of a distributed list of links, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import checkpointed


def connected(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node that has a link to another one; the root is its component's smallest node.

    Each round hangs the larger neighbours of a node, then the smaller ones, below the smallest node in
    sight, until nothing changes; a chain of n nodes takes a number of rounds logarithmic in n. A round is
    made of sums by key and plain joins on keys whose other side is unique, so a node with very many
    neighbours is split by adaptive execution. Rounds are checkpointed, so lineage stays short and a lost
    executor repeats one round at most. Links with a null end or to itself are ignored.
    """
    ends = links.select(F.greatest(a, b).alias("v"), F.least(a, b).alias("u"))
    stars = checkpointed(ends.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") < F.col("v"))).distinct())
    before = _signature(stars)
    while before[0]:
        both = stars.select(F.col("v").alias("x"), F.col("u").alias("y")).union(stars.select("u", "v"))
        lowest = both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m"))
        large = stars.select(F.col("u").alias("x"), "v").join(lowest, "x").select("v", F.col("m").alias("u")).distinct()
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        rest = large.join(least, "v").where(F.col("u") != F.col("m")).select(F.col("u").alias("v"), F.col("m").alias("u"))
        stars = checkpointed(rest.union(least.select("v", "m")).distinct())
        after = _signature(stars)
        if after == before:
            break
        before = after
    roots = stars.select(F.col("u").alias("node")).distinct()
    return stars.select(F.col("v").alias("node"), F.col("u").alias("root")).union(
        roots.select("node", F.col("node").alias("root"))
    )


def _signature(stars: DataFrame) -> tuple[int, int, int]:
    row = stars.agg(
        F.count(F.lit(1)), F.bit_xor(F.xxhash64("v", "u")), F.bit_xor(F.xxhash64("u", "v"))
    ).first()
    return tuple(x or 0 for x in row)
