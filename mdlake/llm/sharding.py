"""Sharding by a hierarchical weighted hash tree.

A tree is ``{region: {rack: {shard number: weight}}}``. A row descends it level by level. At each node
every child draws an exponential variate from the hash of (child name, key), scaled by the child's
weight, and the smallest draw wins. A draw depends on its own child only, so a changed weight moves
rows into or out of that child alone, and siblings never exchange rows.

A null key is hashed like an empty text, a null payload has no bytes. Repeated rows get the same shard
and slots of their own. Columns of the input that are named like an output are replaced, other columns pass
through. An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..session import checkpointed

Tree = dict[str, dict[str, dict[int, float]]]


def even_tree(regions: int = 2, racks: int = 2, shards: int = 4) -> Tree:
    """Shards 0, 1, 2, ... of weight 1, numbered through racks and regions."""
    numbers = iter(range(regions * racks * shards))
    return {
        f"region{i}": {f"rack{i}.{j}": {next(numbers): 1.0 for _ in range(shards)} for j in range(racks)}
        for i in range(regions)
    }


def grown(tree: Tree, shard: int, weight: float = 1.0) -> Tree:
    """The tree with one more shard in a region of its own: rows move only into that shard."""
    name = f"grown{shard}"
    return {**tree, name: {f"rack.{name}": {shard: weight}}}


def _weight(node: dict | float) -> float:
    return sum(map(_weight, node.values())) if isinstance(node, dict) else node


def draw(name: str, key: Column, weight: float) -> Column:
    """-ln(u) / weight with u in (0, 1) from the top 53 bits of the hash of "name:key"."""
    bits = F.shiftrightunsigned(F.xxhash64(F.concat(F.lit(f"{name}:"), key)), 11)
    return -F.log((bits.cast("double") + 0.5) * 2.0**-53) / weight


def shard_of(tree: Tree, key: Column) -> Column:
    """The shard number that the key descends to."""
    key = F.coalesce(key.cast("string"), F.lit(""))

    def choose(children: dict) -> Column:
        live = {name: child for name, child in children.items() if _weight(child) > 0}
        if not live:
            raise ValueError("no child with a positive weight")
        best = F.array_min(
            F.array(*(F.struct(draw(str(n), key, _weight(c)), F.lit(i)) for i, (n, c) in enumerate(live.items())))
        )
        chosen = best["col2"]
        out = None
        for i, (name, child) in enumerate(live.items()):
            leaf = choose(child) if isinstance(child, dict) else F.lit(int(name))
            out = F.when(chosen == i, leaf) if out is None else out.when(chosen == i, leaf)
        return out

    return choose(tree)


def with_slots(rows: DataFrame, shard: str = "shard", output: str = "slot") -> DataFrame:
    """Number the rows of each shard from 0 without gaps.

    The rows are checkpointed as they lie, a row's slot is its number inside its partition plus the sizes
    of the earlier partitions, and only those sizes are summed over a shard. No task ever holds more of a
    shard than one input partition has.
    """
    fixed = checkpointed(rows.withColumn("_part", F.spark_partition_id()).withColumn("_row", F.monotonically_increasing_id()))
    sizes = fixed.groupBy(shard, "_part").agg(F.count(F.lit(1)).alias("_size"))
    earlier = W.partitionBy(shard).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(shard, "_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"))
    inside = F.row_number().over(W.partitionBy(shard, "_part").orderBy("_row")) - 1
    return (
        fixed.withColumn("_inside", inside)
        .join(offsets, [shard, "_part"])
        .withColumn(output, (F.col("_inside") + F.col("_offset")).cast("long"))
        .drop("_part", "_row", "_inside", "_offset")
    )


def assign(rows: DataFrame, tree: Tree, key: str = "doc_id", output: str = "shard", grown_by: int | None = None) -> DataFrame:
    """Add each row's shard, its slot, and where it goes once shard ``grown_by`` joins the tree."""
    placed = rows.withColumn(output, shard_of(tree, F.col(key)))
    if grown_by is not None:
        placed = placed.withColumn(f"grown_{output}", shard_of(grown(tree, grown_by), F.col(key)))
    return with_slots(placed, output)


def write_shards(rows: DataFrame, path: str, shard: str = "shard") -> None:
    """One folder per shard; rows go to its files by slot, so a large shard is not written by one task."""
    rows.repartition(F.col(shard), F.floor(F.col("slot") / 1_000_000)).write.partitionBy(shard).parquet(path)
