"""The trie of conversation prefixes, rolled up by centroid decomposition.

A node is a distinct sequence of first turns. Its name is (conv_id, depth) with the smallest conversation that
begins with it, so a conversation's nodes are found by (conversation, depth), and the nodes above (c, d) are
those of conversation c at smaller depths.

Values are summed over subtrees by recursive splitting. A component is a connected part of the forest of
parent edges; its weight is the number of (conversation, turn) rows of its nodes. Its centroid is the deepest
node whose part of the component, from itself down, weighs more than half. Taking the centroid out leaves the
part above it and one part per child, each at most half as heavy, so a tree of any shape, a chain of millions
of turns included, is done in a number of rounds logarithmic in the rows. In each round the total of the
centroid's part is its final sum within the component, and is added to the nodes on the path from the centroid
to the component's top. The weights below a node are known beforehand (every conversation adds its remaining
turns), and what is taken out is subtracted along the same paths. Components of at most ``local`` rows are
split by the same recursion inside one task each.

Turns are ordered by ``turn``, null first, and then by the MD5 of role and text; repeated rows are repeated
turns. A null role or text is empty. Rows without a conversation id are left out. Extra columns are ignored.
Texts only enter digests and lengths at the start, so very long ones do no harm. Turns are told apart by MD5,
prefixes by two 64-bit running hashes over position and turn. An empty table has no nodes, not even a root.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
import hashlib

from pyspark.sql import Column, DataFrame, functions as F

from ..operators import slices
from ..session import scratch_path
from .common import map_rows

# Weight up to which a component is split inside one task.
LOCAL = 256
# Nodes of a path that one row stands for on its way to the tasks that list them.
STRETCH = 4096


def kept(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder, so that rounds stay short and a lost executor repeats one at most."""
    path = scratch_path(df.sparkSession, f"trie-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ordered_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, n, turn_id, chars): the turns of each conversation, numbered from 1."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    clean = turns.where(F.col("conv_id").isNotNull()).select(
        "conv_id", "turn", digest.alias("turn_id"), F.char_length(text).cast("long").alias("chars")
    )
    return slices.running(clean, ["conv_id"], ["turn", "turn_id"], {"n": slices.row_numbers()}).drop("turn")


def share_openings(numbered: DataFrame, group: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt so that openings are shared: (conv_id, length) and (conv_id, depth, turn_id, chars, length).

    Conversation c begins with the first h turns of conversation c - c % group, where h is the CRC-32 of c's
    decimal digits modulo ``most``, and goes on with its own turns after its first h.
    """
    sizes = numbered.groupBy("conv_id").agg(F.max("n").alias("own"))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    plan = sizes.select("conv_id", "own", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % group).alias("base"))
    base_sizes = sizes.select(F.col("conv_id").alias("base"), F.col("own").alias("base_size"))
    taken = F.least(F.col("h"), F.coalesce("base_size", F.lit(0).cast("long")))
    whole = plan.join(base_sizes, "base", "left").select(
        "conv_id", "base", "h", taken.alias("taken"), (taken + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("length")
    )
    openings = (
        whole.where("taken > 0")
        .select("conv_id", "length", "base", F.explode(F.sequence(F.lit(1).cast("long"), F.col("taken"))).alias("depth"))
        .join(
            numbered.where(F.col("n") < most).select(F.col("conv_id").alias("base"), F.col("n").alias("depth"), "turn_id", "chars"),
            ["base", "depth"],
        )
    )
    rest = numbered.join(whole, "conv_id").where(F.col("n") > F.col("h"))
    columns = ["conv_id", "depth", "turn_id", "chars", "length"]
    own = rest.withColumn("depth", F.col("n") - F.col("h") + F.col("taken"))
    return whole.select("conv_id", "length"), openings.select(columns).union(own.select(columns))


def whole_conversations(numbered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations as they are, in the form of ``share_openings``."""
    lengths = numbered.groupBy("conv_id").agg(F.max("n").alias("length"))
    rows = numbered.join(lengths, "conv_id")
    return lengths, rows.select("conv_id", F.col("n").alias("depth"), "turn_id", "chars", "length")


def named_rows(conversations: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, depth, node, length, parent), and nodes (node, depth, n_convs, weight, chars).

    ``weight`` counts the rows at and below a node. A node's rows share few values, so they are summed on the
    map side; names come back in a plain join, which adaptive execution splits where a third of all
    conversations have the same opening.
    """

    def turn_hash(half: int) -> Column:
        return F.xxhash64(F.lit(half), "depth", "turn_id")

    hashed = slices.running(
        rows, ["conv_id"], ["depth"], {"h1": slices.running_xor(turn_hash(1)), "h2": slices.running_xor(turn_hash(2))}
    )
    key = ["depth", "h1", "h2"]
    zero = F.lit(0).cast("long")
    roots = conversations.select("conv_id", *(zero.alias(k) for k in key), "length", zero.alias("chars"))
    every = kept(hashed.select("conv_id", *key, "length", "chars").union(roots), "prefixes")
    counted = every.groupBy(*key).agg(
        F.min("conv_id").alias("node"),
        F.count(F.lit(1)).alias("n_convs"),
        F.sum(F.col("length") - F.col("depth") + 1).alias("weight"),
        F.max("chars").alias("chars"),
    )
    nodes = kept(counted, "counted")  # so that the join below shuffles both sides anew, and can split a hot opening
    named = kept(every.join(nodes.select(*key, "node"), key).select("conv_id", "depth", "node", "length"), "names")
    above = named.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("node").alias("parent"))
    return named.join(above, ["conv_id", "depth"], "left"), nodes.drop("h1", "h2")


def with_parents(places: DataFrame, nodes: DataFrame) -> DataFrame:
    """Nodes with ``parent`` (null at the root) and ``n_children``."""
    own = places.where(F.col("conv_id") == F.col("node")).select("node", "depth", "parent")
    linked = nodes.join(own, ["node", "depth"])
    children = (
        own.where(F.col("parent").isNotNull())
        .groupBy(F.col("parent").alias("node"), (F.col("depth") - 1).alias("depth"))
        .agg(F.count(F.lit(1)).alias("n_children"))
    )
    n_children = F.coalesce("n_children", F.lit(0).cast("long"))
    return linked.join(children, ["node", "depth"], "left").withColumn("n_children", n_children)


# --- centroid decomposition -----------------------------------------------------------------------


def split_locally(nodes: list[tuple]) -> Iterator[tuple]:
    """The recursion inside a component: nodes (node, depth, parent, below, own, sums) to (node, depth, sums).

    ``below`` is the weight at and below a node within the component, ``own`` the node's values to be summed,
    ``sums`` what was added so far.
    """
    index = {(n[0], n[1]): i for i, n in enumerate(nodes)}
    up = [index.get((n[2], n[1] - 1)) for n in nodes]
    below = [n[3] for n in nodes]
    own = [n[4] for n in nodes]
    sums = [list(n[5]) for n in nodes]
    down: list[list[int]] = [[] for _ in nodes]
    for i, parent in enumerate(up):
        if parent is not None:
            down[parent].append(i)
    tops = [i for i, parent in enumerate(up) if parent is None]
    removed = [False] * len(nodes)
    while tops:
        top = tops.pop()
        half, centroid = below[top], top
        while True:
            heavy = next((c for c in down[centroid] if not removed[c] and 2 * below[c] > half), None)
            if heavy is None:
                break
            centroid = heavy
        removed[centroid] = True
        parts = [c for c in down[centroid] if not removed[c]]
        total = list(own[centroid])
        stack = list(parts)
        while stack:
            i = stack.pop()
            total = [a + b for a, b in zip(total, own[i])]
            stack.extend(c for c in down[i] if not removed[c])
        sums[centroid] = [a + b for a, b in zip(sums[centroid], total)]
        i, weight = centroid, below[centroid]
        while i != top:
            i = up[i]
            below[i] -= weight
            sums[i] = [a + b for a, b in zip(sums[i], total)]
        tops.extend(parts)
        if top != centroid:
            tops.append(top)
    for n, s in zip(nodes, sums):
        yield (n[0], n[1], *s)


def finish_locally(small: DataFrame, values: list[str]) -> DataFrame:
    """(node, depth, sums) of components of bounded weight, streamed one component after the other."""
    k = len(values)
    columns = ["top", "top_depth", "node", "depth", "parent", "below", *values, *(f"sum_{v}" for v in values)]

    def run(rows: Iterator[tuple]) -> Iterable[tuple]:
        held: list[tuple] = []
        key = None
        for row in rows:
            if row[:2] != key and held:
                yield from split_locally(held)
                held = []
            key = row[:2]
            held.append((*row[2:6], row[6 : 6 + k], row[6 + k :]))
        if held:
            yield from split_locally(held)

    dealt = small.select(columns).repartition("top", "top_depth").sortWithinPartitions("top", "top_depth")
    return map_rows(dealt, run, "node long, depth long, " + ", ".join(f"{v} long" for v in values))


def subtree_sums(places: DataFrame, nodes: DataFrame, values: list[str], local: int = LOCAL) -> DataFrame:
    """(node, depth, values): each value summed over the node and all nodes below it.

    ``places`` (conv_id, depth, node, parent) names the nodes on a conversation's path; ``nodes`` has node,
    depth, parent, weight and the values, as longs.
    """
    root = nodes.where("depth = 0").select("node", "weight").first()
    if root is None:
        return nodes.select("node", "depth", *values)
    name, weight = F.lit(root["node"]).cast("long"), F.lit(root["weight"]).cast("long")
    nothing = F.lit(0).cast("long")
    active = kept(
        nodes.select(
            "node", "depth", "parent", F.col("weight").alias("below"), *values, *(nothing.alias(f"sum_{v}") for v in values),
            name.alias("top"), nothing.alias("top_depth"), weight.alias("heavy"),
        ),
        "active",
    )
    done = []
    while True:
        done.append(kept(finish_locally(active.where(F.col("heavy") <= local), values), "done"))
        large = active.where(F.col("heavy") > local)
        if large.isEmpty():
            break
        divided = kept(divide(large, places), "divided")
        totals = kept(centroid_totals(divided, values), "totals")
        done.append(totals.select(F.col("c_node").alias("node"), F.col("c_depth").alias("depth"), *(F.col(f"final_{v}").alias(v) for v in values)))
        active = kept(add_along_paths(divided, totals, places, values), "active")
    whole = done[0]
    for part in done[1:]:
        whole = whole.union(part)
    return whole


def divide(active: DataFrame, places: DataFrame) -> DataFrame:
    """Nodes with the centroid of their component and the component that they belong to without it.

    Centroids: c_node, c_depth, c_below; ``under`` marks the centroid's part, centroid included. A node is below
    the centroid if its own conversation passes through it; the node one step further down tops its new part.
    """
    component = ["top", "top_depth"]
    deepest = F.max_by(F.struct("node", "depth", "below"), "depth")
    centroids = (
        active.where(2 * F.col("below") > F.col("heavy"))
        .groupBy(*component)
        .agg(deepest.alias("c"))
        .select(*component, F.col("c.node").alias("c_node"), F.col("c.depth").alias("c_depth"), F.col("c.below").alias("c_below"))
    )
    step = F.least(F.col("depth"), F.col("c_depth") + 1)
    aimed = active.join(centroids, component).withColumn("via_depth", step)
    passed = places.select(
        F.col("conv_id").alias("_conv"), F.col("depth").alias("_depth"), F.col("node").alias("via"), F.col("parent").alias("via_parent")
    )
    named = aimed.join(passed, (F.col("node") == F.col("_conv")) & (F.col("via_depth") == F.col("_depth"))).drop("_conv", "_depth")
    below = F.col("depth") > F.col("c_depth")
    moves = below & (F.col("via_parent") == F.col("c_node"))
    itself = (F.col("depth") == F.col("c_depth")) & (F.col("node") == F.col("c_node"))
    # The heaviest row of a new part is its top, whose weight below is the part's.
    tops = active.select(F.col("node").alias("_top"), F.col("depth").alias("_top_depth"), F.col("below").alias("part"))
    weighed = named.withColumns({"moves": moves, "under": moves | itself, "centroid": itself}).join(
        tops, (F.col("via") == F.col("_top")) & (F.col("via_depth") == F.col("_top_depth")), "left"
    )
    return weighed.withColumns(
        {
            "new_top": F.when(F.col("moves"), F.col("via")).otherwise(F.col("top")),
            "new_top_depth": F.when(F.col("moves"), F.col("via_depth")).otherwise(F.col("top_depth")),
            "new_heavy": F.when(F.col("moves"), F.col("part")).otherwise(F.col("heavy") - F.col("c_below")),
        }
    ).drop("via", "via_parent", "via_depth", "part", "moves", "_top", "_top_depth")


def centroid_totals(divided: DataFrame, values: list[str]) -> DataFrame:
    """Per centroid the totals of its part, and its own final sums."""
    each = ["top", "top_depth", "c_node", "c_depth", "c_below"]
    sums = [F.sum(F.when(F.col("under"), F.col(v)).otherwise(0)).alias(f"total_{v}") for v in values]
    before = [F.max(F.when(F.col("centroid"), F.col(f"sum_{v}"))).alias(f"before_{v}") for v in values]
    summed = divided.groupBy(*each).agg(*sums, *before)
    finals = [(F.col(f"before_{v}") + F.col(f"total_{v}")).alias(f"final_{v}") for v in values]
    return summed.select(*each, *(f"total_{v}" for v in values), *finals)


def add_along_paths(divided: DataFrame, totals: DataFrame, places: DataFrame, values: list[str]) -> DataFrame:
    """What remains of the components, with the centroids' totals added between them and the tops.

    A path is listed in stretches, which are dealt out before their nodes are.
    """
    added = ["c_below", *(f"total_{v}" for v in values)]
    stretches = totals.where(F.col("c_depth") > F.col("top_depth")).select(
        F.col("c_node").alias("conv_id"), "c_depth", *added,
        F.explode(F.sequence("top_depth", F.col("c_depth") - 1, F.lit(STRETCH).cast("long"))).alias("first"),
    )
    last = F.least(F.col("first") + STRETCH - 1, F.col("c_depth") - 1)
    steps = stretches.repartition("conv_id", "first").select("conv_id", *added, F.explode(F.sequence("first", last)).alias("depth"))
    path = steps.join(places.select("conv_id", "depth", "node"), ["conv_id", "depth"]).select(
        "node", "depth", *(F.col(a).alias(f"_{a}") for a in added)
    )
    rest = divided.where(~F.col("centroid")).join(path, ["node", "depth"], "left")
    nothing = F.lit(0).cast("long")
    return rest.select(
        "node", "depth", "parent",
        (F.col("below") - F.coalesce("_c_below", nothing)).alias("below"),
        *values,
        *((F.col(f"sum_{v}") + F.coalesce(f"_total_{v}", nothing)).alias(f"sum_{v}") for v in values),
        F.col("new_top").alias("top"), F.col("new_top_depth").alias("top_depth"), F.col("new_heavy").alias("heavy"),
    )


# --- the result -----------------------------------------------------------------------------------


def end_digests(places: DataFrame) -> DataFrame:
    """(node, depth, ends_sha256): SHA-256 of the comma-joined ids of the conversations that end at a node.

    Ids are joined in range slices, so the digest of a node where very many conversations end runs over a few
    long strings, one at a time.
    """
    ends = places.where(F.col("depth") == F.col("length")).select("node", "depth", "conv_id")
    cut = slices.sliced(ends, ["node", "depth"], ["conv_id"])
    ids = F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",")
    chunks = cut.groupBy("node", "depth", slices.SLICE).agg(ids.alias("ids"))

    def digest(rows: Iterator[tuple]) -> Iterable[tuple]:
        key, running = None, hashlib.sha256()
        for node, depth, _, part in rows:
            if (node, depth) == key:
                running.update(b",")
            else:
                if key is not None:
                    yield (*key, running.hexdigest())
                key, running = (node, depth), hashlib.sha256()
            running.update(part.encode())
        if key is not None:
            yield (*key, running.hexdigest())

    dealt = chunks.repartition("node", "depth").sortWithinPartitions("node", "depth", slices.SLICE)
    return map_rows(dealt.select("node", "depth", slices.SLICE, "ids"), digest, "node long, depth long, ends_sha256 string")


def prefix_trie(turns: DataFrame, openings: bool = False, local: int = LOCAL) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) per node.

    ``openings`` rebuilds the conversations first, see ``share_openings``. ``n_leaves`` and ``saved_tokens``
    (turns that storing the trie saves, times their code points) are sums over a node's subtree.
    """
    numbered = ordered_turns(turns)
    conversations, rows = share_openings(numbered) if openings else whole_conversations(numbered)
    named, counted = named_rows(conversations, rows)
    places = kept(named, "places")
    own = {
        "n_leaves": F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long"),
        "saved_tokens": (F.col("n_convs") - 1) * F.col("chars"),
    }
    nodes = kept(with_parents(places, counted).withColumns(own), "nodes")
    sums = subtree_sums(places, nodes, list(own), local)
    none = F.lit(hashlib.sha256().hexdigest())
    return (
        nodes.drop(*own)
        .join(sums, ["node", "depth"])
        .join(end_digests(places), ["node", "depth"], "left")
        .select(
            F.col("node").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children",
            "n_leaves", "saved_tokens", F.coalesce("ends_sha256", none).alias("ends_sha256"),
        )
    )
