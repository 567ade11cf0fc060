"""SimHash near-duplicates by tiled exact comparison.

A text's fingerprint has one bit per hash bit of its word shingles, set if the bit is set in over half of
them. Equal fingerprints are one class. Distinct fingerprints lie in tiles of one population count each;
two tiles are compared only if their counts differ by at most the radius, since each differing bit changes
the count by one. A comparison is numpy exclusive-or and bit counts over all pairs of two tiles, so no link
is missed, and it returns a spanning forest of what it linked, never all pairs of a dense group.

A null or empty text has fingerprint zero. Rows without an id get a fingerprint but link nothing. Rows with
the same id and text get the same result. Texts are hashed whole, in parts of bounded memory for the bit counts.
Extra columns are ignored. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
import xxhash

from ..session import checkpointed
from .common import map_rows
from .components import connected

TILE = 32_768
SHINGLE, SEED, RADIUS = 4, 42, 4


def shingle_hashes(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """XXH64 of each run of ``size`` lower-cased words; of the whole sequence if there are fewer."""
    each = (text or "").encode().lower().split()  # on bytes both concern ASCII only
    if not each:
        return np.zeros(0, np.uint64)
    joined = b" ".join(each)
    ends = np.cumsum(np.fromiter(map(len, each), np.int64, len(each)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(each) - size + 1)
    last = ends[min(size, len(each)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[i:j], SEED) for i, j in zip(starts[:n].tolist(), last)), np.uint64, n)


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """The SimHash as a signed 64-bit integer."""
    return fingerprint_of(shingle_hashes(text, size))


def fingerprint_of(hashes: np.ndarray) -> int:
    """The SimHash of hashed shingles."""
    if not len(hashes):
        return 0
    counts = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 1 << 14):
        part = hashes[start : start + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp), computed once and kept in the shared folder."""

    @F.arrow_udf("long")
    def compute(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            yield pa.array([fingerprint(t.as_py()) for t in batch], type=pa.int64())

    return checkpointed(docs.select(F.col(doc_id).alias("doc_id"), compute(F.col(text)).alias("fp")))


def forest(a: np.ndarray, b: np.ndarray | None, radius: int) -> Iterator[tuple[int, int]]:
    """Spanning forest of the links within ``a``, or between ``a`` and ``b``, as pairs of positions in a + b.

    All fingerprints of a side have the same population count, so the counts of the low halves bound the
    distance too: the side searched is sorted by them, and a row looks at the part within reach.
    """
    low = np.uint64(0xFFFFFFFF)
    other = a if b is None else b
    shift = 0 if b is None else len(a)
    difference = 0 if b is None or not len(a) or not len(b) else int(np.bitwise_count(b[0])) - int(np.bitwise_count(a[0]))
    halves = np.bitwise_count(other & low).astype(np.int64)
    order = np.argsort(halves, kind="stable")
    sorted_other, sorted_halves = other[order], halves[order]
    own = np.bitwise_count(a & low).astype(np.int64)
    slack = (radius - abs(difference)) // 2  # the low halves' counts differ by d with |d| + |difference - d| <= radius
    first = np.searchsorted(sorted_halves, own + min(0, difference) - slack, "left")
    last = np.searchsorted(sorted_halves, own + max(0, difference) + slack, "right")
    parent = np.arange(len(a) + (0 if b is None else len(b)))

    def roots(nodes: np.ndarray) -> np.ndarray:
        while True:
            up = parent[nodes]
            if (up == nodes).all():
                return nodes
            nodes = up

    limit = np.uint8(radius)
    for i in range(len(a)):
        near = np.flatnonzero(np.bitwise_count(sorted_other[first[i] : last[i]] ^ a[i]) <= limit)
        if len(near) > (b is None):
            nodes = np.append(order[first[i] + near] + shift, i)
            tops = roots(nodes)
            top = tops.min()
            parent[tops] = top
            parent[nodes] = top
    ends = roots(np.arange(len(parent)))
    moved = np.flatnonzero(ends != np.arange(len(ends)))
    yield from zip(moved.tolist(), ends[moved].tolist())


def tile_links(classes: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Links (a, b) between the ids of classes (id, fp) whose fingerprints differ in at most ``radius`` bits.

    Per population count (at most 65, counted first) the fingerprints are dealt by hash to tiles of about
    ``tile``. A pair of tiles is one row with both, keyed by the pair, so tasks get even shares of the pairs.
    """
    counted = classes.withColumn("p", F.bit_count("fp"))
    sizes = {row["p"]: row["n"] for row in counted.groupBy("p").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return classes.select(F.col("id").alias("a"), F.col("id").alias("b")).limit(0)
    tiles_of = F.array(*(F.lit(-(-sizes.get(p, 0) // tile)) for p in range(65)))
    number = F.pmod(F.xxhash64("fp"), F.greatest(tiles_of[F.col("p")], F.lit(1))).cast("int")
    tiles = checkpointed(
        counted.groupBy("p", number.alias("t")).agg(F.collect_list(F.struct("fp", "id")).alias("members")).select(
            "p", "t", F.col("members.fp").alias("fps"), F.col("members.id").alias("ids")
        )
    )

    def partners(p: Column, t: Column, up: bool) -> Column:
        """(count, tile) of the tiles that come after (up) or before this one and are within reach; itself too."""
        near = F.sequence(p, F.least(p + radius, F.lit(64))) if up else F.sequence(F.greatest(p - radius, F.lit(0)), p)
        every = F.flatten(
            F.transform(
                near,
                lambda q: F.when(
                    tiles_of[q] > 0,
                    F.transform(F.sequence(F.lit(0), tiles_of[q] - 1), lambda c: F.struct(q.alias("p"), c.alias("t"))),
                ).otherwise(F.array().cast("array<struct<p:int,t:int>>")),
            )
        )
        return F.filter(every, lambda o: (o["p"] != p) | ((o["t"] >= t) if up else (o["t"] <= t)))

    left = tiles.select("p", "t", "fps", "ids", F.explode(partners(F.col("p"), F.col("t"), True)).alias("o")).select(
        F.col("p").alias("p1"), F.col("t").alias("t1"), F.col("o.p").alias("p2"), F.col("o.t").alias("t2"), "fps", "ids"
    )
    right = tiles.select("p", "t", "fps", "ids", F.explode(partners(F.col("p"), F.col("t"), False)).alias("o")).select(
        F.col("o.p").alias("p1"), F.col("o.t").alias("t1"), F.col("p").alias("p2"), F.col("t").alias("t2"),
        F.col("fps").alias("fps2"), F.col("ids").alias("ids2"),
    )
    same = (F.col("p1") == F.col("p2")) & (F.col("t1") == F.col("t2"))
    pairs = left.join(right.hint("merge"), ["p1", "t1", "p2", "t2"]).select(
        same.alias("same"), "fps", "ids", F.when(~same, F.col("fps2")).alias("fps2"), F.when(~same, F.col("ids2")).alias("ids2")
    )

    def compare(rows: Iterator[tuple]) -> Iterable[tuple]:
        for alone, fps, ids, fps2, ids2 in rows:
            a = np.array(fps, np.int64).view(np.uint64)
            b = None if alone else np.array(fps2, np.int64).view(np.uint64)
            names = ids if alone else ids + ids2
            for x, y in forest(a, b, radius):
                yield names[x], names[y]

    return map_rows(pairs, compare, "a long, b long")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """(doc_id, fp, component_id): the fingerprint and the smallest id reachable over links."""
    found = fingerprints(docs, doc_id, text)
    known = found.where(F.col("doc_id").isNotNull())
    classes = checkpointed(known.groupBy("fp").agg(F.min("doc_id").alias("id")))
    roots = connected(tile_links(classes, radius))
    labelled = classes.join(roots, classes["id"] == roots["node"], "left").select(
        "fp", F.coalesce("root", "id").alias("component_id")
    )
    joined = found.join(labelled, "fp", "left")
    return joined.select("doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))
