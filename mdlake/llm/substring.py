"""Substring dedup over the De Bruijn graph of token k-mers.

Edges are the windows of ``k`` consecutive words. An edge of one document that also lies in a document with a
smaller id is repeated. Edges are dealt to buckets by their minimiser, the smallest hash of the ``M``-word
runs inside, as is usual for compacting such graphs: equal edges meet, and consecutive edges with the same
minimiser travel as one piece of a path. In a bucket each edge finds its source, the first place in the
smallest document. Repeated edges whose sources are consecutive too form a path without a branch; the pieces
of a path are compacted to one span over Spark, and each span is verified word by word against the place in
its source that its coordinates name. Words covered by a verified span are removed.

Inside a bucket edges are told apart by their minimiser and ``EDGE_BYTES`` bytes of their hash. If another edge of
a smaller document clashes, the span names a wrong source and is refused; at 5 bytes that happens to one edge in
10^12 per edge of its minimiser. Every window of a refused span is then looked up once more, by a 128-bit digest
in all documents, so a real repeat behind a clash is found too.

Common runs of words would make their bucket large. Edges are therefore counted by cell of their minimiser
first; edges of a cell beyond a share of a bucket travel one by one and are dealt by their own hash instead.

Where documents of one Arrow batch share a piece, only the one with the smallest id is sent on, since the
others are already decided: a passage that a third of all documents share costs one piece a batch.

Words are runs of characters other than ASCII white space; null and empty texts have none. Ids are integers or
texts of integers; other texts fail the job. Rows without an id
are neither sources nor changed. Repeated rows of an id are one document, and if their texts differ each is
held to its own words. Columns named like an output are replaced, other columns pass through, and an empty
table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
import gc
import time

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema
import xxhash
import zstandard

from ..session import checkpointed
from .common import words

K = 13
M = 4
BUCKET_BYTES = 16 << 20  # text per bucket; a task needs some twenty times that
EDGE_BYTES = 5  # of an edge's hash, beside the minimiser's eight
CELLS = 1 << 20  # in which edges are counted by minimiser
PLACES = 4096  # of one document that are looked up in one go
LOOKED_UP = 1 << 20  # windows of refused spans that one pass over the documents looks for
CELL_SHARE = 1 / 4  # of an average bucket: a cell with more edges is split, unless average cells are that large


def _constants(n: int, seed: int) -> np.ndarray:
    """Odd 64-bit multipliers."""
    return np.array([xxhash.xxh64_intdigest(bytes([i]), seed) | 1 for i in range(n)], np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def run_hashes(word_hashes: np.ndarray, size: int, seed: int) -> np.ndarray:
    """Hash of each run of ``size`` consecutive words."""
    n = len(word_hashes) - size + 1
    total = np.zeros(n, np.uint64)
    for j, c in enumerate(_constants(size, seed)):
        total += word_hashes[j : j + n] * c
    return _mixed(total)


def paths(hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(minimiser, first edge) of each run of edges with one minimiser, from at least ``k`` word hashes."""
    small, n = run_hashes(hashes, M, 1), len(hashes) - k + 1
    best = np.arange(n)
    for j in range(1, k - M + 1):  # leftmost smallest, which depends on the edge's words alone
        other = np.arange(j, j + n)
        best = np.where(small[other] < small[best], other, best)
    first = np.flatnonzero(np.concatenate([[True], best[1:] != best[:-1]]))
    return small[best[first]], first


def word_hashes(each: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, each), np.uint64, len(each))


def pieces(each: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``paths`` of a text's words, and all edge hashes in order."""
    if len(each) < k:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    hashes = word_hashes(each)
    return *paths(hashes, k), run_hashes(hashes, k, 2)


def _planes(values: np.ndarray, width: int) -> bytes:
    """Integers as byte planes, so that the leading zeros lie together."""
    return values.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def _unplanes(data: bytes, n: int, width: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(width, n).T
    return out.view("<i8").ravel()


def _packed(minimiser, doc, first, count, frags) -> tuple[bytes, bytes]:
    deltas = np.diff(doc, prepend=0)
    meta = _planes(deltas, 8) + _planes(first, 5) + _planes(count, 2)
    return zstandard.ZstdCompressor(level=3).compress(meta), minimiser.astype("<u8").tobytes() + frags.tobytes()


def _unpacked(meta: bytes, hashes: bytes):
    raw = zstandard.ZstdDecompressor().decompress(meta)
    n = len(raw) // 15
    doc = np.cumsum(_unplanes(raw[: 8 * n], n, 8))
    first, count = _unplanes(raw[8 * n : 13 * n], n, 5), _unplanes(raw[13 * n :], n, 2)
    minimiser = np.frombuffer(hashes[: 8 * n], "<u8")
    frags = np.zeros((int(count.sum()), 8), np.uint8)
    frags[:, :EDGE_BYTES] = np.frombuffer(hashes[8 * n :], np.uint8).reshape(-1, EDGE_BYTES)
    return minimiser, doc, first, count, frags.view("<u8").ravel()


def _take_runs(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indices starts[0], starts[0]+1, ... of all runs one after the other."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)


def _arrow(schema: str) -> tuple[T.StructType, pa.Schema]:
    struct = T.StructType.fromDDL(schema)
    return struct, to_arrow_schema(struct)


PIECES = "doc long, start long, n long, src long, src_start long"


def large_cells(docs: DataFrame, doc_id: str, text: str, k: int, share: float, cells: int) -> np.ndarray:
    """Whether a cell's edges travel one by one: true for every cell with at least ``share`` of all edges.

    A task tells of the cells with at least half that share of its own edges, at most 2 / share. What the tasks
    leave out of a cell is less than half the share of all edges, so sums of at least the other half decide.
    """
    struct, schema = _arrow("cell int, edges long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells, np.int64)
        for batch in batches:
            for value in batch.column(0):
                each = words(value.as_py())
                if len(each) >= k:
                    minimiser, first = paths(word_hashes(each), k)
                    np.add.at(total, (minimiser % np.uint64(cells)).astype(np.int64), np.diff(first, append=len(each) - k + 1))
        every = total.sum()
        told = np.flatnonzero(total >= max(1, every * share / 2))
        columns = np.append(told, -1), np.append(total[told], every)  # -1: all cells
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)

    each = docs.where(F.col(doc_id).isNotNull()).select(text).mapInArrow(run, struct)
    counts = checkpointed(each.groupBy("cell").agg(F.sum("edges").alias("edges")))
    every = counts.where("cell = -1").first()
    least = (every["edges"] if every else 0) * share / 2
    large = np.zeros(cells, bool)
    large[[r["cell"] for r in counts.where((F.col("cell") >= 0) & (F.col("edges") >= least)).collect()]] = True
    return large


def _dealt(docs: DataFrame, doc_id: str, text: str, k: int, buckets: int, large: np.ndarray) -> DataFrame:
    """(bucket, meta, hashes, done): per Arrow batch and bucket the pieces to look up, and the decided ones."""
    cells, packed = len(large), docs.sparkSession.sparkContext.broadcast(np.packbits(large))
    struct, schema = _arrow("bucket int, meta binary, hashes binary, done binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = np.unpackbits(packed.value, count=cells).astype(bool)
        for batch in batches:
            parts: list[tuple] = []
            for ident, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                minimiser, first, edges = pieces(words(value.as_py()), k)
                if len(first):
                    count = np.diff(first, append=len(edges))
                    parts.append((minimiser, np.full(len(first), ident), first, count, edges))
            if not parts:
                continue
            minimiser, doc, first, count, edges = (np.concatenate(x) for x in zip(*parts))
            alone = split[(minimiser % np.uint64(cells)).astype(np.int64)]
            times = np.where(alone, count, 1)
            offset = _take_runs(np.zeros_like(times), times)
            minimiser, doc, first, count, alone = (np.repeat(x, times) for x in (minimiser, doc, first, count, alone))
            first, count = first + offset, np.where(alone, 1, count)
            start = np.cumsum(count) - count
            place = np.arange(len(edges)) - np.repeat(start, count)
            content = np.add.reduceat(_mixed(edges + place.astype(np.uint64)), start)
            order = np.lexsort((first, doc, count, content, minimiser))
            head = np.ones(len(order), bool)
            head[1:] = (
                (minimiser[order[1:]] != minimiser[order[:-1]])
                | (content[order[1:]] != content[order[:-1]])
                | (count[order[1:]] != count[order[:-1]])
            )
            leader = order[np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))]
            decided = doc[order] > doc[leader]
            follower, source = order[decided], leader[decided]
            asking = np.sort(order[~decided])  # by document again, which packs better
            frags = edges.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :EDGE_BYTES]
            bucket = (np.where(alone, content, minimiser) % np.uint64(buckets)).astype(np.int64)
            told = doc[follower] % buckets
            own, own_told = bucket[asking], told
            by, by_told = np.argsort(own, kind="stable"), np.argsort(own_told, kind="stable")
            for b in np.union1d(own, own_told).tolist():
                lo, hi = np.searchsorted(own[by], [b, b + 1])
                at = asking[by[lo:hi]]
                meta, hashes = _packed(
                    minimiser[at], doc[at], first[at], count[at], frags[_take_runs(start[at], count[at])]
                )
                lo, hi = np.searchsorted(own_told[by_told], [b, b + 1])
                f, s = follower[by_told[lo:hi]], source[by_told[lo:hi]]
                rows = np.stack([doc[f], first[f], count[f], doc[s], first[s]]).astype("<i8")
                done = zstandard.ZstdCompressor(level=1).compress(rows.tobytes())
                yield pa.record_batch([pa.array([x], t) for x, t in zip((b, meta, hashes, done), schema.types)], schema=schema)

    located = docs.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).cast("long"), text)
    return located.mapInArrow(run, struct).repartitionById(buckets, "bucket")


def _found(minimiser, doc, first, count, frags) -> np.ndarray:
    """Pieces of repeated edges of one bucket, as columns of ``PIECES``."""
    _, inverse, times = np.unique(minimiser, return_inverse=True, return_counts=True)
    offset = np.cumsum(count) - count
    shared = np.flatnonzero(times[inverse] > 1)
    edge = _take_runs(offset[shared], count[shared])
    piece = np.repeat(shared, count[shared])
    place = first[piece] + edge - offset[piece]
    frag, group, owner = frags[edge], inverse[piece], doc[piece]
    order = np.lexsort((place, owner, frag, group))
    head = np.ones(len(order), bool)
    head[1:] = (group[order[1:]] != group[order[:-1]]) | (frag[order[1:]] != frag[order[:-1]])
    source = order[np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))]
    src, src_place = np.empty_like(owner), np.empty_like(place)
    src[order], src_place[order] = owner[source], place[source]
    at = np.flatnonzero(owner > src)  # in the order of piece and place
    new = np.ones(len(at), bool)
    a, b = at[1:], at[:-1]
    new[1:] = (piece[a] != piece[b]) | (place[a] != place[b] + 1) | (src[a] != src[b]) | (src_place[a] != src_place[b] + 1)
    starts = np.flatnonzero(new)
    i = at[starts]
    return np.stack([owner[i], place[i], np.diff(starts, append=len(at)), src[i], src_place[i]])


def repeated_pieces(docs: DataFrame, doc_id: str, text: str, k: int, buckets: int, large: np.ndarray) -> DataFrame:
    """(doc, start, n, src, src_start): runs of n repeated edges and where their source starts."""
    struct, schema = _arrow(PIECES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple] = []

        def out(columns: np.ndarray) -> pa.RecordBatch:
            return pa.record_batch([pa.array(c) for c in columns], schema=schema)

        for batch in batches:
            for meta, hashes, done in zip(batch["meta"], batch["hashes"], batch["done"]):
                told = np.frombuffer(zstandard.ZstdDecompressor().decompress(done.as_py()), "<i8").reshape(5, -1)
                if told.size:
                    yield out(told)
                parts.append(_unpacked(meta.as_py(), hashes.as_py()))
        if parts:
            found = _found(*(np.concatenate(x) for x in zip(*parts)))
            parts.clear()
            for i in range(0, found.shape[1], 1 << 16):
                yield out(found[:, i : i + (1 << 16)])

    return _dealt(docs, doc_id, text, k, buckets, large).mapInArrow(run, struct)


def compacted(pieces_: DataFrame, k: int) -> DataFrame:
    """(doc, start, len, src, src_start) in words: pieces that follow each other in both documents, joined."""
    path = ("doc", "src", "shift")
    line = W.partitionBy(*path).orderBy("start", "n")
    before = line.rowsBetween(W.unboundedPreceding, -1)
    shifted = pieces_.distinct().withColumn("shift", F.col("start") - F.col("src_start"))
    ends = shifted.withColumn("before", F.max(F.col("start") + F.col("n")).over(before))
    fresh = (F.col("before").isNull() | (F.col("start") > F.col("before"))).cast("long")
    numbered = ends.withColumn("path", F.sum(fresh).over(line.rowsBetween(W.unboundedPreceding, W.currentRow)))
    return (
        numbered.groupBy(*path, "path")
        .agg(F.min("start").alias("start"), F.max(F.col("start") + F.col("n")).alias("end"))
        .select(
            "doc", "start", (F.col("end") - F.col("start") + k - 1).alias("len"), "src", (F.col("start") - F.col("shift")).alias("src_start")
        )
    )


def digest(each: list[bytes], start: int, length: int) -> bytes:
    return xxhash.xxh3_128_digest(b" ".join(each[start : start + length]))


def in_slices(places: DataFrame) -> DataFrame:
    """(doc, places): the distinct (start, len) of each document, in as many rows as ``PLACES`` asks for."""
    number = F.pmod(F.xxhash64("start", "len"), F.ceil(F.col("n") / PLACES))
    sized = places.join(places.groupBy("doc").agg(F.count(F.lit(1)).alias("n")), "doc")
    return sized.groupBy("doc", number.alias("slice")).agg(F.collect_list(F.struct("start", "len")).alias("places")).drop("slice")


def verified(docs: DataFrame, spans: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The spans whose words are the same in both documents, with a digest of them.

    Every distinct place that a span or a source names is looked up once, in its own document; a document of which
    very many places are named gets several rows of at most some ``PLACES`` each.
    """
    here = spans.select("doc", "start", "len")
    there = spans.select(F.col("src").alias("doc"), F.col("src_start").alias("start"), "len")
    places = in_slices(here.union(there).distinct())

    @F.arrow_udf("array<struct<start: long, len: long, digest: binary>>")
    def digests(texts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("len", pa.int64()), ("digest", pa.binary())]))
        for values, asked in texts:
            out = []
            for value, wanted in zip(values, asked):
                each = words(value.as_py())
                out.append([{**p, "digest": digest(each, p["start"], p["len"])} for p in wanted.as_py()])
            yield pa.array(out, kind)

    looked_up = (
        docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("_text"))
        .join(places, "doc")
        .select("doc", F.explode(digests("_text", "places")).alias("p"))
        .select("doc", "p.start", "p.len", "p.digest")
        .distinct()
    )
    found = checkpointed(looked_up)
    sources = found.select(F.col("doc").alias("src"), F.col("start").alias("src_start"), "len", F.col("digest").alias("src_digest"))
    return (
        spans.join(found, ["doc", "start", "len"])
        .join(sources, ["src", "src_start", "len"])
        .where(F.col("digest") == F.col("src_digest"))
        .select("doc", "start", "len", "src", "src_start", "digest")
    )


def exact_sources(docs: DataFrame, refused: DataFrame, doc_id: str, text: str, k: int) -> DataFrame:
    """Single windows of refused spans with their first place in a smaller document, found by 128-bit digests.

    The windows' 64-bit hashes are looked for in passes over all documents, ``LOOKED_UP`` at a time, and only
    windows with such a hash are digested.
    """
    kind = pa.list_(pa.struct([("start", pa.int64()), ("edge", pa.int64()), ("digest", pa.binary())]))

    @F.arrow_udf("array<struct<start: long, edge: long, digest: binary>>")
    def windows(texts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for values, asked in texts:
            out = []
            for value, wanted in zip(values, asked):
                each = words(value.as_py())
                edges = run_hashes(word_hashes(each), k, 2).view(np.int64) if len(each) >= k else np.zeros(0, np.int64)
                spans = ((p["start"], p["start"] + p["len"] - k + 1) for p in wanted.as_py())
                at = sorted({i for first, last in spans for i in range(first, min(last, len(edges)))})
                out.append([{"start": i, "edge": int(edges[i]), "digest": digest(each, i, k)} for i in at])
            yield pa.array(out, kind)

    located = docs.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("_text"))
    asked = in_slices(refused.select("doc", "start", "len").distinct())
    wanted = checkpointed(
        located.join(asked, "doc").select("doc", F.explode(windows("_text", "places")).alias("w")).select("doc", "w.*").distinct()
    )
    edges = wanted.select("edge").distinct()
    rounds = -(-edges.count() // LOOKED_UP)
    struct, schema = _arrow("doc long, start long, digest binary")
    found = None
    for r in range(rounds):
        part = edges.where(F.pmod(F.xxhash64("edge"), F.lit(rounds)) == r).toArrow()["edge"].to_numpy()
        looked_for = docs.sparkSession.sparkContext.broadcast(np.sort(part))

        def search(batches: Iterator[pa.RecordBatch], looked_for=looked_for) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = []
                for ident, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                    each = words(value.as_py())
                    if len(each) >= k:
                        hit = np.flatnonzero(np.isin(run_hashes(word_hashes(each), k, 2).view(np.int64), looked_for.value))
                        rows += [(ident, int(i), digest(each, int(i), k)) for i in hit]
                columns = zip(*rows) if rows else ((), (), ())
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)

        hits = located.mapInArrow(search, struct).groupBy("digest").agg(F.min(F.struct("doc", "start")).alias("first"))
        found = hits if found is None else found.union(hits)
    source = found.groupBy("digest").agg(F.min("first").alias("first"))
    return wanted.join(source, "digest").where(F.col("doc") > F.col("first.doc")).select(
        "doc", "start", F.lit(k).cast("long").alias("len"), F.col("first.doc").alias("src"), F.col("first.start").alias("src_start"), "digest"
    )


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of frames that are no longer referenced.

    Spark's cleaner acts on what the JVM has collected; references through the plan take a second round.
    """
    for _ in range(3):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)


def repeated_spans(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = K, cells: int = CELLS
) -> DataFrame:
    """(doc, start, len, src, src_start, digest): verified maximal spans whose edges lie in a smaller document."""
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    buckets = max(1, -(-size // BUCKET_BYTES))
    large = large_cells(docs, doc_id, text, k, max(CELL_SHARE / buckets, 8 / cells), cells)
    spans = checkpointed(compacted(repeated_pieces(docs, doc_id, text, k, buckets, large), k))
    release(docs.sparkSession)
    proven = checkpointed(verified(docs, spans, doc_id, text))
    release(docs.sparkSession)
    refused = spans.join(proven, ["doc", "start", "len", "src", "src_start"], "left_anti")
    if refused.isEmpty():
        return proven
    return checkpointed(proven.union(exact_sources(docs, refused, doc_id, text, k)))


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = K) -> DataFrame:
    """The documents with ``text`` reduced to its kept words, joined by spaces, plus ``n_words`` and ``n_removed``."""
    spans = repeated_spans(docs, doc_id, text, k)
    per_doc = spans.groupBy(F.col("doc").alias("_doc")).agg(
        F.collect_set(F.struct("start", "len", "digest")).alias("_spans")
    )
    joined = docs.join(per_doc, F.col(doc_id).cast("long") == F.col("_doc"), "left")

    @F.arrow_udf("struct<text: string, n_words: long, n_removed: long>")
    def reduce(texts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for values, lists in texts:
            kept_texts, totals, removed = [], [], []
            for value, spans_of in zip(values, lists):
                each = words(value.as_py())
                keep = np.ones(len(each), bool)
                for s in spans_of.as_py() or ():
                    if digest(each, s["start"], s["len"]) == s["digest"]:
                        keep[s["start"] : s["start"] + s["len"]] = False
                left = int(keep.sum())
                kept = each if left == len(each) else [each[i] for i in np.flatnonzero(keep)]
                kept_texts.append(b" ".join(kept).decode())
                totals.append(len(each))
                removed.append(len(each) - left)
            columns = [pa.array(kept_texts, pa.string()), pa.array(totals, pa.int64()), pa.array(removed, pa.int64())]
            yield pa.StructArray.from_arrays(columns, names=["text", "n_words", "n_removed"])

    out = joined.withColumn("_kept", reduce(F.col(text), F.col("_spans")))
    return out.withColumns(
        {text: F.col("_kept.text"), "n_words": F.col("_kept.n_words"), "n_removed": F.col("_kept.n_removed")}
    ).drop("_doc", "_spans", "_kept")
