"""Benchmark decontamination with a positional inverted index, in DataFrame operations only.

Words are runs of ASCII letters and digits and of all characters beyond ASCII, with A-Z lower-cased. The
index is a stored table of postings (row, document, position, term) of those corpus words that occur in
the benchmark, plus one posting of the empty term per row at the position after its last word. A window is
``size`` consecutive words of an item; a shorter item is one window.

Search starts from the ``LISTS`` rarest terms of each window. A posting at position p, for item position i,
gives the offset p - i at which the item would have to lie in the document. Only at offsets that the lists of
the rarest terms share are those of the other terms looked up; runs of a window's length or more are phrases.

Null and empty texts have no words; items without words or without an id match nothing. Repeated rows are
judged one by one, repeated item ids count as one item. Extra columns are ignored. Empty tables give empty
results.
"""

from __future__ import annotations

from dataclasses import dataclass
import string

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from ..session import checkpointed, scratch_path

WINDOW = 10
LISTS = 2
# Fixed value: everything that separates words, once A-Z are lower-cased.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Rows up to which a side is broadcast, after counting it; beyond, the join shuffles.
MAX_BROADCAST_TERMS = 200_000
MAX_BROADCAST_ROWS = 1_000_000


def words(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(lowered, SEPARATORS), "")


def _stored(df: DataFrame, name: str) -> DataFrame:
    """Written once to the shared folder, so lost executors or repeated reads cannot change row numbers."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _small(df: DataFrame, limit: int) -> DataFrame:
    """Hint a broadcast if a count shows that the table has at most ``limit`` short rows."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


@dataclass(frozen=True)
class Index:
    postings: DataFrame  # row, doc_id, pos, term
    items: DataFrame  # item, item_id, ipos, term, n (words of the item)

    @property
    def spark(self) -> SparkSession:
        return self.postings.sparkSession

    def rows(self) -> DataFrame:
        """One row per corpus row: row, doc_id, n_words."""
        return self.postings.where(F.col("term") == "").select("row", "doc_id", F.col("pos").cast("long").alias("n_words"))


def build(docs: DataFrame, benchmark: DataFrame) -> Index:
    """Store the items' words and the postings of the corpus."""
    numbered = benchmark.where(F.col("item_id").isNotNull()).select(
        F.monotonically_increasing_id().alias("item"), "item_id", words(F.col("text")).alias("words")
    )
    items = _stored(
        numbered.select("item", "item_id", F.size("words").alias("n"), F.posexplode("words").alias("ipos", "term")), "items"
    )
    terms = items.select("term").distinct().union(items.sparkSession.createDataFrame([("",)], "term string"))
    each = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", words(F.col("text")).alias("words"))
    exploded = each.select("row", "doc_id", F.posexplode(F.array_append("words", F.lit(""))).alias("pos", "term"))
    return Index(_stored(exploded.join(_small(terms, MAX_BROADCAST_TERMS), "term", "left_semi"), "postings"), items)


def rarest(index: Index, size: int = WINDOW, lists: int = LISTS) -> DataFrame:
    """(item, item_id, n, start, best): the positions and terms of the rarest terms of each window that can occur.

    ``best`` is an array of (frequency, ipos, term), the rarest first.
    """
    frequency = index.postings.groupBy("term").agg(F.count(F.lit(1)).alias("frequency"))
    counted = index.items.join(frequency, "term", "left").withColumn("frequency", F.coalesce("frequency", F.lit(0)))
    ahead = W.partitionBy("item").orderBy("ipos").rowsBetween(W.currentRow, size - 1)
    best = F.slice(F.sort_array(F.collect_list(F.struct("frequency", "ipos", "term")).over(ahead)), 1, lists)
    return (
        counted.select("item", "item_id", "n", F.col("ipos").alias("start"), best.alias("best"))
        .where(F.col("start") <= F.greatest(F.col("n") - size, F.lit(0)))
        .where(F.col("best")[0]["frequency"] > 0)
    )


def offsets(index: Index, size: int = WINDOW) -> DataFrame:
    """(row, item, offset): where the lists of a window's rarest terms, each shifted by its position, meet."""
    best = checkpointed(rarest(index, size))
    terms = best.select("item", F.explode("best").alias("b")).select("item", "b.ipos", "b.term").distinct()
    wanted = best.groupBy("item").agg(F.collect_set(F.sort_array("best.ipos")).alias("wanted"))
    met = (
        index.postings.join(_small(terms, MAX_BROADCAST_TERMS), "term")
        .select("row", "item", (F.col("pos") - F.col("ipos")).alias("offset"), "ipos")
        .groupBy("row", "item", "offset")
        .agg(F.collect_set("ipos").alias("met"))
    )
    complete = F.exists("wanted", lambda w: F.size(F.array_except(w, F.col("met"))) == 0)
    return met.join(_small(wanted, MAX_BROADCAST_TERMS), "item").where(complete).select("row", "item", "offset")


def phrases(index: Index, size: int = WINDOW) -> DataFrame:
    """(row, item_id, first, last): maximal runs of document positions where windows of an item occur."""
    offsets_ = _stored(offsets(index, size), "offsets")
    items = _small(index.items, MAX_BROADCAST_TERMS)
    expected = offsets_.join(items, "item").select(
        "row", "item", "item_id", "n", "offset", "ipos", "term", (F.col("offset") + F.col("ipos")).alias("pos")
    )
    near = index.postings.select("row", "pos", "term").join(
        _small(offsets_.select("row").distinct(), MAX_BROADCAST_ROWS), "row", "left_semi"
    )
    found = expected.join(near, ["row", "pos", "term"])
    line = W.partitionBy("row", "item", "offset").orderBy("ipos")
    runs = found.withColumn("run", F.col("ipos") - F.row_number().over(line))
    return (
        runs.groupBy("row", "item", "item_id", "n", "offset", "run")
        .agg(F.min("pos").alias("first"), F.max("pos").alias("last"))
        .where(F.col("last") - F.col("first") + 1 >= F.least(F.col("n"), F.lit(size)))
        .select("row", "item_id", "first", "last")
    )


def proximity(index: Index, slop: int, size: int = WINDOW) -> DataFrame:
    """(doc_id, item_id, start): windows whose every term occurs within ``size + slop`` words of a posting of
    the window's rarest term, in any order."""
    reach = size + slop
    anchors = rarest(index, size, 1).select("item", "item_id", "n", "start", F.col("best")[0]["term"].alias("term"))
    seeds = _stored(
        index.postings.join(anchors, "term").select("row", "doc_id", "item", "item_id", "n", "start", F.col("pos").alias("at")),
        "seeds",
    )
    wanted = (
        anchors.select("item", "start", "n")
        .join(index.items.select("item", "ipos", "term"), "item")
        .where(F.col("ipos").between(F.col("start"), F.col("start") + size - 1))
        .select("item", "start", "term")
        .distinct()
    )
    needed = wanted.groupBy("item", "start").agg(F.count(F.lit(1)).alias("needed"))
    block = F.floor(F.col("at") / reach)
    looked_for = seeds.join(wanted, ["item", "start"]).withColumn(
        "block", F.explode(F.array(block - 1, block, block + 1))
    )
    near = index.postings.select("row", "pos", "term", F.floor(F.col("pos") / reach).alias("block"))
    seen = (
        looked_for.join(near, ["row", "term", "block"])
        .where(F.abs(F.col("pos") - F.col("at")) <= reach)
        .groupBy("row", "doc_id", "item", "item_id", "start", "at")
        .agg(F.count_distinct("term").alias("seen"))
    )
    full = seen.join(needed, ["item", "start"]).where(F.col("seen") == F.col("needed"))
    return full.select("doc_id", "item_id", "start").distinct()


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_hit, items, contaminated) per corpus row; ``items`` are sorted as strings."""
    index = build(docs, benchmark)
    found = phrases(index, size)
    by_start = W.partitionBy("row").orderBy("first", "last", "item_id").rowsBetween(W.unboundedPreceding, -1)
    fresh = found.withColumn("covered", F.coalesce(F.max("last").over(by_start), F.lit(-1)))
    hits = fresh.groupBy("row").agg(
        F.sum(F.greatest(F.lit(0), F.col("last") - F.greatest(F.col("first") - 1, F.col("covered")))).alias("n_hit"),
        F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"),
    )
    joined = index.rows().join(hits, "row", "left")
    return joined.select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )
