"""Quality rules, completed by an isolation forest over the rules' statistics.

A document that breaks a fixed rule is out. The others are judged by how few random splits separate their
statistics, as plain rates a word, from those of good documents. A tree splits the space of rates at random
places of its boxes, which do not depend on the documents, and then counts in each box all good documents of the
training fold, as shares of ``TREE_ROWS``. Boxes of at most one are split no further; a rate that good
documents hardly have ends in an empty box after few splits. The threshold is calibrated on all good and bad
documents of the training fold, so that at most ``FALSE_ALARMS`` of the good ones would be lost. Boxes are counted
in tasks, and so are scores, in steps of 1 / ``STEPS``: the driver sees counts, whose number does not
depend on the documents'. Rates count up to the ends of ``RANGES``, beyond which a document is as far out as it
can be.

Null and empty texts have no words and so break a rule; a text is read whole, however long. Without good
labelled rows nothing is rejected beyond the rules. Null labels are ignored and repeated ones averaged; of a
labelled id with several texts the one with the smallest hash teaches, and every row is judged by its own text.
Extra columns pass through; columns named like the outputs are replaced. An empty table gives an empty table.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import checkpointed
from .common import SPACES, in_training_fold, words

FALSE_ALARMS = 0.002
COST = 20
TREES, TREE_ROWS = 200, 1024
STEPS = 1 << 16
# Rates a word that trees split: characters, symbols, repeated lines and, up to the fixed rule's limit, repeated words.
RANGES = ((3.0, 9.0), (0.0, 0.5), (0.0, 0.05), (0.0, 0.5))
# The rules' limits and the characters that count as symbols.
LEAST_WORDS, MOST_REPEATED_PERCENT = 50, 50
SYMBOLS = "#*$%&|<>"
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(each: list[bytes], size: int = 3) -> int:
    """Words inside windows of ``size`` words that occur at least twice in the text."""
    if len(each) <= size:
        return 0
    numbers: dict[bytes, int] = defaultdict(count().__next__)
    ids = np.fromiter(map(numbers.__getitem__, each), np.int64, len(each))
    window = ids
    for k in range(1, size):
        window = np.unique(window[:-1] * len(numbers) + ids[k:], return_inverse=True)[1]
    again = np.bincount(window)[window] > 1
    covered = np.zeros(len(each), dtype=bool)
    for k in range(size):
        covered[k : k + len(again)] |= again
    return int(covered.sum())


def statistics(text: str | None) -> tuple[int, int, int, int, int]:
    value = text or ""
    each = words(value)
    spaces = sum(value.count(c) for c in SPACES.decode())
    with_words = [x for x in value.encode().split(b"\n") if x.strip(SPACES)]
    return (
        len(each),
        len(value) - spaces,
        sum(value.count(c) for c in SYMBOLS),
        len(with_words) - len(set(with_words)),
        repeated_words(each),
    )


def features(stats: np.ndarray) -> np.ndarray:
    """Rates a word, within ``RANGES``."""
    n = np.maximum(stats[:, 0], 1).astype(float)
    low, high = np.array(RANGES).T
    return np.clip(stats[:, 1:5] / n[:, None], low, high)


def breaks_rules(stats: np.ndarray) -> np.ndarray:
    return (stats[:, 0] < LEAST_WORDS) | (100 * stats[:, 4] > MOST_REPEATED_PERCENT * stats[:, 0])


@dataclass(frozen=True)
class Forest:
    feature: np.ndarray  # (trees, inner nodes) of complete trees
    threshold: np.ndarray
    path: np.ndarray  # (trees, leaves): expected path length
    scale: float
    limit: float  # scores above are anomalies

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """(rows, trees): the leaf of each tree that a row falls into."""
        inner, trees = self.feature.shape[1], np.arange(len(self.feature))
        node = np.zeros((len(x), len(trees)), dtype=np.int64)
        rows = np.arange(len(x))[:, None]
        while node.size and node[0, 0] < inner:
            node = 2 * node + 1 + (x[rows, self.feature[trees, node]] > self.threshold[trees, node])
        return node - inner

    def scores(self, x: np.ndarray) -> np.ndarray:
        """2 ** -(mean path length / expected length): near 1 for rows that few splits isolate."""
        if not len(self.feature):
            return np.zeros(len(x))
        return 2.0 ** -(self.path[np.arange(len(self.feature)), self.leaves(x)].mean(axis=1) / self.scale)

    def anomalous(self, x: np.ndarray) -> np.ndarray:
        parts = [self.scores(x[i : i + 4096]) > self.limit for i in range(0, len(x), 4096)]
        return np.concatenate(parts) if parts else np.zeros(0, bool)


def mean_path(n: float | np.ndarray) -> np.ndarray:
    """Mean path length of an unsuccessful search in a binary tree of n rows."""
    least = np.maximum(n, 2)
    return np.where(np.less(n, 2), 0.0, 2 * (np.log(least - 1) + np.euler_gamma) - 2 * (least - 1) / least)


def random_splits(trees: int = TREES, rows: int = TREE_ROWS, seed: int = 0) -> Forest:
    """Complete trees of random splits at random places of their boxes, which have no path lengths yet."""
    random = np.random.default_rng(seed)
    depth = int(np.ceil(np.log2(rows)))
    low, high = np.array(RANGES).T
    start, end = (np.broadcast_to(e, (trees, 1, len(RANGES))) for e in (low, high))
    features, cuts = [np.zeros((trees, 0), int)], [np.zeros((trees, 0))]
    for _ in range(depth):
        f = random.integers(len(RANGES), size=start.shape[:2])
        picked = f[..., None] == np.arange(len(RANGES))
        cut = random.uniform((start * picked).sum(2), (end * picked).sum(2))
        features.append(f)
        cuts.append(cut)
        left_end, right_start = np.where(picked, cut[..., None], end), np.where(picked, cut[..., None], start)
        start, end = (
            np.stack(halves, axis=2).reshape(trees, -1, len(RANGES)) for halves in ((start, right_start), (left_end, end))
        )
    return Forest(np.concatenate(features, 1), np.concatenate(cuts, 1), np.zeros((trees, 2**depth)), 1.0, np.inf)


def with_paths(splits: Forest, counts: np.ndarray, rows: int = TREE_ROWS) -> Forest:
    """Path lengths from the good rows in each (tree, leaf), taken as shares of ``rows`` where there are more.

    A box of at most one is not split, so all leaves below it have its path.
    """
    total = int(counts[0].sum())
    size = min(rows, total)
    if not total:
        return Forest(splits.feature[:0], splits.threshold[:0], splits.path[:0], 1.0, np.inf)
    trees, leaves = splits.path.shape
    depth = leaves.bit_length() - 1
    path = np.full((trees, leaves), -1.0)
    for level in range(depth + 1):
        boxes = counts.reshape(trees, 2**level, -1).sum(axis=2)
        held = boxes if total <= rows else boxes * (size / total)
        ends = np.where((held <= 1) | (level == depth), level + mean_path(held), -1.0)
        path = np.where(path >= 0, path, np.repeat(ends, leaves >> level, axis=1))
    return Forest(splits.feature, splits.threshold, path, max(float(mean_path(size)), 1.0), np.inf)


def leaf_counts(splits: Forest, x: np.ndarray) -> np.ndarray:
    """(trees, leaves): rows in each leaf."""
    trees, leaves = splits.path.shape
    counts = np.zeros(trees * leaves, dtype=np.int64)
    for i in range(0, len(x), 4096):
        cells = splits.leaves(x[i : i + 4096]) + leaves * np.arange(trees)
        counts += np.bincount(cells.ravel(), minlength=trees * leaves)
    return counts.reshape(trees, leaves)


def fit_forest(x: np.ndarray, good: np.ndarray, trees: int = TREES, rows: int = TREE_ROWS, seed: int = 0) -> Forest:
    """The forest of rows at hand: boxes count the good ones, the limit is calibrated on all."""
    splits = random_splits(trees, rows, seed)
    forest = with_paths(splits, leaf_counts(splits, x[good]), rows)
    if not good.any():
        return forest
    scores = np.concatenate([forest.scores(x[i : i + 4096]) for i in range(0, len(x), 4096)])
    return replace(forest, limit=calibrated(scores, good))


def calibrated(scores: np.ndarray, good: np.ndarray) -> float:
    """``calibrated_counts`` of rows at hand."""
    values, at = np.unique(scores, return_inverse=True)
    return calibrated_counts(values, np.bincount(at[good], minlength=len(values)), np.bincount(at[~good], minlength=len(values)))


def calibrated_counts(values: np.ndarray, good: np.ndarray, bad: np.ndarray, step: float = 0.0) -> float:
    """The limit that catches most bad rows at least cost, where a share of good rows lost counts ``COST``-fold.

    It never goes below the score that ``FALSE_ALARMS`` of the good rows exceed. ``good`` and ``bad`` count the
    rows of each of the ascending ``values``; with ``step``, a value stands for the scores of one step that ends with it.
    """
    up_to_good, up_to_bad = np.cumsum(good), np.cumsum(bad)
    rank = int(np.ceil((up_to_good[-1] - 1) * (1 - FALSE_ALARMS)))
    least = int(np.searchsorted(up_to_good, rank, "right"))
    lost = 1 - up_to_good[least:] / up_to_good[-1]
    caught = 1 - up_to_bad[least:] / max(1, up_to_bad[-1])
    gain = caught - COST * lost
    best = least + int(np.flatnonzero(gain == gain.max())[-1])
    return float((values[best] + values[best + 1] - step) / 2 if best + 1 < len(values) else values[best])


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(_labelled, _good, statistics): one row of each labelled id of the training fold that has a text.

    Of an id with several texts the one with the smallest hash counts.
    """
    marked = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & in_training_fold(F.col("doc_id")))
        .groupBy(F.col("doc_id").alias("_labelled"))
        .agg((F.avg("quality") >= 0.5).alias("_good"))
    )
    # statistics are taken before the join, so that no text is shuffled
    judged = with_statistics(docs.select("doc_id", "text")).select("doc_id", F.xxhash64("text").alias("_hash"), *STATISTICS)
    one = F.min_by(F.struct(*STATISTICS), "_hash").alias("_one")
    found = judged.join(marked, F.col("doc_id") == F.col("_labelled"))
    return found.groupBy("_labelled", "_good").agg(one).select("_labelled", "_good", "_one.*")


def _counted(rows: DataFrame, cells: Callable[[np.ndarray, np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """Counts of ``size`` cells: each task adds up ``cells(rates, good)`` of its rows that break no rule."""

    def count_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, dtype=np.int64)
        for batch in batches:
            stats, good = _arrays(batch)
            passing = ~breaks_rules(stats)
            counts += cells(features(stats[passing]), good[passing])
        held = np.flatnonzero(counts)
        yield pa.record_batch([pa.array(held), pa.array(counts[held])], names=["cell", "n"])

    sums = rows.mapInArrow(count_cells, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(size, dtype=np.int64)
    counts[sums["cell"].to_numpy()] = sums["n"].to_numpy()
    return counts


def _arrays(rows: pa.RecordBatch | pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(statistics, good) of training rows."""
    columns = [rows[name].to_numpy(zero_copy_only=False) for name in STATISTICS]
    return np.stack(columns, axis=1), rows["_good"].to_numpy(zero_copy_only=False).astype(bool)


def fit(docs: DataFrame, labels: DataFrame, limit: int | None = None) -> Forest:
    """Fit on all labelled documents of the training fold, counted in tasks.

    ``limit`` fits on the driver instead, on the documents with the smallest hash of their id.
    """
    rows = training_rows(docs, labels)
    if limit is not None:
        chosen = rows.orderBy(F.xxhash64("_labelled"), "_labelled").limit(limit).toArrow().sort_by("_labelled")
        stats, good = _arrays(chosen.combine_chunks())
        passing = ~breaks_rules(stats)
        return fit_forest(features(stats[passing]), good[passing])
    rows = checkpointed(rows)
    splits = random_splits()
    boxes = _counted(rows, lambda x, good: leaf_counts(splits, x[good]).ravel(), splits.path.size)
    forest = with_paths(splits, boxes.reshape(splits.path.shape))
    if not boxes.any():
        return forest

    def score_cells(x: np.ndarray, good: np.ndarray) -> np.ndarray:
        parts = [np.ceil(forest.scores(x[i : i + 4096]) * STEPS) for i in range(0, len(x), 4096)]
        at = np.concatenate(parts).astype(np.int64) if parts else np.zeros(0, np.int64)
        return np.bincount(at + (STEPS + 1) * good, minlength=2 * (STEPS + 1))

    bad, good = _counted(rows, score_cells, 2 * (STEPS + 1)).reshape(2, -1)
    held = np.flatnonzero(bad + good)
    return replace(forest, limit=calibrated_counts(held / STEPS, good[held], bad[held], 1 / STEPS))


def _judge(docs: DataFrame, forest: Forest | None) -> DataFrame:
    names = [*STATISTICS, "base_failed", "kept"]
    kinds = ["long"] * len(STATISTICS) + ["boolean"] * 2

    @F.arrow_udf("struct<" + ", ".join(f"{n}: {k}" for n, k in zip(names, kinds)) + ">")
    def judge(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            stats = np.array([statistics(t) for t in batch.to_pylist()], dtype=np.int64).reshape(-1, len(STATISTICS))
            failed = breaks_rules(stats)
            kept = ~failed & ~forest.anomalous(features(stats)) if forest else ~failed
            yield pa.StructArray.from_arrays([pa.array(c) for c in (*stats.T, failed, kept)], names=names)

    judged = docs.withColumn("_judged", judge(F.col("text")))
    return judged.withColumns({n: F.col(f"_judged.{n}") for n in names}).drop("_judged")


def with_statistics(docs: DataFrame) -> DataFrame:
    """The documents with the rule statistics and ``base_failed``."""
    return _judge(docs, None).drop("kept")


def apply_rules(docs: DataFrame, labels: DataFrame, limit: int | None = None) -> DataFrame:
    """The documents with the rule statistics, ``base_failed`` and ``kept``; ``limit`` as in ``fit``."""
    return _judge(docs, fit(docs, labels, limit))
