"""Quality classifier: gradient-boosted trees over statistics of the whole text.

The model learns from at most ``MAX_TRAINING_ROWS`` labelled documents of the training fold, the ones with
the smallest hash of their id, so the choice does not depend on partitioning; of an id with several texts
it learns from the one with the smallest hash. Every document is scored by
its text alone. Null and empty texts have the statistics of an empty text. Null labels are ignored, repeated
labels of a document are averaged, labels without a document have no effect, and without labels of both
kinds every document gets the smoothed share of label 1. Rows without an id are scored but never learnt from.
Texts are read whole, however long, repeated rows get the same score, and an empty table gives an empty table.
Extra columns pass through; columns named like the outputs are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import gbdt
from .common import in_training_fold, words

MAX_TRAINING_ROWS = 20_000
THRESHOLD = 0.3
CLASSES = (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b"!", b"?", b"|", b"#*$%&<>",
           b".,", b"'\"()-:;/", b"\n")
FEATURES = len(CLASSES) + 14


def statistics(text: str | None) -> np.ndarray:
    """Shares of character classes, word lengths, and repetition of words, pairs and lines."""
    raw = (text or "").encode()
    each = words(text)
    n, total = len(raw), len(each)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    share = 1 / max(n, 1)
    classes = [counts[list(c)].sum() * share for c in CLASSES]
    frequency: dict[bytes, int] = {}
    for w in each:
        frequency[w] = frequency.get(w, 0) + 1
    same = sum(a == b for a, b in pairwise(each))
    pairs = len(set(pairwise(each)))
    all_lines = [x for x in raw.split(b"\n") if x.strip()]
    marks = sum(w[-1] in b"!*#$%&|<>" for w in each)
    per_word, per_line = 1 / max(total, 1), 1 / max(len(all_lines), 1)
    letters = max(classes[0] + classes[1], 1e-9)
    return np.array(
        [
            *classes,
            counts[128:].sum() * share,
            classes[0] / letters,
            np.log1p(n),
            np.log1p(total),
            (n - counts[[9, 10, 11, 12, 13, 32]].sum()) * per_word,
            len(frequency) * per_word,
            max(frequency.values(), default=0) * per_word,
            same * per_word,
            pairs / max(total - 1, 1),
            marks * per_word,
            len(set(all_lines)) * per_line,
            total * per_line,
            max(map(len, all_lines), default=0) * share,
            sum(w.isupper() for w in each) * per_word,
        ],
        dtype=np.float64,
    )


def training_sample(docs: DataFrame, labels: DataFrame, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Statistics and labels of a bounded sample of the training fold, gathered on the driver."""
    chosen = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & in_training_fold(F.col("doc_id")))
        .groupBy(F.col("doc_id").alias("_labelled"))
        .agg((F.avg("quality") >= 0.5).cast("int").alias("_quality"))
        .orderBy(F.xxhash64("_labelled"), "_labelled")
        .limit(limit)
    )

    @F.arrow_udf("array<double>")
    def stats(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            yield pa.array([statistics(t) for t in batch.to_pylist()], type=pa.list_(pa.float64()))

    # at most `limit` ids and labels are broadcast
    rows = (
        docs.select(F.col("doc_id").alias("_doc"), "text")
        .join(F.broadcast(chosen), F.col("_doc") == F.col("_labelled"))
        .select("_labelled", "_quality", F.xxhash64("text").alias("_hash"), stats("text").alias("_x"))
        .groupBy("_labelled", "_quality")
        .agg(F.min_by("_x", "_hash").alias("_x"))
        .toArrow()
    )
    order = np.argsort(rows["_labelled"].to_numpy(), kind="stable")
    x = np.array(rows["_x"].to_pylist(), dtype=np.float64).reshape(-1, FEATURES)[order]
    return x, rows["_quality"].to_numpy()[order]


def fit(docs: DataFrame, labels: DataFrame, limit: int = MAX_TRAINING_ROWS) -> gbdt.Trees:
    return gbdt.fit(*training_sample(docs, labels, limit))


def score(model: gbdt.Trees, text: Column) -> Column:
    """Probability that a text has label 1."""

    @F.arrow_udf("double")
    def scores(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            x = np.array([statistics(t) for t in batch.to_pylist()]).reshape(-1, FEATURES)
            yield pa.array(model.score(x), type=pa.float64())

    return scores(text)


def classify(docs: DataFrame, labels: DataFrame, limit: int = MAX_TRAINING_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """The documents with ``held_out``, ``score`` and ``predicted``."""
    model = fit(docs, labels, limit)
    scored = docs.withColumn("score", score(model, F.col("text")))
    return scored.withColumns(
        {"held_out": ~in_training_fold(F.col("doc_id")), "predicted": (F.col("score") >= threshold).cast("int")}
    )
