from __future__ import annotations

from pyspark.sql import SparkSession
import pytest

TEXTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark: SparkSession):
    """Documents from (id, text) pairs, with extra columns whose names clash with outputs."""

    def make(pairs, extra=("n_words", "score", "shard", "row", "key", "fp", "pos", "term")):
        rows = [(i, t, None, "s", None, *("x" for _ in extra)) for i, t in pairs]
        schema = TEXTS + "".join(f", {name} string" for name in extra)
        return spark.createDataFrame(rows, schema)

    return make
