"""Bars from the two wide layouts the terminal produces."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
import re

from pyspark.sql import DataFrame, functions as F

from ..functions.codes import CODE_SUFFIX

KEYS = ("ts_code", "trade_time")


def keys_first(df: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Key columns first, the others in their given order."""
    present = [k for k in keys if k in df.columns]
    return df.select(*present, *[c for c in df.columns if c not in present])


def bars_from_code_frames(frames: DataFrame, code: str, index: str = "index") -> DataFrame:
    """Per-code frames landed together: the code comes from a column (file name or partition).

    A time column called ``index`` is renamed; keys go first.
    """
    df = frames
    if index in df.columns and "trade_time" not in df.columns:
        df = df.withColumnRenamed(index, "trade_time")
    if code != "ts_code":
        df = df.withColumn("ts_code", F.col(code).cast("string")).drop(code)
    return keys_first(df)


def _codes_are_columns(labels: list[str]) -> bool:
    return bool(labels) and all(re.search(CODE_SUFFIX.replace(r"\z", "$"), c.strip().upper()) for c in labels)


def bars_from_matrices(matrices: Mapping[str, DataFrame], label: str) -> DataFrame:
    """One matrix per field (rows x columns labelled by codes and times) to one long table.

    Matrices whose column labels are all codes have times as rows; any other layout has codes as
    rows. Cells are unpivoted with their NULLs and the fields are put side by side again with one
    grouped pass instead of one join per field.
    """
    long = []
    for field, matrix in matrices.items():
        labels = [c for c in matrix.columns if c != label]
        rows, columns = ("trade_time", "ts_code") if _codes_are_columns(labels) else ("ts_code", "trade_time")
        quoted = [F.col(f"`{c}`") for c in labels]  # codes contain dots
        cells = matrix.withColumnRenamed(label, rows).unpivot([rows], quoted, columns, "cell")
        long.append(cells.select(*KEYS, F.lit(field).alias("field"), F.col("cell").cast("double").alias("cell")))
    stacked = reduce(DataFrame.unionByName, long)
    side_by_side = [F.max(F.when(F.col("field") == f, F.col("cell"))).alias(f) for f in matrices]
    return stacked.groupBy(*KEYS).agg(*side_by_side)
