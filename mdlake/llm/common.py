"""Words, digests and table access shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

# The characters that separate words, and those stripped from line ends.
SPACES = b" \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: str | None) -> list[bytes]:
    """Maximal runs of characters other than ASCII white space, as UTF-8; null has none."""
    return (text or "").encode().split()  # bytes.split() separates at exactly the SPACES


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def map_rows(df: DataFrame, rows: Callable[[Iterator[tuple]], Iterable[tuple]], schema: str) -> DataFrame:
    """``mapInArrow`` for a function from an iterator of row tuples to an iterable of row tuples.

    Rows stream through in Arrow batches, and results leave in batches of at most 4,096 rows or about
    16 MB of text, so a task holds one batch at a time however large its partition is.
    """
    struct = T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(struct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def source() -> Iterator[tuple]:
            for batch in batches:
                for i in range(batch.num_rows):  # one row at a time as Python objects
                    yield tuple(column[i].as_py() for column in batch.columns)

        def pack(out: list[tuple]) -> pa.RecordBatch:
            columns = zip(*out)
            return pa.record_batch(
                [pa.array(c, type=arrow.field(i).type) for i, c in enumerate(columns)], schema=arrow
            )

        out: list[tuple] = []
        size = 0
        for row in rows(source()):
            out.append(row)
            size += sum(len(v) for v in row if isinstance(v, (str, bytes, list)))
            if len(out) >= 4096 or size > 1 << 24:
                yield pack(out)
                out, size = [], 0
        if out:
            yield pack(out)

    return df.mapInArrow(run, struct)


def joined_sha256(array: Column, separator: str) -> Column:
    return F.sha2(F.array_join(array.cast("array<string>"), separator), 256)


def in_training_fold(doc_id: Column, folds: int = 5) -> Column:
    """Rows whose crc32 of the id's decimal text is not 0 modulo ``folds``; a null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")), F.lit(0)) % folds != 0
