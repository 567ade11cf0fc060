"""Drop lines that many documents share, except in the first document that holds them.

Lines are split at newlines; a null or empty text is one empty line. A line's key is the line stripped
of ASCII white space with A-Z lower-cased. Keys of at least ``min_length`` characters found in at least
``min_docs`` distinct documents lose all their lines except in the document with the smallest id.

Ids are integers or texts of integers; other texts fail the job. Rows with the same id count as one document and decide alike. A row without an id holds no key and
keeps all its lines. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
import hashlib

from pyspark.sql import DataFrame, functions as F

from .common import SPACES, map_rows

DROPPED = "array<binary>"


def lines(text: str | None) -> list[bytes]:
    return (text or "").encode().split(b"\n")


def line_key(line: bytes, min_length: int) -> bytes | None:
    """128-bit digest of a line's key, or None if the key is too short to count."""
    key = line.strip(SPACES).lower()
    if len(key) < min_length or len(key) < 4 * min_length and len(key.decode()) < min_length:
        return None
    return hashlib.md5(key).digest()


def shared_keys(docs: DataFrame, doc_id: str, text: str, min_length: int, min_docs: int) -> DataFrame:
    """Per (key, document) of keys with enough documents, where it has to go: (key, id).

    Counting goes through (key, document) pairs, so that a line in a third of all documents is counted
    by many tasks and only sums meet. The join back is a plain inner join, which adaptive execution
    splits where one key has very many documents.
    """

    def explode(rows: Iterator[tuple]) -> Iterable[tuple]:
        for ident, value in rows:
            for key in {line_key(line, min_length) for line in lines(value)} - {None}:
                yield ident, key

    located = docs.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).cast("long"), text)
    pairs = map_rows(located, explode, "id long, key binary").distinct()
    counted = pairs.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))
    shared = counted.where(F.col("n") >= min_docs).select("key", "first")
    return pairs.join(shared, "key").where(F.col("id") > F.col("first")).select("id", "key")


def dedup_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_length: int = 10, min_docs: int = 2
) -> DataFrame:
    """The documents with shared lines dropped from ``text``, plus ``n_lines`` and ``n_dropped``.

    Other columns pass through; columns already named ``n_lines`` or ``n_dropped`` are replaced.
    """
    gone = shared_keys(docs, doc_id, text, min_length, min_docs)
    per_doc = gone.groupBy(F.col("id").alias("_gone_id")).agg(F.collect_list("key").alias("_gone"))
    joined = docs.join(per_doc, F.col(doc_id).cast("long") == F.col("_gone_id"), "left")

    @F.arrow_udf("struct<text: string, n_lines: long, n_dropped: long>")
    def reassemble(texts, gone):
        import pyarrow as pa

        kept_texts, totals, dropped = [], [], []
        for value, keys in zip(texts.to_pylist(), gone.to_pylist()):
            all_lines = lines(value)
            drop = set(keys or ())
            kept = [x for x in all_lines if line_key(x, min_length) not in drop] if drop else all_lines
            kept_texts.append(b"\n".join(kept).decode())
            totals.append(len(all_lines))
            dropped.append(len(all_lines) - len(kept))
        columns = [pa.array(kept_texts, pa.string()), pa.array(totals, pa.int64()), pa.array(dropped, pa.int64())]
        return pa.StructArray.from_arrays(columns, names=["text", "n_lines", "n_dropped"])

    out = joined.withColumn("_kept", reassemble(F.col(text), F.col("_gone")))
    return out.withColumns(
        {text: F.col("_kept.text"), "n_lines": F.col("_kept.n_lines"), "n_dropped": F.col("_kept.n_dropped")}
    ).drop("_gone_id", "_gone", "_kept")
