"""Byte-level BPE with tiktoken and a local rank file.

Nulls count as empty texts and give no ids. Extra columns pass through unchanged; a column named like
the output is replaced. An empty table gives an empty table.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
import regex
import tiktoken

MAX_RANK_FILE = 64 << 20
LONG_TEXT = 1 << 16
# No match of a byte-level pattern runs on from another character into white space, or from an ASCII
# letter or digit into ASCII punctuation, and none looks behind itself: a text may be cut there.
BOUNDARY = regex.compile(r"(?<=[^\s\x1c-\x1f\x85])(?=[ \n\r\t])|(?<=[A-Za-z0-9])(?=[!-/:-@\[-`{-~])")


def read_ranks(path: str) -> bytes:
    """The rank file; it is small and of fixed size, and is refused beyond 64 MB."""
    if os.path.getsize(path) > MAX_RANK_FILE:
        raise ValueError(f"{path} is larger than {MAX_RANK_FILE} bytes")
    with open(path, "rb") as source:
        return source.read()


def encoding(ranks: bytes, pattern: str) -> tiktoken.Encoding:
    pairs = (line.split() for line in ranks.splitlines() if line)
    merges = {base64.b64decode(token): int(rank) for token, rank in pairs}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=merges, special_tokens={})


def pieces(text: str, limit: int = LONG_TEXT) -> Iterator[str]:
    """Cut a long text at safe boundaries into pieces of about ``limit`` characters."""
    start = 0
    while len(text) - start > limit:
        found = BOUNDARY.search(text, start + limit)
        if found is None:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:]


def token_ids(encoder: tiktoken.Encoding, text: str | None, limit: int = LONG_TEXT) -> np.ndarray:
    parts = [np.array(encoder.encode_ordinary(p), dtype=np.int32) for p in pieces(text or "", limit)]
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def list_array(each: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *(len(x) for x in each)], dtype=np.int32)
    return pa.ListArray.from_arrays(ends, np.concatenate(each) if each else np.zeros(0, np.int32))


def encode(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", output: str = "ids") -> DataFrame:
    """Add the token ids of the whole text as ``array<int>``, without special tokens."""
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    @F.arrow_udf("array<int>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = encoding(ranks.value, pattern)
        for batch in batches:
            yield list_array([token_ids(encoder, value.as_py()) for value in batch])

    return docs.withColumn(output, ids(F.col(text)))


def decode(frame: DataFrame, ranks_path: str, pattern: str, ids: str = "ids", output: str = "decoded") -> DataFrame:
    """Add the raw bytes that the ids stand for; ids of a cut-up character need not be valid UTF-8."""
    ranks = frame.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    @F.arrow_udf("binary")
    def raw(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        decoder = encoding(ranks.value, pattern)
        for batch in batches:
            # one document's ids at a time: as Python integers they take eight times the room
            yield pa.array([decoder.decode_bytes(row.as_py() or []) for row in batch], type=pa.binary())

    return frame.withColumn(output, raw(F.col(ids)))


def round_trip(
    docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", ids: str = "ids", decoded: str = "decoded"
) -> DataFrame:
    """``encode`` and ``decode`` in one pass and one Python worker per task."""
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    @F.arrow_udf("struct<ids: array<int>, decoded: binary>")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = encoding(ranks.value, pattern)
        for batch in batches:
            each = [token_ids(coder, value.as_py()) for value in batch]
            raw = pa.array([coder.decode_bytes(x.tolist()) for x in each], type=pa.binary())
            yield pa.StructArray.from_arrays([list_array(each), raw], names=["ids", "decoded"])

    coded = docs.withColumn("_coded", both(F.col(text)))
    return coded.withColumns({ids: F.col("_coded.ids"), decoded: F.col("_coded.decoded")}).drop("_coded")
