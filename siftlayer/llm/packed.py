"""Round trips between chunks of documents and buckets of keys.

Some operators need to know something about every position or word of the
corpus that only the whole corpus can tell: whether it occurs elsewhere, or how
often.  One row for each would be too many.  Here a *chunk*, some megabytes of
documents, sends one row of packed keys to each *bucket*, a range of key hashes;
the bucket answers with a packed row for each chunk.  The documents cross the
network once: all passes over the chunks stand in one plan, in which Spark
reuses that exchange, and a lost executor's share is made again from its
lineage.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK_BYTES = 4 * 2**20
BUCKET_BYTES = 32 * 2**20
LEAST_BITS = 5

MESSAGE = "chunk long, bucket int, step int, a binary, b binary, c binary, d binary"
_FIELDS = ("chunk", "bucket", "step", "a", "b", "c", "d")


class Chunks:
    """Documents dealt into chunks by a hash of their place in the table, copies like any others.

    ``bits`` says how many leading bits of a key hash name its bucket; both
    numbers follow the bytes of all texts, so that neither a chunk nor a bucket
    grows with the corpus.  ``carry``, a string, travels with each document.
    """

    def __init__(
        self,
        docs: DataFrame,
        carry: Column | None = None,
        chunk_bytes: int = CHUNK_BYTES,
        bucket_bytes: int = BUCKET_BYTES,
    ) -> None:
        text = F.coalesce(docs["text"].cast("string"), F.lit(""))
        total = docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
        count = max(1, -(-total // chunk_bytes))
        self.bits = max(LEAST_BITS, (max(1, total) // bucket_bytes).bit_length())
        doc_id = docs["doc_id"].cast("long")
        chunk = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(count)).alias("chunk")
        carried = (F.lit(None).cast("string") if carry is None else carry).alias("carry")
        self.docs = docs.select(doc_id.alias("doc_id"), text.alias("text"), carried, chunk)

    def send(self, make: Callable[[pd.DataFrame], Iterator], answers: list[DataFrame] = (), schema: str = MESSAGE):
        """What ``make`` returns for each chunk, given its documents and the answers to it."""
        grouped = self.docs.groupBy("chunk")
        if not answers:
            return grouped.applyInPandas(make, schema)
        got = reduce(DataFrame.unionByName, answers)

        def with_answers(docs: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
            return make(docs, rows)

        return grouped.cogroup(got.groupBy("chunk")).applyInPandas(with_answers, schema)


def answer(messages: DataFrame, make: Callable[[pd.DataFrame], pd.DataFrame]) -> DataFrame:
    """What ``make`` returns for each bucket; it has one row for each chunk that wrote to it."""
    return messages.groupBy("bucket").applyInPandas(make, MESSAGE)


def answer_with(messages: DataFrame, table: DataFrame, make: Callable[..., pd.DataFrame]) -> DataFrame:
    """As ``answer``, with the rows of a table that is kept by bucket as well."""

    def with_table(rows: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        return make(rows, own)

    return messages.groupBy("bucket").cogroup(table.groupBy("bucket")).applyInPandas(with_table, MESSAGE)


def message_rows(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=list(_FIELDS))


def bucket_edges(keys: np.ndarray, bits: int) -> np.ndarray:
    """Where each bucket begins in sorted 64-bit keys, and the end."""
    starts = np.arange(2**bits, dtype=np.uint64) << np.uint64(64 - bits)
    return np.append(np.searchsorted(keys, starts), len(keys))


def in_bucket_order(rows: pd.DataFrame, step: int, field: str, kind, counts: np.ndarray | None = None) -> np.ndarray:
    """One packed column of all answers of a step, in the order of the sorted keys.

    With ``counts``, the entries of each bucket, the column holds single bits.
    """
    own = rows[rows["step"] == step].sort_values("bucket")
    if counts is None:
        parts = [np.frombuffer(x, kind) for x in own[field]]
    else:
        parts = [unpack_bits(x, counts[bucket]) for bucket, x in zip(own["bucket"], own[field], strict=True)]
    return np.concatenate(parts) if parts else np.empty(0, kind)


def pack_bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def unpack_bits(data: bytes, count: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=int(count)).astype(bool)


def lengths_of(column: pd.Series, width: int) -> np.ndarray:
    return np.array([len(x) // width for x in column], np.int64)


def joined(column: pd.Series, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column), kind)


_MIX_1, _MIX_2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = x * _MIX_1
    x ^= x >> np.uint64(32)
    x *= _MIX_2
    x ^= x >> np.uint64(29)
    return x
