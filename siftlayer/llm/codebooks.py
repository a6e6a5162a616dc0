"""Vector codes by codebooks of parts, fitted with per-dimension value dictionaries.

Vectors of whole numbers repeat their values: a block of vectors holds few
distinct ones in each dimension.  Such a block is stored as one row, for every
dimension a dictionary of its distinct values and each vector's place in it.  To
assign the parts, the squared differences of each distinct value to all entries of
a codebook are tabulated once; the distance of a part to every entry is then a
gather from the tables of its dimensions and a sum.  All rounds read the packed
blocks and need neither the vectors nor a product.

A task adds up its parts by entry, so a round sends one row for each task, part
and entry; what reaches the driver is the codebooks alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Workspace

SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2
#: Vectors of a block; its dictionaries cannot be longer.
BLOCK = 4096
#: Squares of differences, added over 128 dimensions, stay below 2^63.
LARGEST = 2**27
#: Totals of labels up to this many, some 50 MB, are sent to every task.
FEW_LABELS = 1_000_000
_SALTS = 64
_PACKED = "id array<bigint>, label array<string>, sizes array<int>, values binary, places binary"


@dataclass(frozen=True)
class Compressed:
    """``rows`` have ``vec_id``, ``label`` as text, ``code``, a byte for each part, and ``error``.

    ``codebooks`` holds an array of entries for each part.
    """

    rows: DataFrame
    codebooks: list[np.ndarray]

    def digest(self) -> str:
        """SHA-256 of all entries' components, by part, entry and place, joined by commas."""
        numbers = (str(x) for book in self.codebooks for x in book.ravel().tolist())
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def whole_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``id``, ``label`` and ``v``, each component times ``scale`` rounded down; unusable vectors are left out."""
    raw = vectors.select(
        vectors["vec_id"].cast("long").alias("id"),
        vectors["label"].cast("string").alias("label"),
        vectors["embedding"].cast("array<double>").alias("raw"),
    )
    unusable = F.exists("raw", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    bound = F.lit(float(LARGEST))
    whole = F.transform("raw", lambda x: F.floor(F.greatest(-bound, F.least(bound, x * scale))).cast("long"))
    return raw.where(F.col("raw").isNotNull() & ~unusable).select("id", "label", whole.alias("v"))


def _common_length(rows: DataFrame) -> int | None:
    """The length that most vectors have; the smaller of equally frequent ones."""
    found = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.col("count").desc(), "n").first()
    return found["n"] if found else None


def _first_entries(rows: DataFrame, count: int, dim: int) -> np.ndarray:
    """The ``count`` vectors with the smallest ids; found in two steps, so that no task gets some of every other."""
    keys = [F.col("id").asc_nulls_last(), "v"]
    salted = rows.select("id", "v", F.pmod(F.spark_partition_id(), F.lit(_SALTS)).alias("salt"))
    place = F.row_number().over(Window.partitionBy("salt").orderBy(*keys))
    some = salted.withColumn("place", place).where(F.col("place") <= count)
    found = [r["v"] for r in some.orderBy(*keys).limit(count).select("v").collect()]
    return np.array(found, np.int64).reshape(len(found), dim)


def pack_block(matrix: np.ndarray) -> tuple[list[int], bytes, bytes]:
    """Dictionary sizes, dictionary values and places in them, dimension by dimension."""
    sizes, values, places = [], [], []
    for column in matrix.T:
        own, at = np.unique(column, return_inverse=True)
        sizes.append(len(own))
        values.append(own.astype(np.int64))
        places.append(at.astype(np.uint16))
    return sizes, b"".join(x.tobytes() for x in values), b"".join(x.tobytes() for x in places)


def _packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for start in range(0, len(batch), BLOCK):
            some = batch.iloc[start : start + BLOCK]
            sizes, values, places = pack_block(np.stack(some["v"].to_numpy()).astype(np.int64))
            # Ids as objects: with a null, pandas would make doubles of them.
            ids = [None if pd.isna(i) else int(i) for i in some["id"]]
            labels = [None if x is None else x for x in some["label"]]
            yield pd.DataFrame(
                {"id": [ids], "label": [labels], "sizes": [sizes], "values": [values], "places": [places]}
            )


def _unpacked(sizes: np.ndarray, values: bytes, places: bytes, rows: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Dictionary and places of each dimension."""
    ends = np.cumsum(sizes)
    own, at = np.frombuffer(values, np.int64), np.frombuffer(places, np.uint16).reshape(len(sizes), rows)
    for number, end in enumerate(ends):
        yield own[end - sizes[number] : end], at[number]


def cut(dim: int, parts: int) -> list[slice]:
    """The dimensions of each part; the first ones get one more where parts cannot be equal."""
    ends = np.cumsum([dim // parts + (i < dim % parts) for i in range(parts)])
    return [slice(a, b) for a, b in zip(np.append(0, ends[:-1]).tolist(), ends.tolist(), strict=True)]


def assigned(dictionaries: list[tuple[np.ndarray, np.ndarray]], book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each vector's part, the lower of equally near ones, and its squared distance."""
    rows = len(dictionaries[0][1]) if dictionaries else 0
    total = np.zeros((rows, len(book)), np.int64)
    for number, (values, at) in enumerate(dictionaries):
        table = (values[:, None] - book[None, :, number]) ** 2
        total += table[at]
    nearest = total.argmin(axis=1)
    return nearest, total[np.arange(rows), nearest]


def _block(row) -> tuple[list, int]:
    rows = len(row.id)
    return list(_unpacked(np.asarray(row.sizes), row.values, row.places, rows)), rows


def _sums(books: list[np.ndarray], slices: list[slice]):
    """Counts and componentwise sums of a task's parts, one row for each part and entry in use."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = [np.zeros((len(book), book.shape[1] + 1), np.int64) for book in books]
        for batch in batches:
            for row in batch.itertuples(index=False):
                dims, rows = _block(row)
                for book, dim, own in zip(books, slices, sums, strict=True):
                    if book.shape[1]:
                        nearest, _ = assigned(dims[dim], book)
                        own[:, 0] += np.bincount(nearest, minlength=len(book))
                        for number, (values, at) in enumerate(dims[dim], 1):
                            np.add.at(own[:, number], nearest, values[at])
        out = [
            (part, entry, int(own[entry, 0]), own[entry, 1:].tolist())
            for part, own in enumerate(sums)
            for entry in np.flatnonzero(own[:, 0]).tolist()
        ]
        yield pd.DataFrame(out, columns=["part", "entry", "count", "sums"])

    return run


def _coded(books: list[np.ndarray], slices: list[slice]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                dims, rows = _block(row)
                code, error = np.zeros((rows, len(books)), np.uint8), np.zeros(rows, np.int64)
                for part, (book, dim) in enumerate(zip(books, slices, strict=True)):
                    if book.shape[1]:
                        code[:, part], distance = assigned(dims[dim], book)
                        error += distance
                ids = pd.array([None if pd.isna(i) else int(i) for i in row.id], dtype="Int64")
                codes = [bytes(c) for c in code]
                yield pd.DataFrame({"vec_id": ids, "label": list(row.label), "code": codes, "error": error})

    return run


def _next_books(blocks: DataFrame, books: list[np.ndarray], slices: list[slice]) -> list[np.ndarray]:
    """Every entry in use replaced by the mean of its parts, rounded down."""
    per_task = blocks.mapInPandas(
        _sums(books, slices), "part int, entry int, count bigint, sums array<bigint>"
    )
    numbers = F.posexplode(F.concat(F.array("count"), "sums")).alias("at", "value")
    totals = per_task.select("part", "entry", numbers).groupBy("part", "entry", "at").agg(F.sum("value").alias("value"))
    found: dict[tuple[int, int], dict[int, int]] = {}
    for row in totals.collect():  # parts times entries times their width
        found.setdefault((row["part"], row["entry"]), {})[row["at"]] = row["value"]
    after = [book.copy() for book in books]
    for (part, entry), own in found.items():
        after[part][entry] = [own[i] // own[0] for i in range(1, books[part].shape[1] + 1)]
    return after


def compress_vectors(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE
) -> Compressed:
    """Codes of all usable vectors, and the codebooks they refer to.

    A component becomes ``floor(scale * x)``; beyond ``LARGEST`` it counts as
    that.  Vectors that are null or have a null or non-finite component take no
    part, nor do those that are not as long as most are (of equally frequent
    lengths, the smaller).  Parts that cannot be equal get one component more at
    the front.  Each codebook starts with the parts of the ``entries`` (at most
    256) smallest ids, of fewer where there are not so many; equal ids follow
    their vectors, rows without an id come last.  Repeated rows count as often as
    they come.  Without a usable vector there is no row and no entry.
    """
    if not 1 <= entries <= 256:
        raise ValueError(f"a code is one byte: entries must be 1 to 256, not {entries}")
    space = Workspace(vectors.sparkSession)
    rows = whole_vectors(vectors, scale)
    dim = _common_length(rows) or 0
    rows = rows.where(F.size("v") == dim)
    slices = cut(dim, parts)
    first = _first_entries(rows, entries, dim)
    books = [first[:, own] for own in slices]
    blocks = space.keep(rows.mapInPandas(_packed, _PACKED))
    if len(first):
        for _ in range(rounds):
            books = _next_books(blocks, books, slices)
    coded = blocks.mapInPandas(_coded(books, slices), "vec_id long, label string, code binary, error long")
    return Compressed(space.keep(coded), books)


def with_label_errors(rows: DataFrame) -> DataFrame:
    """``rows`` with ``label_error``, the sum of ``error`` over equal labels, nulls together.

    It is null where the sum has no 64-bit form.  Few totals are sent to every
    task; many meet the rows by label and a salt, so that no label is one group.
    """
    totals = rows.groupBy("label").agg(F.try_sum("error").alias("label_error"))
    totals = Workspace(rows.sparkSession).keep(totals).withColumnRenamed("label", "own_label")
    same = F.col("label").eqNullSafe(F.col("own_label"))
    if totals.limit(FEW_LABELS + 1).count() <= FEW_LABELS:
        return rows.join(F.broadcast(totals), same).drop("own_label")
    salted = totals.withColumn("own_salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    dealt = rows.withColumn("salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(_SALTS)).cast("int"))
    joined = dealt.join(salted, same & (F.col("salt") == F.col("own_salt")))
    return joined.drop("own_label", "salt", "own_salt")
