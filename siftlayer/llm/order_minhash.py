"""Order MinHash fingerprints: likeness that follows edit distance.

Every k-mer of a text counts with the number of its occurrence before it, so that
repeats are told apart.  A hash deals the numbered k-mers into ``BINS`` bins; in
each bin the ``TUPLE`` least hashes are selected, put back into the order of the
text, and hashed together.  Two texts are alike as far as their tuples are
equal: moving text about changes the order and thus the tuples, which a plain
MinHash would not see.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .packed import mixed

K = 8
BINS = 64
TUPLE = 2
RANGE_BYTES = 12 * 2**20
MOST_RANGES = 2**16
_U = np.uint64
_FACTOR = _U(0x9FB21C651E98DF25)


def _kmers(codes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k-mers of a text by code points; a shorter text is one k-mer.

    ``k`` is a power of two.
    """
    if len(codes) < k:
        codes = np.concatenate([codes, np.full(k - len(codes), 2**21 - 1, codes.dtype)]) if len(codes) else codes
    wide, reach = codes.astype(_U), 1
    while reach < k:
        head = wide[:-reach] << _U(21) if reach == 1 else wide[:-reach] * _FACTOR
        wide, reach = mixed(head + wide[reach:]), reach * 2
    return wide


def _numbered(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of k-mers with the number of equal ones before them, and their places."""
    bits = _U(max(12, len(hashes).bit_length()))
    ordered = np.sort(hashes >> bits << bits | np.arange(len(hashes), dtype=_U))
    place, key = ordered & ((_U(1) << bits) - _U(1)), ordered >> bits
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    at = np.arange(len(key))
    number = at - np.maximum.accumulate(np.where(new, at, 0))
    return mixed(key + number.astype(_U) * _FACTOR), place.astype(np.int64)


def tuples(text: np.ndarray, k: int = K, bins: int = BINS, size: int = TUPLE) -> np.ndarray:
    """One 32-bit hash for each bin, of its selected k-mers in text order; 0 for an empty bin."""
    out = np.zeros(bins, np.uint32)
    if not len(text):
        return out
    hashes, place = _numbered(_kmers(text, k))
    enough = 8 * bins * size
    if len(hashes) > 2 * enough:
        # Of this many, the least of every bin are nearly always among; if not, all are looked at.
        near = hashes < _U(2**64 // len(hashes) * enough)
        if np.bincount((hashes[near] & _U(bins - 1)).astype(np.int64), minlength=bins).min() >= size:
            hashes, place = hashes[near], place[near]
    bin_ = (hashes & _U(bins - 1)).astype(np.int64)
    order = np.lexsort((hashes, bin_))
    starts = np.searchsorted(bin_[order], np.arange(bins))
    order = order[np.arange(len(order)) - starts[bin_[order]] < size]
    order = order[np.lexsort((place[order], bin_[order]))]
    starts = np.searchsorted(bin_[order], np.arange(bins + 1))
    total = np.zeros(bins, _U)
    for turn in range(size):
        has = np.nonzero(starts[:-1] + turn < starts[1:])[0]
        total[has] = mixed(total[has] * _FACTOR + hashes[order[starts[has] + turn]])
    full = starts[1:] > starts[:-1]
    out[full] = (total[full] >> _U(32)).astype(np.uint32) | np.uint32(1)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the bins filled in either fingerprint whose tuples are equal; 1 for two empty texts."""
    filled = (a != 0) | (b != 0)
    return float((a == b)[filled].mean()) if filled.any() else 1.0


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


_COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
_SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
    " near_edited double, near_next double"
)


def _hex(prints: np.ndarray) -> str:
    return prints.astype(">u4").tobytes().hex()


class _Read(NamedTuple):
    """A document and what is computed of its text once."""

    part: int
    doc_id: int | None
    text: str
    codes: np.ndarray
    own: np.ndarray


def _compared(document: _Read, after: _Read) -> tuple:
    """The row of a document that ``after`` follows."""
    half = len(document.codes) // 2
    edited = document.text[: len(document.text) - half] + after.text[:half]
    other = tuples(np.concatenate([document.codes[: len(document.codes) - half], after.codes[:half]]))
    return (
        document.doc_id,
        len(document.text),
        hashlib.sha256(edited.encode()).hexdigest(),
        _hex(document.own),
        _hex(other),
        likeness(document.own, other),
        likeness(document.own, after.own),
    )


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=_COLUMNS).astype({"doc_id": "Int64"})


def _in_order(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Whole ranges one after another, each in order and ended by what follows it.

    One document at a time waits for the next, also from one batch to another.
    """
    last = None
    for frame in frames:
        out = []
        for part, doc_id, text, follows in zip(*(frame[c].tolist() for c in ("part", "doc_id", "text", "follows"))):
            if follows and last is None:
                continue  # a further row of the id that follows
            codes = _codes(text)
            now = _Read(part, doc_id, text, codes, tuples(codes))
            if last is not None:
                if last.part != part:
                    raise RuntimeError(f"nothing follows document {last.doc_id}: the table changed while it was read")
                out.append(_compared(last, now))
            last = None if follows else now
        yield _frame(out)
    if last is not None:
        raise RuntimeError(f"nothing follows document {last.doc_id}: the table changed while it was read")


def _alone(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Documents without an id, each next to itself."""
    for frame in frames:
        out = []
        for text in frame["text"].tolist():
            codes = _codes(text)
            own = _Read(0, None, text, codes, tuples(codes))
            out.append(_compared(own, own))
        yield _frame(out)


def _range_starts(ids: DataFrame, count: int) -> list[int]:
    """The least id of each of about ``count`` ranges of about equal rows."""
    ordered = ids.repartitionByRange(count, "doc_id").select("doc_id", F.spark_partition_id().alias("part"))
    return sorted(row[1] for row in ordered.groupBy("part").agg(F.min("doc_id")).collect())


def _dealt(starts: list[int]):
    """The range of an id; with the id that a range starts with, also the range before, after the last the first."""

    @F.pandas_udf("array<int>")
    def ranges(doc_id: pd.Series) -> pd.Series:
        edges = np.array(starts, np.int64)
        own = np.maximum(np.searchsorted(edges, doc_id.to_numpy(np.int64), side="right") - 1, 0)
        leads = edges[own] == doc_id.to_numpy(np.int64)
        return pd.Series([[a, (a - 1) % len(edges)] if b else [a] for a, b in zip(own.tolist(), leads, strict=True)])

    return ranges


def order_fingerprints(docs: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Each document's fingerprint, that of its edited text, and likenesses to it and to the next document.

    The next document is the one with the next higher ``doc_id``, for the last
    one the first; rows with one id follow each other by text, and a document
    without an id is next to itself.  A null text counts as empty; two empty
    texts are alike by 1, an empty and another by 0.  Equal texts have equal
    fingerprints.  An empty table gives no row; further columns are not read.

    Ranges of ids hold about ``range_bytes`` of text, or more where that makes
    over ``MOST_RANGES``, as one id for each reaches the driver.  A task sorts its
    range, spilling where it must, and reads it batch by batch; the first row of a
    range also goes to the end of the one before.  Rows without an id stay where
    they are.
    """
    plain = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text")
    )
    named = plain.where("doc_id IS NOT NULL")
    total = named.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    count = min(MOST_RANGES, max(1, -(-total // range_bytes)))
    starts = _range_starts(named.select("doc_id"), count)
    dealt = named.select("doc_id", "text", F.posexplode(_dealt(starts)("doc_id")).alias("follows", "part"))
    ranges = dealt.repartitionById(max(1, len(starts)), "part").sortWithinPartitions("part", "follows", "doc_id", "text")
    unnamed = plain.where("doc_id IS NULL").select("text")
    return ranges.mapInPandas(_in_order, _SCHEMA).unionByName(unnamed.mapInPandas(_alone, _SCHEMA))
