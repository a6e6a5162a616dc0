"""Suffix-array deduplication: bytes covered by strings that start in an earlier document.

The ranks of a suffix array are built by doubling, as far as the threshold
only, and only for positions that can still matter:

* Rank by 20 bytes.  The hash of 20 bytes is made from those of 4, 8 and 16 at
  growing offsets.  It is sent for the positions whose hash is the least of some
  31 in a row.  The choice depends on the bytes alone, and any 50 bytes hold one
  such position, so equal strings meet at an equal position.  A rank that one
  document has alone is final: its position drops out.
* Rank by 80 bytes: the 50-byte strings that hold the position all lie within
  30 bytes on either side.  Where these are equal, the document with the least
  id keeps its bytes and the others' strings are covered as a whole.
* Rank by 50 bytes, for positions equal in the first rank and not the second:
  one rank for each of the 31 strings about the position, in which the parts to
  the left and to the right are a rank pair.

A rank is a 64-bit hash, so two strings count as equal if their hashes are.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame

from .packed import (
    Chunks,
    answer,
    bucket_edges,
    in_bucket_order,
    joined,
    lengths_of,
    message_rows,
    mixed,
    pack_bits,
    unpack_bits,
)

LENGTH = 50
GRAM = 20
SIDE = LENGTH - GRAM
_SEGMENT = 2**16
_U = np.uint64
_FACTORS = _U(0xD6E8FEB86659FD93), _U(0xA0761D6478BD642F), _U(0xE7037ED1A0B428DB)


def _gram_ranks(data: np.ndarray) -> np.ndarray:
    """A hash of the 20 bytes at each position, doubled from 4, 8 and 16."""
    wide = data.astype(np.uint32)
    pair = wide[:-1] | wide[1:] << np.uint32(8)
    four = (pair[:-2] | pair[2:] << np.uint32(16)).astype(_U)
    eight = mixed(four[:-4] | four[4:] << _U(32))
    sixteen = eight[:-8] + eight[8:] * _FACTORS[0]
    last = mixed(four + _FACTORS[1])
    count = len(data) - GRAM + 1
    return mixed(sixteen[:count] + last[16 : 16 + count] * _FACTORS[2])


def _sliding(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """The least or greatest of ``width`` values from each position on."""
    reach = 1
    while reach * 2 <= width:
        values, reach = pick(values[:-reach], values[reach:]), reach * 2
    return pick(values[: -(width - reach)], values[width - reach :]) if width > reach else values


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions whose rank is the least of some ``SIDE + 1`` in a row, and the ranks."""
    padded = np.concatenate([np.zeros(SIDE, np.uint8), data, np.zeros(2 * LENGTH, np.uint8)])
    places, ranks = [np.empty(0, np.int64)], [np.empty(0, _U)]
    for start in range(0, len(data), _SEGMENT):
        end = min(start + _SEGMENT, len(data))
        hashes = _gram_ranks(padded[start : end + 2 * SIDE + GRAM])
        least = _sliding(hashes, SIDE + 1, np.minimum)
        chosen = _sliding(least, SIDE + 1, np.maximum)[: end - start] == hashes[SIDE : SIDE + end - start]
        at = np.nonzero(chosen)[0]
        places.append(at + start)
        ranks.append(hashes[SIDE + at])
    # The chosen hashes are small ones; scrambled again, they fill all buckets alike.
    return np.concatenate(places), mixed(np.concatenate(ranks) + _FACTORS[0])


class _Texts:
    """A chunk's documents as one array of bytes, with the anchors in order of rank."""

    def __init__(self, docs: pd.DataFrame, bits: int) -> None:
        docs = docs.sort_values(["doc_id", "text"], na_position="first")
        self.carry = docs["carry"].tolist()
        self.null = docs["doc_id"].isna().to_numpy()
        # A document without an id precedes none and follows none.
        self.ids = docs["doc_id"].fillna(0).to_numpy(np.int64)
        texts = [text.encode() for text in docs["text"]]
        self.ends = np.cumsum([len(x) for x in texts], dtype=np.int64)
        self.starts = np.concatenate([[0], self.ends[:-1]]).astype(np.int64)
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        at, rank = anchors(self.data)
        doc = np.searchsorted(self.ends, at, side="right")
        inside = (at + GRAM <= self.ends[doc]) & (self.ends[doc] - self.starts[doc] >= LENGTH) & ~self.null[doc]
        at, rank, doc = at[inside], rank[inside], doc[inside]
        order = np.argsort(rank, kind="stable")
        self.at, self.rank, self.doc = at[order], rank[order], doc[order]
        self.bits = bits
        self.first = np.nonzero(_changes(self.rank))[0]

    def keep(self, distinct: np.ndarray) -> None:
        """Go on with the anchors of the flagged ranks, ranked by their surroundings too."""
        kept = np.repeat(distinct, np.diff(np.append(self.first, len(self.rank))))
        self.at, self.rank, self.doc = self.at[kept], self.rank[kept], self.doc[kept]
        self.left = np.minimum(self.at - self.starts[self.doc], SIDE)
        self.right = np.minimum(self.ends[self.doc] - self.at - GRAM, SIDE)
        around = self.surroundings(np.arange(len(self.at)), GRAM)
        self.context = np.zeros(len(self.at), _U)
        for word in np.ascontiguousarray(around).view(_U).T:
            self.context = mixed(self.context * _FACTORS[1] + word)
        self.context = mixed(self.context + (self.left * 64 + self.right).astype(_U))
        own = self.ids[self.doc]
        order = np.lexsort((own, self.context, self.rank))
        for name in ("at", "rank", "doc", "left", "right", "context"):
            setattr(self, name, getattr(self, name)[order])
        self.first = np.nonzero(_changes(self.rank, self.context))[0]
        self.entry = np.cumsum(_changes(self.rank, self.context)) - 1

    def surroundings(self, of: np.ndarray, middle: int) -> np.ndarray:
        """The bytes about anchors, with zeros beyond the ends of their documents."""
        offsets = np.concatenate([np.arange(-SIDE, middle), np.arange(GRAM, GRAM + SIDE)])
        out = np.empty((len(of), len(offsets)), np.uint8)
        for part in range(0, len(of), _SEGMENT):
            some = of[part : part + _SEGMENT]
            index = self.at[some, None] + offsets
            beyond = (offsets < -self.left[some, None]) | (offsets >= GRAM + self.right[some, None])
            out[part : part + _SEGMENT] = np.where(beyond, 0, self.data[np.clip(index, 0, len(self.data) - 1)])
        return out

    def edges(self) -> np.ndarray:
        return bucket_edges(self.rank[self.first], self.bits)


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Where sorted rows differ from the row before."""
    out = np.ones(len(columns[0]), bool)
    if len(out):
        out[1:] = False
        for column in columns:
            out[1:] |= column[1:] != column[:-1]
    return out


def _rows(chunk, step: int, edges: np.ndarray, pack) -> pd.DataFrame:
    spans = zip(range(len(edges) - 1), edges[:-1], edges[1:], strict=True)
    return message_rows([(chunk, b, step, *pack(slice(i, j))) for b, i, j in spans if j > i])


def _grams(bits: int):
    """First ranks of a chunk: 32 bits of each beyond its bucket, and whether two documents have it."""

    def make(docs: pd.DataFrame) -> pd.DataFrame:
        texts = _Texts(docs, bits)
        rank, own = texts.rank[texts.first], texts.ids[texts.doc]
        several = np.zeros(len(rank), bool)
        if len(rank):
            several = np.minimum.reduceat(own, texts.first) != np.maximum.reduceat(own, texts.first)
        short = (rank << _U(bits) >> _U(32)).astype(np.uint32)
        return _rows(
            docs["chunk"].iloc[0], 1, texts.edges(), lambda s: (short[s].tobytes(), pack_bits(several[s]), None, None)
        )

    return make


def _shared_grams(rows: pd.DataFrame) -> pd.DataFrame:
    """For each chunk, which of its first ranks two documents have."""
    counts = lengths_of(rows["a"], 4)
    several = np.concatenate([unpack_bits(x, n) for x, n in zip(rows["b"], counts, strict=True)])
    _, entry, times = np.unique(joined(rows["a"], np.uint32), return_inverse=True, return_counts=True)
    parts = np.split((times[entry] > 1) | several, np.cumsum(counts)[:-1])
    keys = zip(rows["chunk"], rows["bucket"], parts, strict=True)
    return message_rows([(c, b, 1, pack_bits(x), None, None, None) for c, b, x in keys])


def _reduced(docs: pd.DataFrame, rows: pd.DataFrame, bits: int) -> _Texts:
    texts = _Texts(docs, bits)
    counts = np.diff(texts.edges())
    texts.keep(in_bucket_order(rows, 1, "a", bool, counts))
    return texts


def _contexts(bits: int):
    """Second ranks of a chunk with the least document that has each."""

    def make(docs: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if docs.empty or rows.empty:
            return message_rows([])
        texts = _reduced(docs, rows, bits)
        rank, context, own = (x[texts.first] for x in (texts.rank, texts.context, texts.ids[texts.doc]))
        return _rows(
            docs["chunk"].iloc[0],
            2,
            texts.edges(),
            lambda s: (rank[s].tobytes(), context[s].tobytes(), own[s].tobytes(), None),
        )

    return make


def _least_documents(rows: pd.DataFrame) -> pd.DataFrame:
    """For each second rank the least document, and whether its first rank has another."""
    rank, context, own = joined(rows["a"], _U), joined(rows["b"], _U), joined(rows["c"], np.int64)
    order = np.lexsort((own, context, rank))
    new_rank, new = _changes(rank[order]), _changes(rank[order], context[order])
    least = own[order][np.nonzero(new)[0]][np.cumsum(new) - 1]
    group = np.cumsum(new_rank) - 1
    varied = (np.bincount(group, weights=new) > 1)[group]
    out_least, out_open = np.empty_like(own), np.empty(len(own), bool)
    out_least[order], out_open[order] = least, varied & (own[order] == least)
    cuts = np.cumsum(lengths_of(rows["a"], 8))[:-1]
    keys = zip(rows["chunk"], rows["bucket"], np.split(out_least, cuts), np.split(out_open, cuts), strict=True)
    return message_rows([(c, b, 2, x.tobytes(), pack_bits(y), None, None) for c, b, x, y in keys])


def _opened(texts: _Texts, rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    least = in_bucket_order(rows, 2, "a", np.int64)
    return least, in_bucket_order(rows, 2, "b", bool, np.diff(texts.edges()))


def _strings(bits: int):
    """What surrounds the anchors that are still open."""

    def make(docs: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if docs.empty or not (rows["step"] == 2).any():
            return message_rows([])
        texts = _reduced(docs, rows, bits)
        _, opened = _opened(texts, rows)
        of = texts.first[opened]
        rank, own, around = texts.rank[of], texts.ids[texts.doc[of]], texts.surroundings(of, 0)
        sides = np.stack([texts.left[of], texts.right[of]], axis=1).astype(np.uint8)
        return _rows(
            docs["chunk"].iloc[0],
            3,
            bucket_edges(rank, bits),
            lambda s: (rank[s].tobytes(), own[s].tobytes(), around[s].tobytes(), sides[s].tobytes()),
        )

    return make


def _earlier_strings(rows: pd.DataFrame) -> pd.DataFrame:
    """For each open anchor a bit for each string about it that an earlier document has."""
    rank, own = joined(rows["a"], _U), joined(rows["b"], np.int64)
    around = joined(rows["c"], np.uint8).reshape(-1, 2 * SIDE)
    sides = joined(rows["d"], np.uint8).reshape(-1, 2)
    rights = np.zeros((SIDE + 1, len(rank)), _U)
    for taken in range(SIDE):
        rights[taken + 1] = mixed(rights[taken] * _FACTORS[0] + around[:, SIDE + taken] + _U(1))
    left, found = np.zeros(len(rank), _U), np.zeros(len(rank), np.uint32)
    for taken in range(SIDE + 1):
        have = np.nonzero((sides[:, 0] >= taken) & (sides[:, 1] >= SIDE - taken))[0]
        string = mixed(mixed(rank[have] + left[have] * _FACTORS[1]) + rights[SIDE - taken][have] * _FACTORS[2])
        order = np.lexsort((own[have], string))
        new = _changes(string[order])
        least = own[have][order][np.nonzero(new)[0]][np.cumsum(new) - 1]
        later = have[order[own[have][order] > least]]
        found[later] |= np.uint32(1 << taken)
        if taken < SIDE:
            left = mixed(left * _FACTORS[0] + around[:, SIDE - 1 - taken] + _U(1))
    cuts = np.cumsum(lengths_of(rows["a"], 8))[:-1]
    keys = zip(rows["chunk"], rows["bucket"], np.split(found, cuts), strict=True)
    return message_rows([(c, b, 3, x.tobytes(), None, None, None) for c, b, x in keys])


def _covered(docs: pd.DataFrame, rows: pd.DataFrame, bits: int) -> tuple[_Texts, np.ndarray]:
    """Which bytes of a chunk earlier documents cover."""
    texts = _Texts(docs, bits) if not (rows["step"] == 1).any() else _reduced(docs, rows, bits)
    change = np.zeros(len(texts.data) + 1, np.int64)
    if (rows["step"] == 2).any():
        least, opened = _opened(texts, rows)
        masks = np.zeros(len(texts.first), np.uint32)
        masks[opened] = in_bucket_order(rows, 3, "a", np.uint32)
        first = texts.ids[texts.doc] == least[texts.entry]
        whole = np.nonzero(~first & (texts.left + texts.right >= SIDE))[0]
        np.add.at(change, (texts.at - texts.left)[whole], 1)
        np.add.at(change, (texts.at + GRAM + texts.right)[whole], -1)
        mask = np.where(first, masks[texts.entry], 0)
        for taken in range(SIDE + 1):
            start = texts.at[mask >> taken & 1 > 0] - taken
            np.add.at(change, start, 1)
            np.add.at(change, start + LENGTH, -1)
    return texts, np.cumsum(change[:-1]) > 0


def _cut_texts(bits: int, characters: bool):
    def make(docs: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if docs.empty:
            return pd.DataFrame(columns=_COLUMNS)
        texts, gone = _covered(docs, rows, bits)
        out = []
        for number, (start, end) in enumerate(zip(texts.starts, texts.ends, strict=True)):
            own = gone[start:end]
            turns = np.diff(np.concatenate([[0], own.view(np.int8), [0]]))
            spans = np.stack([np.nonzero(turns == 1)[0], np.nonzero(turns == -1)[0]], axis=1)
            kept = texts.data[start:end]
            kept = (kept[~own] if len(spans) else kept).tobytes()
            if characters and len(spans):
                kept = kept.decode("utf-8", "ignore").encode()
            doc_id = None if texts.null[number] else int(texts.ids[number])
            out.append((doc_id, int(end - start), spans.ravel().tolist(), kept, texts.carry[number]))
        frame = pd.DataFrame(out, columns=_COLUMNS)
        return frame.astype({"doc_id": "Int64"})

    return make


_COLUMNS = ["doc_id", "n_bytes", "spans", "kept", "carry"]


def remove_repeats(docs: DataFrame, carry: Column | None = None, characters: bool = False) -> DataFrame:
    """What is left of every text once the strings of earlier documents are gone.

    Returns a row for each document: ``doc_id``, ``n_bytes``, ``spans`` (starts
    and ends of the removed runs, in turn), ``kept`` (the bytes left; with
    ``characters`` those of whole characters) and ``carry``, a string.  A null
    text counts as empty; texts under 50 bytes stay whole; documents with equal
    ids do not remove each other's bytes, and one without an id neither removes
    nor loses any.  An empty table gives no row; further columns are not read.
    """
    chunks = Chunks(docs, carry)
    bits = chunks.bits
    first = answer(chunks.send(_grams(bits)), _shared_grams)
    second = answer(chunks.send(_contexts(bits), [first]), _least_documents)
    third = answer(chunks.send(_strings(bits), [first, second]), _earlier_strings)
    schema = "doc_id long, n_bytes long, spans array<long>, kept binary, carry string"
    return chunks.send(_cut_texts(bits, characters), [first, second, third], schema)
