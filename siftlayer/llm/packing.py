"""Best-fit packing of tokenized documents by swap-based local search.

A document's tokens are cut only where they exceed a sequence.  Pieces are dealt
into groups of bounded size by a hash; each group is packed by itself and the
bins that stay underfull meet again in a second round, group by group, until a
round gains nothing or one group is left.

Within a group, pieces first go to the fullest bin that has room.  Then a local
search works on the bins with room left: it moves a piece to another bin, swaps
one piece for one, or two for one, whenever that raises the sum of squared
fills.  A higher sum means that room gathers in few bins, until some are empty.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace

LENGTH = 2048
GROUP_PIECES = 8192
CACHED_WORDS = 700_000
MOVES = 2
_JOINED = 500
_TOGETHER = 512
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, bin long, offset long, room int"


# Characters of which a run is one part to the tokenizer, letters or marks.
_LETTERS = "a-z\u00df-\u00f6\u00f8-\u00ff"
_CAPITALS = "A-Z\u00c0-\u00d6\u00d8-\u00de"
_MARKS = ".,;:!?%$#&*|"


class _WordIds:
    """Packed ids of texts, by parts.

    The tokenizer drops white space and merges nothing across it, so that words
    parted by a blank or line feed are independent; it sees runs of letters and
    runs of marks apart.  A text is cut into such runs, but for words with any
    other character, which stay whole.  A bounded cache holds what was met before.
    """

    def __init__(self, path: str, most: int) -> None:
        from tokenizers import Tokenizer

        self.tokenizer, self.most = Tokenizer.from_file(path), most
        names = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(names.values()) + 1, bool)
        self.closes[[number for name, number in names.items() if name.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {}
        self.runs = re.compile(f"[{_LETTERS}]+|[{_MARKS}]+").findall
        self.odd = re.compile(f"[^{_LETTERS}{_CAPITALS}{_MARKS} \n]").search
        self.gap = re.compile("[ \n]").search

    def _units(self, text: str) -> list[str]:
        """Runs in lower case, and words with an odd character as they are, in order."""
        units: list[str] = []
        at = 0
        while found := self.odd(text, at):
            place = found.start()
            start = max(text.rfind(" ", at, place), text.rfind("\n", at, place), at - 1) + 1
            gap = self.gap(text, place)
            end = gap.start() if gap else len(text)
            units += self.runs(text[at:start].lower())
            units.append(text[start:end])
            at = end
        return units + self.runs(text[at:].lower())

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u4") for x in found]

    def _learn(self, units: list[str]) -> None:
        odd = [unit for unit in units if self.odd(unit)]
        self.known.update((unit, ids.tobytes()) for unit, ids in zip(odd, self._encode(odd), strict=True))
        runs = [unit for unit in units if unit not in self.known]
        for start in range(0, len(runs), _JOINED):
            some = runs[start : start + _JOINED]
            ids = self._encode([" ".join(some)])[0]
            ends = (4 * np.nonzero(self.closes[ids])[0] + 4).tolist()
            if len(ends) == len(some):
                packed = ids.tobytes()
                self.known.update((x, packed[i:j]) for x, i, j in zip(some, [0, *ends], ends, strict=False))
            else:  # a run that the tokenizer cuts further
                self.known.update((x, piece.tobytes()) for x, piece in zip(some, self._encode(some), strict=True))

    def __call__(self, texts: list[str]) -> list[bytes]:
        split = [self._units(text) for text in texts]
        met: set[str] = set()
        for units in split:
            met.update(units)
        new = [unit for unit in met if unit not in self.known]
        if len(self.known) + len(new) > self.most:
            # What has been met before and is met again is likely to come once more.
            self.known = {unit: self.known[unit] for unit in met.difference(new)}
        self._learn(new)
        return [b"".join(map(self.known.__getitem__, units)) for units in split]


def _tokenized(path: str, length: int, cached: int):
    """Batches of documents to their pieces."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import os

        import tokenizers

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        # A worker process runs many tasks; what one has learnt stays for the next.
        kept = tokenizers.__dict__.setdefault("_word_ids_by_path", {})
        ids_of = kept.get(path) or kept.setdefault(path, _WordIds(path, cached))
        for batch in batches:
            rows = []
            texts = ["" if text is None else text for text in batch["text"]]
            coded = (x for i in range(0, len(texts), _TOGETHER) for x in ids_of(texts[i : i + _TOGETHER]))
            for doc_id, ids in zip(batch["doc_id"].astype("Int64"), coded, strict=True):
                ids += b"\0\0\0\0"
                for piece, start in enumerate(range(0, len(ids), 4 * length)):
                    part = ids[start : start + 4 * length]
                    rows.append((doc_id, piece, start // 4, len(part) // 4, zlib.crc32(part)))
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


def token_pieces(docs: DataFrame, tokenizer: str, length: int = LENGTH, cached: int = CACHED_WORDS) -> DataFrame:
    """A row for each piece of each document: its ids followed by id 0, cut at ``length``.

    A null or empty text has the one id 0.
    """
    plain = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return plain.mapInPandas(_tokenized(tokenizer, length, cached), _PIECES)


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins of item numbers; each item, largest first, in the fullest bin with room for it."""
    bins: list[list[int]] = []
    rooms: list[tuple[int, int]] = []  # room and bin, in order of room
    for item in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        place = bisect_left(rooms, (sizes[item], -1))
        if place < len(rooms):
            room, number = rooms.pop(place)
            bins[number].append(item)
        else:
            room, number = capacity, len(bins)
            bins.append([item])
        if room > sizes[item]:
            insort(rooms, (room - sizes[item], number))
    return bins


class _Search:
    """Local search over underfull bins; ``fills`` are their words, ``items`` their pieces by size."""

    def __init__(self, sizes: list[int], bins: list[list[int]], capacity: int) -> None:
        self.sizes, self.capacity = sizes, capacity
        self.bins = [sorted(own, key=sizes.__getitem__) for own in bins]
        self.fills = [sum(map(sizes.__getitem__, own)) for own in self.bins]

    def _shift(self, source: int, target: int, out: list[int], back: list[int]) -> None:
        for a, b, items in ((source, target, out), (target, source, back)):
            for item in items:
                self.bins[a].remove(item)
                self.fills[a] -= self.sizes[item]
                insort(self.bins[b], item, key=self.sizes.__getitem__)
                self.fills[b] += self.sizes[item]

    def _largest(self, number: int, below: int, but: int | None = None) -> int | None:
        """The largest piece of a bin of at most ``below`` words."""
        own = self.bins[number]
        at = bisect_left(own, below + 1, key=self.sizes.__getitem__) - 1
        if at >= 0 and own[at] == but:
            at -= 1
        return own[at] if at >= 0 else None

    def step(self, source: int, target: int) -> bool:
        """One change that takes words from the emptier bin to the fuller one."""
        room, sizes = self.capacity - self.fills[target], self.sizes
        if (item := self._largest(source, room)) is not None:
            self._shift(source, target, [item], [])
            return True
        for back in self.bins[target]:
            item = self._largest(source, room + sizes[back])
            if item is not None and sizes[item] > sizes[back]:
                self._shift(source, target, [item], [back])
                return True
            if item is not None:
                other = self._largest(source, room + sizes[back] - sizes[item], but=item)
                if other is not None and sizes[item] + sizes[other] > sizes[back]:
                    self._shift(source, target, [item, other], [back])
                    return True
        return False

    def run(self, effort: int) -> list[list[int]]:
        """Passes over the bins, as long as one gains and at most ``effort`` times."""
        for _ in range(effort):
            before = sum(fill * fill for fill in self.fills)
            self._pass(effort)
            if sum(fill * fill for fill in self.fills) == before:
                break
        return [own for own in self.bins if own]

    def _pass(self, effort: int) -> None:
        """Empties bins from the least filled on, while changes are found."""
        for source in sorted(range(len(self.bins)), key=self.fills.__getitem__):
            changes = effort * max(1, len(self.bins[source]))
            for target in sorted(range(len(self.bins)), key=lambda b: -self.fills[b]):
                if not self.bins[source] or not changes:
                    break
                if target == source or not self.bins[target] or self.fills[target] < self.fills[source]:
                    continue
                while changes and self.fills[target] < self.capacity and self.step(source, target):
                    changes -= 1
                    if not self.bins[source] or self.fills[target] < self.fills[source]:
                        break


def pack(sizes: list[int], capacity: int, effort: int = MOVES) -> list[list[int]]:
    """Bins of item numbers, as few as best fit and the local search come to."""
    bins = best_fit(sizes, capacity)
    fills = [sum(map(sizes.__getitem__, own)) for own in bins]
    done = [own for own, fill in zip(bins, fills, strict=True) if fill == capacity]
    return done + _Search(sizes, [b for b, f in zip(bins, fills, strict=True) if f < capacity], capacity).run(effort)


def _packed(length: int):
    def run(pieces: pd.DataFrame) -> pd.DataFrame:
        group = int(pieces["group"].iloc[0])
        pieces = pieces.sort_values(["doc_id", "piece", "ids_crc32"], na_position="first").reset_index(drop=True)
        sizes = pieces["length"].tolist()
        number, offset, room = (np.zeros(len(sizes), np.int64) for _ in range(3))
        for at, own in enumerate(pack(sizes, length)):
            start = 0
            for item in own:
                number[item], offset[item] = at, start
                start += sizes[item]
            room[own] = length - start
        out = pieces[["doc_id", "piece", "start", "length", "ids_crc32"]].copy()
        out["bin"], out["offset"], out["room"] = number + (group << 32), offset, room
        return out

    return run


def _round(space: Workspace, pieces: DataFrame, count: int, length: int, group_pieces: int, number: int) -> DataFrame:
    groups = max(1, -(-count // group_pieces))
    # By place in the table, so that pieces equal in all columns are no group.
    group = F.pmod(F.xxhash64(F.lit(number), F.monotonically_increasing_id()), F.lit(groups))
    grouped = pieces.withColumn("group", group).groupBy("group")
    placed = space.keep(grouped.applyInPandas(_packed(length), _PLACED))
    return placed.withColumn("bin", F.col("bin").bitwiseOR(F.lit(number << 56)))


def pack_documents(
    docs: DataFrame, tokenizer: str, length: int = LENGTH, group_pieces: int = GROUP_PIECES
) -> DataFrame:
    """Every piece of every document with its sequence and its place there.

    Returns ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``,
    ``sequence_id`` and ``offset``.  A null text counts as empty and gives one
    piece of the single id 0; rows with equal ids are packed like others; an empty
    table gives no row.  Pieces of full length are sequences of their own.
    """
    space = Workspace(docs.sparkSession)
    pieces = space.keep(token_pieces(docs, tokenizer, length))
    full = F.col("length") == length
    counts = pieces.agg(F.count(F.lit(1)), F.count(F.when(~full, 1))).first()
    whole = pieces.where(full).select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.monotonically_increasing_id() + F.lit(127 << 56)).alias("bin"),
        F.lit(0).cast("long").alias("offset"),
    )
    placed, number = [], 0
    open_, count = pieces.where(~full), counts[1]
    while count:
        result = _round(space, open_, count, length, group_pieces, number)
        left = result.where("room > 0")
        rest = left.count()
        last = count <= group_pieces or rest >= count * 3 // 4
        placed.append(result if last else result.where("room = 0"))
        open_, count, number = left, 0 if last else rest, number + 1
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "bin", "offset"]
    out = whole
    for part in placed:
        out = out.unionByName(part.select(columns))
    return out.withColumnRenamed("bin", "sequence_id")
