"""SimHash near-duplicates by a hierarchical index in Gray order.

The upper nodes of the index are masked bit patterns.  The 64 bits are cut into
six runs; fingerprints that differ in at most four bits agree on two runs at
least, so each is filed under the fifteen patterns of two runs.  A node that
holds many fingerprints is divided again: its free bits are cut into five runs,
and linked fingerprints agree on one of them.  That goes on as long as a node is
large; with all but a few bits fixed, none can be.

The fingerprints of a node are sorted by Gray rank, which puts similar ones side
by side, and each eight of them share an inner node with the bits that all of
them have set, and those that none has.  Two inner nodes that contradict each
other in over four bits are left out with everything below them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace
from .components import connected

SHINGLE = 4
RADIUS = 4
SEED = 42
LARGE_NODE = 4096
SLICE = 250_000
FAN = 8
_PART = 2**15
_U = np.uint64


def _bit_sums() -> np.ndarray:
    return np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: str, shingle: int, bits: np.ndarray) -> int:
    """The fingerprint of a text; words are lower-cased in A to Z, zero without words."""
    words = text.encode().lower().split()
    if not words:
        return 0
    joined, sizes = b" ".join(words), np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    first, last = (ends - sizes, ends[shingle - 1 :]) if len(words) >= shingle else ([0], [len(joined)])
    digest, seed = xxhash.xxh64_intdigest, SEED
    counts, total = np.zeros(8 * 256, np.int64), len(last)
    spans = zip(first.tolist() if total > 1 else [0], last.tolist() if total > 1 else [len(joined)], strict=False)
    hashes = np.fromiter((digest(joined[i:j], seed) for i, j in spans), _U, total)
    for part in range(0, total, _PART):
        octets = hashes[part : part + _PART].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.bincount((octets + np.arange(0, 2048, 256)).ravel(), minlength=2048)
    set_bits = (counts.reshape(8, 256) @ bits).ravel() * 2 > total
    return int(np.packbits(set_bits, bitorder="little").view("<i8")[0])


def _fingerprinted(shingle: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = _bit_sums()
        for batch in batches:
            found = [fingerprint(text or "", shingle, bits) for text in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "fp": np.array(found, np.int64)})

    return run


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id`` and ``fp``, the fingerprint as a signed number; a null text counts as empty."""
    plain = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return plain.mapInPandas(_fingerprinted(shingle), "doc_id long, fp long")


def _runs(free: list[int], count: int) -> list[int]:
    """Masks of ``count`` runs that share out the free bits evenly."""
    return [sum(1 << bit for bit in part) for part in np.array_split(np.array(free), count) if len(part)]


def _signed(mask: int) -> int:
    return mask - 2**64 if mask >= 2**63 else mask


def _patterns(radius: int) -> list[int]:
    runs = _runs(list(range(64)), radius + 2)
    return [a | b for a, b in combinations([int(x) for x in runs], 2)]


def _divided(mask: int, radius: int) -> list[int]:
    free = [bit for bit in range(64) if not mask >> bit & 1]
    return [mask | int(run) for run in _runs(free, radius + 1)]


def _gray_rank(values: np.ndarray) -> np.ndarray:
    """Places of the values in the reflected Gray code."""
    values = values.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        values ^= values >> _U(shift)
    return values


def _groups(node: np.ndarray, fan: int) -> np.ndarray:
    """Starts of runs of up to ``fan`` entries that lie in one node."""
    new = np.ones(len(node), bool)
    new[1:] = node[1:] != node[:-1]
    starts = np.nonzero(new)[0]
    place = np.arange(len(node)) - starts[np.cumsum(new) - 1]
    return np.nonzero(place % fan == 0)[0]


def close_pairs(node: np.ndarray, values: np.ndarray, radius: int, fan: int = FAN) -> np.ndarray:
    """All pairs of entries in one node that differ in at most ``radius`` bits.

    ``node`` and, within a node, the Gray ranks of ``values`` are sorted.
    """
    levels = [(node, values, values, np.arange(len(node) + 1))]
    while len(_groups(levels[-1][0], fan)) < len(levels[-1][0]):
        above, every, some, _ = levels[-1]
        starts = _groups(above, fan)
        levels.append(
            (above[starts], np.bitwise_and.reduceat(every, starts), np.bitwise_or.reduceat(some, starts),
             np.append(starts, len(above)))
        )
    top = len(levels[-1][0])
    found, todo = [np.empty((0, 2), np.int64)], [(len(levels) - 1, np.repeat(np.arange(top)[:, None], 2, axis=1))]
    while todo:
        level, pairs = todo.pop()
        if len(pairs) > _PART:
            todo += [(level, pairs[i : i + _PART]) for i in range(0, len(pairs), _PART)]
            continue
        _, every, some, starts = levels[level]
        a, b = pairs[:, 0], pairs[:, 1]
        differ = (every[a] & ~some[b]) | (every[b] & ~some[a])
        a, b = a[near := np.bitwise_count(differ) <= radius], b[near]
        if level == 0:
            found.append(np.stack([a, b], axis=1)[a < b])
            continue
        wide_a, wide_b = starts[a + 1] - starts[a], starts[b + 1] - starts[b]
        count = wide_a * wide_b
        which = np.repeat(np.arange(len(a)), count)
        place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        below = np.stack(
            [starts[a[which]] + place // wide_b[which], starts[b[which]] + place % wide_b[which]], axis=1
        )
        todo.append((level - 1, below[below[:, 0] <= below[:, 1]]))
    return np.concatenate(found)


def _roots(count: int, pairs: np.ndarray) -> np.ndarray:
    """For each entry the least entry that it is linked to in one or more steps."""
    root = np.arange(count)
    while len(pairs):
        ends = root[pairs]
        pairs = pairs[ends[:, 0] != ends[:, 1]]
        ends = np.sort(root[pairs], axis=1)
        np.minimum.at(root, ends[:, 1], ends[:, 0])
        while (jumped := root[root] != root).any():
            root = np.where(jumped, root[root], root)
    return root


def _linked(radius: int):
    """Links between the fingerprints of a slice of nodes, a star for each component."""

    def run(entries: pd.DataFrame) -> pd.DataFrame:
        value = entries["fp"].to_numpy(np.int64).view(_U)
        pattern = entries["pattern"].to_numpy(np.int64).view(_U)
        order = np.lexsort((_gray_rank(value), value & pattern, pattern))
        value, pattern = value[order], pattern[order]
        new = np.ones(len(value), bool)
        new[1:] = (pattern[1:] != pattern[:-1]) | ((value & pattern)[1:] != (value & pattern)[:-1])
        node = np.cumsum(new)
        kept = np.bincount(node)[node] > 1
        value, node = value[kept], node[kept]
        pairs = close_pairs(node, value, radius) if len(value) else np.empty((0, 2), np.int64)
        distinct, entry = np.unique(value, return_inverse=True)
        root = _roots(len(distinct), entry[pairs])
        moved = np.nonzero(root != np.arange(len(distinct)))[0]
        return pd.DataFrame({"a": distinct[moved].view(np.int64), "b": distinct[root[moved]].view(np.int64)})

    return run


def close_links(space: Workspace, prints: DataFrame, radius: int = RADIUS, large: int = LARGE_NODE) -> DataFrame:
    """Links that join all distinct fingerprints ``fp`` within ``radius`` bits into their components."""
    masks, links = _patterns(radius), None
    level = prints.select("fp", F.explode(F.array(*[F.lit(_signed(m)).cast("long") for m in masks])).alias("pattern"))
    while True:
        level = space.keep(level.withColumn("shared", F.col("fp").bitwiseAND(F.col("pattern"))))
        sizes = level.groupBy("pattern", "shared").agg(F.count(F.lit(1)).alias("size"))
        nodes = space.keep(sizes.where("size > 1").withColumn("large", F.col("size") > large))
        total = nodes.where("NOT large").agg(F.sum("size")).first()[0]
        entries = level.join(nodes, ["pattern", "shared"])
        slices = max(1, -(-(total or 0) // SLICE))
        small = entries.where("NOT large").select(
            "fp", "pattern", F.pmod(F.xxhash64("pattern", "shared"), F.lit(slices)).alias("slice")
        )
        found = small.groupBy("slice").applyInPandas(_linked(radius), "a long, b long")
        links = found if links is None else links.unionByName(found)
        # Patterns follow from a fixed rule: fifteen, and five for each of the level above.
        masks = [row[0] % 2**64 for row in nodes.where("large").select("pattern").distinct().collect()]
        if not masks:
            return links
        below = space.spark.createDataFrame(
            [(_signed(m), [_signed(c) for c in _divided(m, radius)]) for m in masks], "pattern long, below array<long>"
        )
        level = (
            entries.where("large").join(below, "pattern").select("fp", F.explode("below").alias("pattern")).distinct()
        )


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id`` for each document.

    Documents whose fingerprints differ in at most ``radius`` bits are linked;
    ``component_id`` is the smallest ``doc_id`` that links lead to, the
    document's own included, null where none of them has one.  Texts that are
    null, empty or without words have fingerprint 0 and link like any other.
    Repeated rows are returned as often as they come; an empty table gives no
    row; columns besides ``doc_id`` and ``text`` are not read.
    """
    space = Workspace(docs.sparkSession)
    prints = space.keep(fingerprints(docs, shingle))
    distinct = space.keep(prints.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = connected(space, close_links(space, distinct.select("fp"), radius))
    rooted = distinct.join(roots, distinct["fp"] == roots["a"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    labels = space.keep(rooted.join(least, "root").select("fp", "component_id"))
    return prints.join(labels, "fp").select("doc_id", "fp", "component_id")
