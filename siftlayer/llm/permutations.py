"""Approximate nearest neighbours by inner product with a permutation index.

A vector is represented by the order in which it sees a set of pivots, the
nearest first.  Vectors that see the pivots in nearly the same order lie close
together.  The index is an inverted file: the list of a pivot holds its place in
the order of every vector (a pivot that is not among a vector's nearest ones
counts as standing behind the last).  A query reads the lists of its
own nearest pivots and adds up, for each vector, how far the places of a pivot are
apart (Spearman's footrule).  The vectors with the least sums are scored with
their inner products.

The largest product is the least distance once every vector gets one more
component that brings all to the same length, and queries a zero there, so pivots
are near by distance whatever the lengths.

The table is dealt by hash into blocks, each with pivots and lists of its own;
queries meet every block.  Equal vectors of a block are one entry of its lists,
so copies never crowd out others.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Workspace

PIVOTS = 256
#: How many of its pivots a vector is posted under, and how many lists a query reads.
#: Their sums fit in two bytes.
POSTED = 255
READ = 64
#: Entries whose products are computed: this share of a block and some more.
SHARE = 1 / 14
MORE = 512
K = 20
EVERY = 20
CANDIDATE_BLOCK = 16384
QUERY_BLOCK = 16384
#: Rows whose closeness to all pivots is held at once.
CHUNK = 2048
SEED = 13


def usable_vectors(vectors: DataFrame) -> DataFrame:
    """``vec_id``, ``v`` and ``dim`` of each distinct usable row."""
    raw = vectors.select(
        vectors["vec_id"].cast("long").alias("vec_id"), vectors["embedding"].cast("array<double>").alias("v")
    )
    unusable = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    usable = raw.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & ~unusable & F.exists("v", lambda x: x != 0))
    # Adding zero makes one zero of both.
    plain = usable.select("vec_id", F.transform("v", lambda x: x + F.lit(0.0)).alias("v"))
    return plain.distinct().withColumn("dim", F.size("v"))


def _levelled(rows: np.ndarray) -> np.ndarray:
    """Rows with one more component, all equally long, the longest one at length 1."""
    size = np.sqrt((rows**2).sum(axis=1))
    rows = rows / size.max()
    return np.concatenate([rows, np.sqrt(np.maximum(0, 1 - (size / size.max()) ** 2))[:, None]], axis=1)


def _unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to a largest component of 1, so that no square overflows or vanishes."""
    return rows / np.abs(rows).max(axis=1, keepdims=True)


@dataclass
class Index:
    """The distinct vectors of a block in pivot inverted files."""

    rows: np.ndarray
    #: Ids of the vectors equal to each row, ascending, at most one more than wanted; row ``i`` owns ``starts[i]`` on.
    ids: np.ndarray
    starts: np.ndarray
    pivots: np.ndarray
    posted: int
    #: The list of pivot ``p`` is ``place[p]``, with ``posted`` for entries that are not posted under it.
    place: np.ndarray

    @classmethod
    def built(cls, ids: np.ndarray, vectors: np.ndarray, k: int, pivots: int = PIVOTS, posted: int = POSTED) -> Index:
        rows, own = np.unique(vectors, axis=0, return_inverse=True)
        order = np.lexsort((ids, own.ravel()))
        ids, own = ids[order], own.ravel()[order]
        first = np.searchsorted(own, np.arange(len(rows)))
        kept = np.arange(len(own)) - first[own] <= k
        ids, own = ids[kept], own[kept]
        starts = np.searchsorted(own, np.arange(len(rows) + 1))
        # Rows in the order of their least ids, so that ties go to smaller ids.
        order = np.argsort(ids[starts[:-1]], kind="stable")
        ids = np.concatenate([ids[starts[i] : starts[i + 1]] for i in order])
        starts = np.append(0, np.cumsum(np.diff(starts)[order]))
        rows = rows[order]
        level = _levelled(rows / np.abs(rows).max())
        some = np.random.default_rng(SEED).permutation(len(rows))[:pivots]
        at = level[np.sort(some)]
        posted = min(posted, len(at))
        place = np.full((len(at), len(rows)), posted, np.min_scalar_type(-posted - 1))
        for start in range(0, len(rows), CHUNK):
            near = _nearest(level[start : start + CHUNK], at, posted)
            place[near, start + np.arange(len(near))[:, None]] = np.arange(posted)
        return cls(rows, ids, starts, at, posted, place)

    def footrule(self, query: np.ndarray, read: int = READ) -> np.ndarray:
        """For each row, how far apart the query's nearest pivots stand in both orders."""
        level = np.append(query / np.sqrt((query**2).sum()), 0.0)
        near = _nearest(level[None], self.pivots, min(read, self.posted))[0]
        apart = np.empty_like(self.place[0])
        total = np.zeros(len(self.rows), np.promote_types(apart.dtype, np.min_scalar_type(-len(near) * self.posted - 1)))
        for i, pivot in enumerate(near):
            np.subtract(self.place[pivot], i, out=apart)
            np.abs(apart, out=apart)
            np.add(total, apart, out=total)
        return total

    def found(self, query_id: int, query: np.ndarray, k: int, share: float, more: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the ``k`` best rows among those with the least footrule."""
        wanted = int(len(self.rows) * share) + more
        some = np.arange(len(self.rows))
        if wanted < len(some):
            some = _least(self.footrule(_unit(query[None])[0]), wanted)
        scores = self._scores(some, query)
        best = len(some) - min(k + 1, len(some))  # one of them may be the query itself
        some = some[_order(scores) >= np.partition(_order(scores), best)[best]]
        count = np.diff(self.starts)[some]
        at = np.repeat(self.starts[some] - np.cumsum(count) + count, count) + np.arange(count.sum())
        ids, scores = self.ids[at], np.repeat(self._scores(some, query), count)
        other = ids != query_id
        ids, scores = ids[other], scores[other]
        order = np.lexsort((ids, -_order(scores)))[:k]
        return ids[order], scores[order]

    def _scores(self, some: np.ndarray, query: np.ndarray) -> np.ndarray:
        # Row by row, so that equal rows have equal scores wherever they stand.
        return (self.rows[some] * query).sum(axis=1)


def _order(scores: np.ndarray) -> np.ndarray:
    """Scores to sort by: products that have no value, of infinities, come last."""
    return np.where(np.isnan(scores), -np.inf, scores)


def _least(sums: np.ndarray, count: int) -> np.ndarray:
    """The places of the ``count`` least sums; ties go to smaller places."""
    upto = np.cumsum(np.bincount(sums))
    last = np.searchsorted(upto, count)
    taken = np.flatnonzero(sums < last)
    return np.concatenate([taken, np.flatnonzero(sums == last)[: count - len(taken)]])


def _nearest(rows: np.ndarray, pivots: np.ndarray, count: int) -> np.ndarray:
    """The numbers of the ``count`` nearest pivots of each row, the nearest first."""
    closeness = rows @ pivots.T  # all pivots are equally long
    if count < len(pivots):
        some = np.argpartition(-closeness, count - 1, axis=1)[:, :count]
    else:
        some = np.broadcast_to(np.arange(len(pivots)), closeness.shape)
    order = np.argsort(-np.take_along_axis(closeness, some, axis=1), axis=1, kind="stable")
    return np.take_along_axis(some, order, axis=1)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(x, float) for x in column])


def _searched(k: int, share: float, more: int):
    def run(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        asked, found, scored = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0)]
        if len(queries) and len(rows):
            index = Index.built(rows["vec_id"].to_numpy(np.int64), _matrix(rows["v"]), k)
            for query_id, query in zip(queries["vec_id"].tolist(), _matrix(queries["v"]), strict=True):
                ids, scores = index.found(query_id, query, k, share, more)
                asked.append(np.full(len(ids), query_id))
                found.append(ids)
                scored.append(scores)
        columns = {"query_id": asked, "vec_id": found, "score": scored}
        return pd.DataFrame({name: np.concatenate(parts) for name, parts in columns.items()})

    return run


def near_neighbours(
    vectors: DataFrame,
    queries: DataFrame | None = None,
    k: int = K,
    every: int = EVERY,
    share: float = SHARE,
    more: int = MORE,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of the ``k`` nearest rows found for each query.

    Nearness is the inner product, computed in double precision from the vectors
    as they are; products too large for that have the value it gives, and those
    without one come last.  Queries are the rows of ``queries``, or those of ``vectors``
    whose id is divisible by ``every``; a query is not its own candidate, and
    equal scores go to the smaller id.  ``share`` of every block and ``more``
    entries are scored: with 1 the search is exact.  Every row is indexed; each
    block's pivots are at most ``PIVOTS`` of its own distinct vectors.

    Vectors that are null or zero, have a null or non-finite component, or no id
    take no part; vectors of different lengths never meet.  Rows equal in id and
    vector count once; of several vectors under one id each is a candidate and a
    query, and its queries share one ranking.  An empty table gives no row;
    further columns are not read.
    """
    space = Workspace(vectors.sparkSession)
    whole = space.keep(usable_vectors(vectors))
    asked = whole.where(F.col("vec_id") % every == 0) if queries is None else space.keep(usable_vectors(queries))
    blocks = max(1, -(-whole.count() // CANDIDATE_BLOCK))
    groups = max(1, -(-asked.count() // QUERY_BLOCK))
    spread = F.xxhash64("vec_id", "v", F.lit(SEED))

    def dealt(frame: DataFrame, own: str, count: int, other: str, copies: int) -> DataFrame:
        to = F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
        # New names for the columns: both sides come from one table.
        same = [F.col(name).alias(name) for name in ("vec_id", "v", "dim")]
        return frame.select(*same, F.pmod(spread, F.lit(count)).cast("int").alias(own), to.alias(other))

    rows, asks = dealt(whole, "block", blocks, "asked", groups), dealt(asked, "asked", groups, "block", blocks)
    keys = ["dim", "block", "asked"]
    found = (
        asks.groupBy(*keys)
        .cogroup(rows.groupBy(*keys))
        .applyInPandas(_searched(k, share, more), "query_id long, vec_id long, score double")
    )
    key = F.nanvl(F.col("score"), F.lit(float("-inf")))
    order = Window.partitionBy("query_id").orderBy(key.desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
