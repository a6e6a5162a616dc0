"""Exact top-k search by inner product with a table of pivot distances.

With squared lengths at hand, an inner product follows from a distance:
``2 q.x = |q|^2 + |x|^2 - |q - x|^2``.  The table holds each vector's distance to
many pivots; the triangle inequality then bounds the distance from below by
``max |d(q, p) - d(x, p)|``, and so the product from above.  Candidates are
evaluated in the order of their bounds until the next bound lies under the k-th
best product found; no candidate left out can belong to the result.

The table is computed once and written.  Rows are dealt to blocks by their nearest
pivot and by rings of distance to it.  A query first meets one block of its own ring,
which gives it a k-th best product to reach.  Queries then form groups, as few as their
number allows, by their nearest pivot.  The ranges of distances in a block bound the
products of all its rows at once: only the blocks that can reach what some query of a
group has are sent to it, and each pair of block and group gives at most k rows a query.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Workspace, unit_hash

SCALE = 256
PIVOTS = 32
QUERY_BLOCK = 2048
CANDIDATE_BLOCK = 8192
RINGS = 16
STEP = 1024
SEED = 5
_SAFE = 2.0**53


def whole_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id`` and ``v``, each component times ``scale`` rounded down; unusable vectors are left out."""
    raw = vectors.select(
        vectors["vec_id"].cast("long").alias("vec_id"), vectors["embedding"].cast("array<double>").alias("raw")
    )
    unusable = F.exists("raw", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    usable = raw.where(F.col("vec_id").isNotNull() & F.col("raw").isNotNull() & ~unusable)
    return usable.select("vec_id", F.transform("raw", lambda x: F.floor(x * scale).cast("long")).alias("v"))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(x, np.int64) for x in column])


def _exact(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Products of rows, exact as long as they fit 64 bits."""
    dim = left.shape[1]
    most = np.abs(left).max(initial=0).astype(float) * np.abs(right).max(initial=0).astype(float) * max(1, dim)
    if most < _SAFE:
        return (left.astype(float) @ right.astype(float).T).astype(np.int64)
    return left @ right.T


def _distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances to the pivots, as doubles with a relative error far below the slack of the bound."""
    out = np.empty((len(rows), len(pivots)))
    for number, pivot in enumerate(pivots.astype(float)):
        out[:, number] = np.sqrt(((rows.astype(float) - pivot) ** 2).sum(axis=1))
    return out


class _Best:
    """The k best candidates of each query so far: higher scores first, then smaller ids."""

    def __init__(self, queries: int, k: int) -> None:
        self.k = k
        self.score = np.full((queries, k), np.iinfo(np.int64).min)
        self.id = np.full((queries, k), np.iinfo(np.int64).max)

    def take(self, query: int, scores: np.ndarray, ids: np.ndarray) -> None:
        some = scores >= self.score[query, -1]
        scores, ids = np.append(self.score[query], scores[some]), np.append(self.id[query], ids[some])
        order = np.lexsort((ids, ~scores))[: self.k]
        self.score[query], self.id[query] = scores[order], ids[order]


def search_block(
    queries: tuple[np.ndarray, np.ndarray, np.ndarray],
    block: tuple[np.ndarray, np.ndarray, np.ndarray],
    k: int,
    least: np.ndarray | None = None,
) -> tuple[_Best, int]:
    """The best candidates of a block for each query, and how many were evaluated.

    Both sides are ids, vectors and their distances to the pivots.  Candidates that
    cannot reach ``least``, a score for each query, are left out.
    """
    query_ids, vectors, to_query = queries
    ids, rows, to_row = block
    best, evaluated = _Best(len(vectors), k), 0
    floor = np.full(len(vectors), -np.inf) if least is None else least
    squares = (rows.astype(float) ** 2).sum(axis=1)
    for number, query in enumerate(vectors):
        gap = np.zeros(len(rows))
        for own, theirs in zip(to_query[number], to_row.T, strict=True):
            np.maximum(gap, np.abs(theirs - own), out=gap)
        size = float((query.astype(float) ** 2).sum())
        # The slack covers the rounding of the doubles in the bound.
        bound = (size + squares - gap**2) / 2 + 1e-9 * (size + squares) + 1
        bound[(ids == query_ids[number]) | (bound < floor[number])] = -np.inf
        order = np.argsort(-bound, kind="stable")
        for start in range(0, len(order), STEP):
            some = order[start : start + STEP]
            some = some[bound[some] >= float(best.score[number, -1])]
            some = some[bound[some] > -np.inf]
            if not len(some):
                break
            best.take(number, _exact(query[None], rows[some])[0], ids[some])
            evaluated += len(some)
    return best, evaluated


def _side(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return frame["vec_id"].to_numpy(np.int64), _matrix(frame["v"]), np.stack(frame["distances"].tolist())


def _searched(k: int):
    def run(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if queries.empty or rows.empty:
            return pd.DataFrame(columns=["asker", "query_id", "vec_id", "score"])
        least = queries["least"].astype(float).fillna(-np.inf).to_numpy()
        best, _ = search_block(_side(queries), _side(rows), k, least)
        found = best.id != np.iinfo(np.int64).max
        asker = np.broadcast_to(queries["number"].to_numpy(np.int64)[:, None], found.shape)[found]
        query = np.broadcast_to(queries["vec_id"].to_numpy(np.int64)[:, None], found.shape)[found]
        return pd.DataFrame({"asker": asker, "query_id": query, "vec_id": best.id[found], "score": best.score[found]})

    return run


def _pivots(whole: DataFrame, count: int) -> dict[int, np.ndarray]:
    """``count`` vectors of each dimension, those that a hash of the id puts first."""
    rows = whole.withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(64)))
    for keys in (["dim", "salt"], ["dim"]):  # in two steps, each of few rows a task
        order = Window.partitionBy(*keys).orderBy(unit_hash("vec_id", seed=SEED), "vec_id")
        rows = rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= count)
    out: dict[int, list] = {}
    for row in rows.select("dim", "v").collect():
        out.setdefault(row["dim"], []).append(row["v"])
    return {dim: np.array(sorted(own), np.int64) for dim, own in out.items()}


def _with_distances(whole: DataFrame, pivots: dict[int, np.ndarray], classes: int) -> DataFrame:
    """Rows with a number, their squared length, distances to the pivots and the nearest of the first ``classes``."""

    def run(batches):
        for rows in batches:
            distances: list = [None] * len(rows)
            near, size = np.zeros(len(rows), np.int64), np.zeros(len(rows))
            for dim, at in rows.groupby("dim").indices.items():
                vectors = _matrix(rows["v"].iloc[at])
                table = _distances(vectors, pivots.get(dim, np.zeros((1, dim), np.int64)))
                near[at], size[at] = table[:, :classes].argmin(axis=1), (vectors.astype(float) ** 2).sum(axis=1)
                for place, row in zip(at, table, strict=True):
                    distances[place] = row
            yield rows.assign(size=size, near=near, distances=distances)

    numbered = whole.withColumn("number", F.monotonically_increasing_id())
    schema = "vec_id long, v array<long>, dim int, number long, size double, near long, distances array<double>"
    return numbered.mapInPandas(run, schema)


def _own_distance() -> Column:
    return F.get("distances", F.col("near").cast("int"))


def _rings(placed: DataFrame) -> DataFrame:
    """For each pivot the distances that part its rows into rings, fewer where it has few rows."""
    cuts = [i / RINGS for i in range(1, RINGS)]
    found = placed.groupBy("dim", "near").agg(
        F.percentile_approx(_own_distance(), cuts).alias("cuts"), F.count(F.lit(1)).alias("n")
    )
    step = F.greatest(F.lit(1), F.floor(F.lit(float(RINGS * CANDIDATE_BLOCK)) / F.col("n")))
    wanted = F.filter("cuts", lambda _, place: (place + 1) % step == 0)
    return found.select("dim", "near", wanted.alias("cuts"))


def _ringed(frame: DataFrame, rings: DataFrame) -> DataFrame:
    distance = _own_distance()
    ring = F.size(F.filter(F.coalesce("cuts", F.array().cast("array<double>")), lambda cut: cut < distance))
    return frame.join(rings, ["dim", "near"], "left").withColumn("ring", ring.cast("long")).drop("cuts")


def _dealt(frame: DataFrame, most: int, name: str) -> tuple[DataFrame, DataFrame]:
    """Rows of a ring dealt to parts of about ``most`` by their numbers; and the parts of each ring."""
    keys = ["dim", "near", "ring"]
    parts = frame.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / F.lit(most)).alias("parts"))
    part = F.pmod(F.xxhash64("number", F.lit(SEED)), F.col("parts"))
    dealt = frame.join(parts, keys).withColumn(name, F.struct("near", "ring", part.alias("part")))
    return dealt.drop("parts"), parts


def _grouped(asks: DataFrame) -> DataFrame:
    """Queries in groups by the nearest of as many pivots as their number needs."""
    classes = max(1, -(-asks.count() // QUERY_BLOCK))
    some = F.slice("distances", 1, classes)
    near = F.coalesce(F.array_position(some, F.array_min(some)), F.lit(0)).cast("long")
    return _dealt(asks.withColumn("near", near).withColumn("ring", F.lit(0)), QUERY_BLOCK, "asked")[0]


def _ranges(frame: DataFrame, name: str, pivots: int, *further: Column) -> DataFrame:
    """The least and greatest distance to each pivot in each block or group."""
    of = [F.get("distances", F.lit(i)) for i in range(pivots)]
    low, high = F.array(*map(F.min, of)).alias(f"{name}_low"), F.array(*map(F.max, of)).alias(f"{name}_high")
    return frame.groupBy("dim", name).agg(low, high, F.max("size").alias(f"{name}_size"), *further)


def _cells(blocks: DataFrame, groups: DataFrame, pivots: int) -> DataFrame:
    """The blocks some row of which may reach what a query of a group has already.

    With ``need = max |q|^2 - 2 least`` over a group, a row ``x`` can only matter where
    ``need + |x|^2`` is no less than the squared gap between the ranges of distances.
    """
    chunks = max(1, -(-blocks.count() // CANDIDATE_BLOCK))
    chunk = F.pmod(F.xxhash64("block"), F.lit(chunks)).cast("int").alias("chunk")
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk")
    met = blocks.select("*", chunk).join(groups.select("*", everywhere), ["dim", "chunk"])
    gap = F.lit(0.0)
    for i in range(pivots):  # a pivot that a dimension lacks is null, which greatest() leaves out
        low, high = (F.get("block_low", F.lit(i)), F.get("block_high", F.lit(i)))
        gap = F.greatest(gap, low - F.get("asked_high", F.lit(i)), F.get("asked_low", F.lit(i)) - high)
    sizes = F.col("block_size") + F.col("asked_size")
    reach = F.col("need") + F.col("block_size") + sizes * 1e-8 + 4
    return met.where(F.col("need").isNull() | (reach >= gap * gap)).select("dim", "block", "asked")


def exact_top_k(
    vectors: DataFrame, queries: DataFrame | None = None, k: int = 5, every: int = 50, pivots: int = PIVOTS
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of each query's ``k`` highest inner products.

    Queries are the rows of ``queries``, or those of ``vectors`` whose id is
    divisible by ``every``.  A query is not its own candidate; equal scores go to
    the smaller id.  Vectors that are null, have a null or non-finite component,
    or no id take no part; vectors of different lengths never meet, and empty
    ones score 0.  A repeated id is a candidate as often as it comes.  An empty
    table gives no row; further columns are not read.
    """
    space = Workspace(vectors.sparkSession)
    whole = whole_vectors(vectors).withColumn("dim", F.size("v"))
    at = _pivots(whole, pivots)
    classes = min(pivots, max(1, -(-whole.count() // CANDIDATE_BLOCK)))
    placed = space.keep(_with_distances(whole, at, classes))
    asked = placed.where(F.col("vec_id") % every == 0)
    if queries is not None:
        given = whole_vectors(queries).withColumn("dim", F.size("v"))
        asked = space.keep(_with_distances(given, at, classes))
    rings = space.keep(_rings(placed))
    rows, parts = _dealt(_ringed(placed, rings), CANDIDATE_BLOCK, "block")
    asks, _ = _dealt(_ringed(asked, rings), QUERY_BLOCK, "asked")
    rows, asks = space.keep(rows), space.keep(asks)

    def met(cells: DataFrame, queries: DataFrame) -> DataFrame:
        keys = ["dim", "block", "asked"]
        own = queries.select("number", "vec_id", "v", "distances", "least", "dim", "asked")
        left = own.join(cells, ["dim", "asked"]).groupBy(*keys)
        right = rows.select("vec_id", "v", "distances", "dim", "block").join(cells, ["dim", "block"]).groupBy(*keys)
        schema = "asker long, query_id long, vec_id long, score long"
        return left.cogroup(right).applyInPandas(_searched(k), schema)

    # One block of a query's own ring gives it a score to reach, and nothing else.
    home = asks.select("dim", "near", "ring", "asked").distinct().join(parts, ["dim", "near", "ring"])
    block = F.struct("near", "ring", F.pmod("asked.part", "parts").alias("part")).alias("block")
    home = space.keep(home.select("dim", block, "asked"))
    first = met(home, asks.withColumn("least", F.lit(None).cast("long")))
    reached = first.groupBy(F.col("asker").alias("number")).agg(
        F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("least")
    )
    asks = space.keep(_grouped(asks.join(space.keep(reached), ["number"], "left")))
    # Where a query has fewer than k products yet, its group needs every block.
    need = F.when(F.count("least") == F.count(F.lit(1)), F.max(F.col("size") - 2.0 * F.col("least"))).alias("need")
    blocks = space.keep(_ranges(rows, "block", pivots))
    cells = space.keep(_cells(blocks, _ranges(asks, "asked", pivots, need), pivots))
    found = met(cells, asks)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
