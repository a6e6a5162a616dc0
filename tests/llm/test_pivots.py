"""Exact search against all products."""

import numpy as np
import pytest

from siftlayer.llm.pivots import _distances, exact_top_k, search_block


def brute(vectors, queries, k):
    out = set()
    for qid, q in queries:
        scores = sorted((-int(q @ v), i) for i, v in vectors if i != qid and len(v) == len(q))
        out |= {(qid, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)}
    return out


def _whole(rows):
    return [(i, np.floor(256 * np.asarray(v, float)).astype(np.int64)) for i, v in rows]


def test_against_brute_force(spark, monkeypatch):
    from siftlayer.llm import pivots

    monkeypatch.setattr(pivots, "CANDIDATE_BLOCK", 100)
    monkeypatch.setattr(pivots, "QUERY_BLOCK", 5)
    rng = np.random.default_rng(3)
    rows = [(i, np.float32(rng.normal(0, 1 + i % 5, 8)).tolist()) for i in range(600)]
    rows += [(600 + i, rows[7][1]) for i in range(20)]  # ties
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = {tuple(r) for r in exact_top_k(df).collect()}
    whole = _whole(rows)
    assert found == brute(whole, [x for x in whole if x[0] % 50 == 0], 5)
    some = df.where("vec_id in (3, 607)")
    found = {tuple(r) for r in exact_top_k(df, some, k=30).collect()}
    assert found == brute(whole, [x for x in whole if x[0] in (3, 607)], 30)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (50, [0.5, -0.001]), (1, None), (2, [1.0, None]), (3, [nan, 1.0]), (4, [inf, 1.0]),
        (None, [1.0, 1.0]), (100, [1.0]), (5, []), (150, []), (6, [3e6, 3e6]), (7, [1.0, 2.0]), (7, [1.0, 2.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    df = df.selectExpr("*", "vec_id as query_id", "vec_id as rank", "vec_id as v", "vec_id as dim")
    found = sorted(tuple(r) for r in exact_top_k(df, k=5).collect())
    assert [r[:3] for r in found] == [
        (0, 1, 6), (0, 2, 7), (0, 3, 7), (0, 4, 50), (50, 1, 6), (50, 2, 0), (50, 3, 7), (50, 4, 7), (150, 1, 5)
    ]
    assert found[1][3] == 256 * 256 + 512 * 512 and found[-1][3] == 0
    assert exact_top_k(df.limit(0)).count() == 0


@pytest.mark.parametrize("scale", [1, 2**40])
def test_bounds_leave_candidates_out_and_none_that_counts(scale):
    """Clusters around the pivots: most candidates are never evaluated."""
    rng = np.random.default_rng(5)
    centers = rng.integers(-500, 500, (16, 6)) * 20
    rows = (centers[rng.integers(0, 16, 4000)] + rng.integers(-30, 30, (4000, 6))) * min(scale, 2**12)
    ids = rng.permutation(4000)
    distances = _distances(rows, centers * min(scale, 2**12))
    best, evaluated = search_block((ids[:10], rows[:10], distances[:10]), (ids, rows, distances), 5)
    for i in range(10):
        order = sorted((-int(s), int(j)) for s, j in zip(rows @ rows[i], ids) if j != ids[i])[:5]
        assert [(-s, j) for s, j in zip(best.score[i].tolist(), best.id[i].tolist())] == [(s, j) for s, j in order]
    assert evaluated < 10 * 4000 * 0.8


def test_blocks_out_of_reach_are_not_sent(spark, monkeypatch):
    """Far clusters: most pairs of blocks and groups never meet, and nothing of the result is lost."""
    from siftlayer.llm import pivots

    monkeypatch.setattr(pivots, "CANDIDATE_BLOCK", 100)
    monkeypatch.setattr(pivots, "QUERY_BLOCK", 10)
    kept, cells = [], pivots._cells

    def counted(blocks, groups, count):
        out = cells(blocks, groups, count)
        kept.append((out.count(), blocks.count() * groups.count()))
        return out

    monkeypatch.setattr(pivots, "_cells", counted)
    rng = np.random.default_rng(9)
    centers = rng.normal(0, 1, (12, 16))
    centers /= np.linalg.norm(centers, axis=1)[:, None]
    rows = [(i, (centers[i % 12] + rng.normal(0, 0.01, 16)).tolist()) for i in range(3000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = _whole(rows)
    assert {tuple(r) for r in exact_top_k(df).collect()} == brute(whole, [x for x in whole if x[0] % 50 == 0], 5)
    met, all_pairs = kept[0]
    assert met < all_pairs / 2


def test_one_vector_as_a_third_of_all_rows(spark, monkeypatch):
    """Rows of one id and one vector are dealt over several blocks."""
    from siftlayer.llm import pivots

    monkeypatch.setattr(pivots, "CANDIDATE_BLOCK", 50)
    sizes, ranges = [], pivots._ranges

    def counted(frame, name, *further):
        if name == "block":
            sizes.extend(r["count"] for r in frame.groupBy("dim", "block").count().collect())
        return ranges(frame, name, *further)

    monkeypatch.setattr(pivots, "_ranges", counted)
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(0, 1, 4).tolist()) for i in range(800)] + [(7, [1.0] * 4)] * 400
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = _whole(rows)
    assert {tuple(r) for r in exact_top_k(df).collect()} == brute(whole, [x for x in whole if x[0] % 50 == 0], 5)
    assert sum(sizes) == 1200 and max(sizes) <= 100


def test_given_queries_of_other_places_and_lengths(spark, monkeypatch):
    """A query may lie in a ring without rows, have a length no row has, or there may be none."""
    from siftlayer.llm import pivots

    monkeypatch.setattr(pivots, "CANDIDATE_BLOCK", 20)
    monkeypatch.setattr(pivots, "QUERY_BLOCK", 2)
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(0, 1, 3).tolist()) for i in range(200)]
    asked = [(1000 + i, (rng.normal(0, 1, 3) * 10.0**i).tolist()) for i in range(-3, 6)] + [(2000, [0.0] * 3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    queries = spark.createDataFrame([*asked, (3000, [1.0])], df.schema)
    found = {tuple(r) for r in exact_top_k(df, queries).collect()}
    assert found == brute(_whole(rows), _whole(asked), 5)
    # More are asked for than there are.
    few = {tuple(r) for r in exact_top_k(df.limit(3), queries).collect()}
    assert few == brute(_whole([tuple(r) for r in df.limit(3).collect()]), _whole(asked), 5)
    assert exact_top_k(df, queries.limit(0)).count() == 0
