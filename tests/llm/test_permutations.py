"""The permutation index against all products."""

import numpy as np
import pytest

from siftlayer.llm import permutations
from siftlayer.llm.permutations import Index, near_neighbours
from siftlayer.llm.queries import op13_permutation_index

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k=20, every=20):
    out = {}
    for qid, q in rows:
        if qid % every == 0:
            scores = sorted((-float((v * q).sum()), i) for i, v in rows if i != qid)
            out[qid] = [(i, -s) for s, i in scores[:k]]
    return out


def grouped(found):
    out = {}
    for r in sorted(found.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def recall(found, expected):
    assert found.keys() == expected.keys()
    assert all(len(found[q]) == len(expected[q]) for q in expected)
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in expected[q]}) for q in expected)
    return hits / sum(map(len, expected.values()))


def _rows(df):
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    usable = [(i, v) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    return [(i, np.array(v, float)) for i, v in usable if any(v)]


def test_recall_on_the_table(spark, sf_dir):
    rows = _rows(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    found, expected = grouped(op13_permutation_index(spark, sf_dir)), brute(rows)
    assert recall(found, expected) >= 0.95
    vectors = dict(rows)
    for q, own in found.items():
        assert own == sorted(own, key=lambda x: (-x[1], x[0]))
        assert [s for _, s in own] == pytest.approx([vectors[i] @ vectors[q] for i, _ in own], rel=1e-12)


@pytest.mark.parametrize("spread", [1.0, 30.0])
def test_lengths_and_blocks(spark, monkeypatch, spread):
    """Equal and very different lengths, over several blocks of rows and of queries."""
    monkeypatch.setattr(permutations, "CANDIDATE_BLOCK", 500)
    monkeypatch.setattr(permutations, "QUERY_BLOCK", 40)
    rng = np.random.default_rng(2)
    rows = rng.normal(0, 1, (1500, 16)) * spread ** rng.uniform(-1, 1, (1500, 1))
    df = spark.createDataFrame([(i, row.astype(np.float32).tolist()) for i, row in enumerate(rows)], SCHEMA)
    expected = brute(_rows(df))
    assert recall(grouped(near_neighbours(df)), expected) >= 0.9
    exact = grouped(near_neighbours(df, share=1))
    assert {q: [i for i, _ in own] for q, own in exact.items()} == {q: [i for i, _ in own] for q, own in expected.items()}


def test_copies_do_not_crowd_out_others(spark):
    """Half of all rows are one vector; a whole row comes forty times."""
    rng = np.random.default_rng(4)
    rows = [(i, (row * (9 if i == 7 else 1)).tolist()) for i, row in enumerate(rng.normal(0, 1, (600, 8)).astype(np.float32))]
    rows += [(600 + i, rows[7][1]) for i in range(600)] + [(620, rows[7][1])] * 40
    df = spark.createDataFrame(rows, SCHEMA)
    assert recall(grouped(near_neighbours(df)), brute([(i, v) for i, v in _rows(df.distinct())])) >= 0.9
    found = grouped(near_neighbours(df, df.where("vec_id in (7, 620)"), k=5, share=1))
    ties = [7, *range(600, 1200)]
    assert [i for i, _ in found[620]] == ties[:5] and [i for i, _ in found[7]] == ties[1:6]


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (20, [0.5, -0.0]), (20, [0.5, 0.0]), (1, None), (2, [1.0, None]), (3, [nan, 1.0]), (4, [inf, 1.0]),
        (None, [1.0, 1.0]), (40, [1.0]), (5, []), (6, [0.0, 0.0]), (60, [1e300, -1e300]), (61, [1e300, 1e300]), (62, [1e-300, 0.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    df = df.selectExpr("*", "vec_id as query_id", "vec_id as rank", "vec_id as v", "vec_id as dim", "vec_id as block")
    found = grouped(near_neighbours(df, k=3))
    assert found.keys() == {0, 20, 60}
    assert found[0][0] == (61, 3e300) and found[0][1] == (20, 0.5)
    assert [i for i, _ in found[60]] == [20, 62, 0] and found[60][0][1] == 5e299
    assert near_neighbours(df.limit(0)).count() == 0
    assert near_neighbours(df, df.limit(0)).count() == 0


def test_footrule_of_postings():
    """Sums read from the lists are those of whole orders cut after the posted places."""
    rng = np.random.default_rng(6)
    rows = rng.normal(0, 1, (90, 5))
    index = Index.built(np.arange(90), rows, 3, pivots=20, posted=8)
    size = np.sqrt((index.rows**2).sum(axis=1))
    level = np.column_stack([index.rows, np.sqrt(np.maximum(0, size.max() ** 2 - size**2))]) / size.max()
    query = rng.normal(0, 1, 5)
    own = np.append(query / np.linalg.norm(query), 0)
    def orders(v):
        return np.argsort(((index.pivots - v) ** 2).sum(axis=1), kind="stable").tolist()

    near = orders(own)[:6]
    expected = [
        sum(abs((order.index(p) if p in order else 8) - i) for i, p in enumerate(near))
        for order in (orders(v)[:8] for v in level)
    ]
    assert index.footrule(query, 6).tolist() == expected


def test_few_products_and_short_lists(monkeypatch):
    """In vectors without any clusters few of a block are scored, and sums take two bytes a vector."""
    rng = np.random.default_rng(8)
    rows = rng.normal(0, 1, (6000, 64))
    rows /= np.linalg.norm(rows, axis=1)[:, None]
    index = Index.built(np.arange(6000), rows, 20)
    assert index.footrule(rows[0]).nbytes == 2 * len(rows)
    scored = []
    plain = Index._scores
    monkeypatch.setattr(Index, "_scores", lambda self, some, query: scored.append(len(some)) or plain(self, some, query))
    found, expected = {}, {}
    for i in range(0, 6000, 60):
        found[i] = list(zip(*index.found(i, rows[i], 20, permutations.SHARE, permutations.MORE), strict=True))
        products = rows @ rows[i]
        expected[i] = [(j, products[j]) for j in np.argsort(-products) if j != i][:20]
    assert max(scored) <= 6000 / 14 + 512
    assert recall(found, expected) >= 0.97


def test_least_sums_with_ties():
    sums = np.array([5, 2, 5, 0, 5, 2], np.int16)
    for count in range(1, 6):
        assert sorted(permutations._least(sums, count)) == sorted([3, 1, 5, 0, 2, 4][:count])


@pytest.mark.parametrize("count", [1, 2, 127, 128, 129, 256])
def test_as_many_vectors_as_a_number_type_counts(count):
    rows = np.random.default_rng(9).normal(0, 1, (count, 3))
    ids, scores = Index.built(np.arange(count), rows, 5).found(0, rows[0], 5, 0, 60)
    assert len(ids) == min(5, count - 1) and scores.tolist() == [(rows[i] * rows[0]).sum() for i in ids]
    assert (Index.built(np.arange(count), rows, 5).footrule(rows[0]) >= 0).all()
