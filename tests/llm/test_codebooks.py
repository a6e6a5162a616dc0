"""Codes, errors and codebooks against plain loops over all entries."""

import hashlib
from collections import defaultdict

import numpy as np
import pytest

from siftlayer.llm import codebooks
from siftlayer.llm.codebooks import assigned, compress_vectors, cut, pack_block, with_label_errors


def plain(rows, parts=16, entries=64, rounds=2):
    """``rows`` of (id, label, whole numbers), in the order of their ids."""
    slices = cut(len(rows[0][2]), parts)
    out, books = [], []
    for own in slices:
        vectors = [list(v[own]) for _, _, v in rows]
        book = [list(v) for v in vectors[:entries]]

        def nearest(v, book=book):
            return min((sum((a - b) ** 2 for a, b in zip(v, e)), i) for i, e in enumerate(book))

        for _ in range(rounds):
            members = defaultdict(list)
            for v in vectors:
                members[nearest(v)[1]].append(v)
            for i, some in members.items():
                book[i] = [sum(x) // len(some) for x in zip(*some)]
        out.append([nearest(v) for v in vectors])
        books.append(book)
    numbers = ",".join(str(x) for book in books for e in book for x in e)
    codes = ["".join(f"{part[i][1]:02x}" for part in out) for i in range(len(rows))]
    errors = [sum(part[i][0] for part in out) for i in range(len(rows))]
    labels = defaultdict(int)
    for (_, label, _), error in zip(rows, errors):
        labels[label] += error
    digest = hashlib.sha256(numbers.encode()).hexdigest()
    return sorted((i, c, e, labels[la], digest) for (i, la, _), c, e in zip(rows, codes, errors))


def found(df, **options):
    out = compress_vectors(df, **options)
    rows = with_label_errors(out.rows).collect()
    return sorted((r["vec_id"], r["code"].hex(), r["error"], r["label_error"], out.digest()) for r in rows)


def whole(rows):
    return [(i, la, np.floor(256 * np.float32(v).astype(float)).astype(int).tolist()) for i, la, v in rows]


SCHEMA = "vec_id long, label int, embedding array<float>"


@pytest.mark.parametrize(("dim", "parts", "entries"), [(8, 4, 5), (10, 4, 64), (3, 5, 3)])
def test_against_plain_loops(spark, monkeypatch, dim, parts, entries):
    monkeypatch.setattr(codebooks, "BLOCK", 37)
    rng = np.random.default_rng(dim)
    rows = [(3 * i, int(rng.integers(4)) or None, (rng.normal(0, 0.2, dim)).round(2).tolist()) for i in range(200)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    expected = plain(whole(rows), parts, entries)
    assert found(df, parts=parts, entries=entries) == expected
    monkeypatch.setattr(codebooks, "FEW_LABELS", 2)
    assert found(df, parts=parts, entries=entries) == expected


def test_copies_and_few_rows(spark):
    """A third of the rows are equal in all columns; the entries are fewer than wanted."""
    rows = [(i, 1, [i / 7, -i / 9, 0.1 * i, 1.0]) for i in range(20)]
    rows += [(5, 1, rows[5][2])] * 10
    rows.sort(key=lambda r: r[0])
    assert found(spark.createDataFrame(rows, SCHEMA), parts=2) == plain(whole(rows), 2)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (4, None, [0.5, -0.001]), (1, 1, None), (2, 1, [1.0, None]), (3, 2, [nan, 1.0]), (9, 2, [inf, 1.0]),
        (None, 1, [0.25, 3.0]), (0, None, [1.0]), (6, 3, []), (7, 1, [1e30, -1e30]), (8, 2, [0.5, -0.001]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    df = df.selectExpr("*", "vec_id as id", "label as code", "label as error", "label as own_label", "label as salt")
    out = compress_vectors(df, parts=2, entries=2)
    got = {r["vec_id"]: r for r in with_label_errors(out.rows).collect()}
    assert set(got) == {4, 7, 8, None}
    assert got[4]["code"] == got[8]["code"] and got[4]["error"] == got[8]["error"]
    assert [b[1].tolist() for b in out.codebooks] == [[2**27], [-(2**27)]]
    none = compress_vectors(df.limit(0))
    assert with_label_errors(none.rows).count() == 0 and none.digest() == hashlib.sha256(b"").hexdigest()
    with pytest.raises(ValueError, match="256"):
        compress_vectors(df, entries=257)


def test_ties_go_to_the_lower_entry():
    matrix = np.array([[0, 0], [2, 0], [1, 0]])
    sizes, values, places = pack_block(matrix)
    dims = list(codebooks._unpacked(np.array(sizes), values, places, 3))
    near, error = assigned(dims, np.array([[2, 0], [0, 0], [2, 0]]))
    assert near.tolist() == [1, 0, 0] and error.tolist() == [0, 0, 1]
