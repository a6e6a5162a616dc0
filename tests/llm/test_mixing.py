"""Targets by hand, and a mix that keeps to them."""

from collections import Counter, defaultdict
from fractions import Fraction
from math import floor

import pytest

from siftlayer.llm.common import unit_hash
from siftlayer.llm.mixing import SEED, expected_copies, mix_sources, mixed_rows, targets


def test_targets_share_by_weight_and_stop_at_twice_the_size():
    # 1.5 * 100 = 150 words; weights a 5, b 2, c 1, null 5.
    found = targets({"b": 40, "a": 10, "c": 40, None: 10})
    assert found["a"] == found[None] == 20
    left = Fraction(150 - 40)
    assert found["b"] == min(80, left * 2 / 3) and found["c"] == 150 - 40 - found["b"]
    assert targets({}) == {} and targets({"a": 0}) == {"a": 0}


def _mix(df, **options):
    return [(r["row"]["doc_id"], r["row"]["source"], r["size"], r["target"], r["copies"]) for r in mix_sources(df, **options).collect()]


def test_each_source_comes_near_its_target(documents):
    rows = [(i, "w " * (1 + i * 31 % 17), "en", ["hot", "x", "y", None][min(i % 7, 3)]) for i in range(2000)]
    df = documents(rows)
    mixed = _mix(df)
    taken, target = defaultdict(int), {}
    for _, source, size, wanted, copies in mixed:
        assert 0 <= copies <= 2
        taken[source] += size * copies
        target[source] = wanted
    assert all(abs(taken[s] - target[s]) <= 17 for s in target)
    assert abs(sum(target.values()) - 1.5 * sum(size for _, _, size, _, _ in mixed)) < 1e-6
    assert sorted(map(str, mixed)) == sorted(map(str, _mix(df.repartition(3))))
    assert mixed != _mix(df, seed=8)
    rows = Counter(r["doc_id"] for r in mixed_rows(df).collect())
    assert rows == Counter({doc_id: copies for doc_id, _, _, _, copies in mixed if copies})
    assert mixed_rows(df).columns == df.columns


def test_odd_rows(odd_documents):
    mixed = _mix(odd_documents)
    assert len(mixed) == odd_documents.count()
    assert all(copies == 0 for _, _, size, _, copies in mixed if size == 0)
    assert _mix(odd_documents.limit(0)) == []


def test_expected_copies_rise_with_length_and_make_the_target():
    words = {0: 0, 1: 3, 5: 400, 9: 9000}
    for target in (0, 1, 500, 9403, 14000, 18800, 18806):
        found = expected_copies(words, Fraction(target))
        assert sum(found[bits] * size for bits, size in words.items()) == target
        assert all(0 <= number <= 2 for number in found.values())
        assert found[1] <= found[5] <= found[9]
    found = expected_copies(words, Fraction(5000))
    assert found[9] / found[1] == (1 + Fraction(9, 8)) / (1 + Fraction(1, 8))
    assert set(expected_copies(words, Fraction(9403), rise=Fraction(0)).values()) == {0, 1}
    assert expected_copies({}, Fraction(0)) == {} and expected_copies({0: 0}, Fraction(0)) == {0: 0}


def _by_sorting(rows):
    """Copies of the documents of one source, by sorting all of them."""
    top = 2.0**40
    need = Fraction(rows[0]["target"]) - sum(int(r["expected"]) * r["size"] for r in rows)
    ranked = []
    for r in rows:
        chance = r["expected"] - int(r["expected"])
        if chance > 0:
            odds = r["key"] / (1 - r["key"]) * (1 - chance) / chance
            ranked.append((floor(odds / (1 + odds) * top), r["size"], r["doc_id"]))
    ranked.sort()
    further, taken, at = set(), 0, 0
    while at < len(ranked) and taken + ranked[at][1] <= need:
        taken += ranked[at][1]
        further.add(ranked[at][2])
        at += 1
    left, taken = need - taken, 0
    for _, size, doc_id in ranked[at:]:
        if size <= left:
            if taken + Fraction(size, 2) > left:
                break
            taken += size
            further.add(doc_id)
    return {r["doc_id"]: int(r["expected"]) + (r["doc_id"] in further) if r["size"] else 0 for r in rows}


@pytest.mark.parametrize("seed", [SEED, 8])
def test_copies_against_a_sort_of_every_source(documents, seed):
    rows = [(i, "w " * (1 + i * i % 700), "en", ["hot", "hot", "x", None][i % 4]) for i in range(600)]
    mixed = mix_sources(documents(rows), seed=seed).select(
        "row.doc_id", "row.source", "size", "target", "expected", "copies",
        unit_hash("row.doc_id", "row.text", seed=seed).alias("key"),
    ).collect()
    by_source = defaultdict(list)
    for row in mixed:
        by_source[row["source"]].append(row)
    for own in by_source.values():
        assert _by_sorting(own) == {r["doc_id"]: r["copies"] for r in own}
        assert len({round(r["expected"], 9) for r in own if r["expected"] < 2}) != 1


def test_chances_are_kept_over_many_seeds(documents):
    """Over seeds, a length class gives about the copies expected of it.

    No text is so short that the words left over at the end would take many of it.
    """
    rows = [(i, "w " * (60 + i % 4 * 40), "en", "a" if i % 2 else "b") for i in range(400)]
    df = documents(rows)
    found, wanted = Counter(), Counter()
    for seed in range(3):
        for r in mix_sources(df, seed=seed).select("size", "row.source", "expected", "copies").collect():
            found[r["source"], r["size"]] += r["copies"]
            wanted[r["source"], r["size"]] += r["expected"]
    assert all(abs(found[key] - wanted[key]) <= 0.1 * wanted[key] for key in wanted)


def test_texts_without_an_id_are_drawn_one_by_one(documents):
    rows = [(None, f"{i} " + "w " * 9, "en", "a") for i in range(300)] + [(i, "w " * 10, "en", "b") for i in range(300)]
    taken = Counter()
    for r in mix_sources(documents(rows)).collect():
        taken[r["row"]["source"], round(r["target"])] += r["copies"] * r["size"]
    assert all(abs(words - target) <= 10 for (_, target), words in taken.items())
