"""Fingerprints and components against brute force over all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash

from siftlayer.llm import simhash
from siftlayer.llm.common import Workspace
from siftlayer.llm.components import connected


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(values, radius=4):
    group = list(range(len(values)))
    for i, a in enumerate(values):
        for j in range(i):
            if (a ^ values[j]).bit_count() <= radius:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    return group


def test_documents_against_brute_force(documents):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    texts = []
    for _ in range(60):
        own = rng.choices(words, k=rng.randint(0, 200))
        texts.append(" ".join(own))
        for _ in range(rng.randint(0, 3)):
            near = list(own)
            for _ in range(rng.randint(0, 2)):
                if near:
                    near[rng.randrange(len(near))] = "X"
            texts.append("  ".join(near).upper())
    found = {r["doc_id"]: r for r in simhash.near_duplicates(documents(texts)).collect()}
    prints = [brute_print(t) for t in texts]
    assert [found[i]["fp"] % 2**64 for i in range(len(texts))] == prints
    group = brute_groups(prints)
    least = {g: min(i for i, x in enumerate(group) if x == g) for g in group}
    assert [found[i]["component_id"] for i in range(len(texts))] == [least[g] for g in group]


def test_odd_rows(odd_documents):
    rows = simhash.near_duplicates(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    ids = {r["doc_id"]: r["component_id"] for r in rows if r["doc_id"] is not None}
    assert ids[1] == ids[2] == ids[3] == 1 and ids[4] == ids[5] == 4 and ids[9] == 9
    assert {r["component_id"] for r in rows if r["doc_id"] is None and r["fp"] == 0} == {1}
    assert simhash.near_duplicates(odd_documents.limit(0)).count() == 0


@pytest.mark.parametrize("large", [4096, 3])
def test_links_join_all_near_fingerprints(spark, large):
    """With small nodes the index divides patterns again and again."""
    rng = random.Random(large)
    values = set()
    for _ in range(25):
        own = rng.getrandbits(64)
        for _ in range(12):
            values.add(own)
            for _ in range(rng.randint(0, 4)):
                own ^= 1 << rng.randrange(64)
    values = sorted(values)
    space = Workspace(spark)
    df = spark.createDataFrame([(simhash._signed(v),) for v in values], "fp long")
    roots = connected(space, simhash.close_links(space, df, large=large))
    root = {r["a"] % 2**64: r["root"] % 2**64 for r in roots.collect()}
    found = [root.get(v, v) for v in values]
    wanted = brute_groups(values)
    assert len(set(zip(found, wanted))) == len(set(found)) == len(set(wanted)) > 5


def test_close_pairs_of_one_node():
    rng = np.random.default_rng(1)
    values = np.unique(rng.integers(0, 2**12, 700).astype(np.uint64))
    values = values[np.argsort(simhash._gray_rank(values))]
    pairs = {tuple(sorted(p)) for p in simhash.close_pairs(np.zeros(len(values), int), values, 2).tolist()}
    wanted = {
        (i, j) for j in range(len(values)) for i in range(j) if int(values[i] ^ values[j]).bit_count() <= 2
    }
    assert pairs == wanted


def test_patterns_meet_every_near_pair():
    masks = simhash._patterns(4)
    rng = random.Random(2)
    for _ in range(300):
        bits = sum(1 << b for b in rng.sample(range(64), 4))
        met = [m for m in masks if not bits & m]
        assert met and all(any(not bits & c for c in simhash._divided(m, 4)) for m in met)


def test_a_long_chain_is_one_component(spark):
    df = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (7, 7)], "a long, b long")
    roots = {r["a"]: r["root"] for r in connected(Workspace(spark), df).collect()}
    assert roots == {i: 0 for i in range(1, 201)} | {501: 500}
