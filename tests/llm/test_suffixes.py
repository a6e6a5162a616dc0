"""Removed bytes against the definition, position by position."""

import random

import numpy as np
from pyspark.sql import functions as F

from siftlayer.llm import suffixes
from siftlayer.llm.suffixes import LENGTH, remove_repeats


def brute(rows):
    """Kept bytes and spans of each (id, text), by the definition."""
    data = [(i, (text or "").encode()) for i, text in rows]
    least = {}
    for doc_id, raw in data:
        if doc_id is not None:
            for p in range(len(raw) - LENGTH + 1):
                own = raw[p : p + LENGTH]
                least[own] = min(doc_id, least.get(own, doc_id))
    out = []
    for doc_id, raw in data:
        gone = bytearray(len(raw))
        if doc_id is not None:
            for p in range(len(raw) - LENGTH + 1):
                if least[raw[p : p + LENGTH]] < doc_id:
                    gone[p : p + LENGTH] = b"\1" * LENGTH
        edges = [p for p in range(len(raw) + 1) if (gone[p] if p < len(raw) else 0) != (gone[p - 1] if p else 0)]
        out.append((doc_id, len(raw), edges, bytes(x for x, g in zip(raw, gone) if not g)))
    return sorted(out, key=repr)


def _found(df):
    rows = remove_repeats(df).collect()
    return sorted(((r["doc_id"], r["n_bytes"], list(r["spans"]), bytes(r["kept"])) for r in rows), key=repr)


def _random_texts(seed, count):
    """Texts from few letters with passages that many of them share, in part."""
    rng = random.Random(seed)
    passages = ["".join(rng.choices("ab é", k=rng.randint(45, 160))) for _ in range(12)]
    texts = []
    for _ in range(count):
        text = ""
        for _ in range(rng.randint(0, 5)):
            own = rng.choice(passages)
            cut = rng.randint(0, len(own) // 2)
            text += rng.choice([own, own[cut:], own[: len(own) - cut], "".join(rng.choices("ab c", k=40))])
        texts.append(text)
    return texts


def test_random_texts(documents):
    for seed in range(3):
        rows = list(enumerate(_random_texts(seed, 60)))
        random.Random(seed).shuffle(rows)
        assert _found(documents([(i, t, "en", "s") for i, t in rows])) == brute(rows)


def test_strings_at_the_threshold(documents):
    base = "".join(chr(97 + i * i % 26) for i in range(60))
    rows = [(1, base), (2, "x" + base[:49]), (3, "x" + base[:50]), (4, base[10:60] + base[5:55]), (5, base)]
    assert _found(documents([(i, t, "en", "s") for i, t in rows])) == brute(rows)


def test_equal_ids_and_rows_without_one_do_not_meet(documents, odd_documents):
    text = "0123456789" * 6
    rows = [(1, text), (1, text), (None, text), (None, text)]
    assert _found(documents([(i, t, "en", "s") for i, t in rows])) == brute(rows)
    kept = _found(odd_documents)
    assert len(kept) == odd_documents.count()
    assert sorted(len(r[3]) for r in kept if r[0] in (4, 5)) == [0, 0, 432_000]
    assert _found(odd_documents.limit(0)) == []


def test_whole_characters_and_carried_columns(documents):
    text = "é" * 40
    rows = [(1, text, "en", "s"), (2, "x" + text + "y", "en", "s"), (3, "é" * 26 + "è" * 30, "fr", "s")]
    df = documents(rows)
    left = remove_repeats(df, F.col("lang"), characters=True).collect()
    texts = {r["doc_id"]: bytes(r["kept"]).decode() for r in left}
    # The strings of the third document reach into its first "è", of which the first byte goes.
    assert texts == {1: text, 2: "xy", 3: "è" * 29} and {r["carry"] for r in left} == {"en", "fr"}


def test_anchors_depend_on_the_bytes_alone():
    rng = np.random.default_rng(0)
    data = rng.integers(97, 100, suffixes._SEGMENT + 500).astype(np.uint8)
    at, rank = suffixes.anchors(data)
    later, later_rank = suffixes.anchors(np.concatenate([rng.integers(97, 100, 777).astype(np.uint8), data]))
    inner = at[(at > LENGTH) & (at < len(data) - LENGTH)]
    assert set(inner) <= set(later - 777)
    assert np.diff(at).max() <= suffixes.SIDE + 1
    assert dict(zip(later - 777, later_rank))[int(inner[7])] == dict(zip(at, rank))[int(inner[7])]
