"""Shards against exact sums, and their places."""

import zlib

import pytest

from siftlayer.llm import sharding


def _rows(df):
    return [
        (r["row"]["doc_id"], r["row"]["text"], r["size"], r["crc"], r["shard"], r["slot"])
        for r in df.collect()
    ]


def _check(rows, shards, slack):
    sums, slots, keys = [0] * shards, [[] for _ in range(shards)], [[] for _ in range(shards)]
    for doc_id, text, size, crc, shard, slot in rows:
        raw = (text or "").encode()
        assert (size, crc) == (len(raw) + 1, zlib.crc32(raw))
        sums[shard] += size
        slots[shard].append(slot)
        keys[shard].append((slot, crc, -(2**63) if doc_id is None else doc_id))
    total = sum(sums)
    for own in slots:
        assert sorted(own) == list(range(len(own)))
    ordered = [key[1:] for own in keys for key in sorted(own)]
    assert ordered == sorted(ordered)  # shards and slots follow one order
    assert all(abs(x - total / shards) <= slack for x in sums)


@pytest.mark.parametrize("tolerance", [1e-4, 0.2])
def test_shards_have_near_equal_bytes(documents, tolerance):
    texts = [f"{i} " * (i * 37 % 61) for i in range(400)]
    rows = _rows(sharding.shard_by_bytes(documents(texts), 7, tolerance))
    assert len(rows) == 400
    most = max(map(len, texts)) + 1
    _check(rows, 7, 2 * (most + tolerance * sum(len(t) + 1 for t in texts) / 7))


def test_a_group_of_equal_texts_is_cut_by_id(documents):
    rows = _rows(sharding.shard_by_bytes(documents(["same"] * 300 + [str(i) for i in range(100)]), 16))
    _check(rows, 16, 2 * 5)


def test_rows_equal_in_all_columns_are_cut_apart(documents):
    """A third of all rows are one row without an id, another third one row with an id."""
    rows = [(None, "no id", "en", "s")] * 300 + [(7, "one id", "en", "s")] * 300
    rows = _rows(sharding.shard_by_bytes(documents(rows + [(i, str(i), "en", "s") for i in range(300)]), 16))
    assert len(rows) == 900
    _check(rows, 16, 2 * 7)


def test_odd_rows(odd_documents):
    rows = _rows(sharding.shard_by_bytes(odd_documents, 4))
    assert len(rows) == odd_documents.count()
    _check(rows, 4, 2 * 500_000)
    assert sharding.shard_by_bytes(odd_documents.limit(0), 4).count() == 0
