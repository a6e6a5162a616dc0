"""Token pieces against the tokenizer on whole texts, and bins against their law."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from siftlayer.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def _ids(tokenizer, text):
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], "<u4")


TEXTS = [
    "Plain words, some. of$$$ them%%% marked", "don't it's I'LL we've", "été ÉTÉ é Ünïcödé ß ſ İ", "123 4½ Ⅷ",
    "<|endoftext|>x <|startoftext|>", "emoji😀ok 你好世界", "a\tb\r\nc\x0bd e f", "A.B,c ...", "", "  ", None,
    "word " * 5000, "x" * 3000, "1" + "y" * 3000 + " z", "a,b.c|d e's\nf\tg\n9h", "\u2019tis na\u0308ive \ufb01x", "ÀÖØÞ×÷ª",
]


def test_words_by_themselves_give_the_ids_of_the_text(tokenizer):
    for most in (1_000_000, 20):  # a cache that holds all, and one that starts anew
        words = packing._WordIds(PATH, most)
        for _ in range(2):
            found = words([text or "" for text in TEXTS])
            assert [x + b"\0" * 4 for x in found] == [_ids(tokenizer, text).tobytes() for text in TEXTS]


def test_pieces_and_places(documents, odd_documents, tokenizer):
    for df in (documents(TEXTS), odd_documents):
        texts = {r["doc_id"]: r["text"] for r in df.collect()}
        rows = packing.pack_documents(df, PATH, group_pieces=3).collect()
        bins = {}
        for r in rows:
            ids = _ids(tokenizer, texts[r["doc_id"]]) if r["doc_id"] is not None else None
            if ids is not None:
                part = ids[r["start"] : r["start"] + r["length"]]
                assert len(part) == r["length"] == min(2048, len(ids) - r["start"])
                assert r["start"] == 2048 * r["piece"] and zlib.crc32(part.tobytes()) == r["ids_crc32"]
            bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        assert sum(r["piece"] == 0 for r in rows) == df.count()
        for own in bins.values():
            end = 0
            for offset, length in sorted(own):
                assert offset == end
                end += length
            assert end <= 2048
    assert packing.pack_documents(odd_documents.limit(0), PATH).count() == 0


def _least_bins(sizes, capacity):
    """A lower bound: for each threshold, large pieces and what cannot lie beside them."""
    best = 0
    for small in range(1, capacity // 2 + 1):
        large = [x for x in sizes if x > capacity - small]
        half = [x for x in sizes if capacity // 2 < x <= capacity - small]
        rest = sum(x for x in sizes if small <= x <= capacity // 2)
        more = max(0, -(-(rest - (len(half) * capacity - sum(half))) // capacity))
        best = max(best, len(large) + len(half) + more)
    return best


@pytest.mark.parametrize("low, high, over", [(1, 2047, 1.01), (1, 300, 1.01), (400, 1100, 1.08), (1025, 1025, 1.0)])
def test_bins_are_few(low, high, over):
    rng = random.Random(high)
    sizes = [rng.randint(low, high) for _ in range(600)]
    bins = packing.pack(sizes, 2048)
    assert sorted(i for own in bins for i in own) == list(range(600))
    assert all(sum(sizes[i] for i in own) <= 2048 for own in bins)
    assert len(bins) <= len(packing.best_fit(sizes, 2048))
    assert len(bins) <= over * _least_bins(sizes, 2048) + 1


def test_local_search_raises_squared_fill_and_empties_bins():
    sizes = [6, 4, 4, 3, 3, 5, 5]
    bins = [[0, 3], [1, 2], [4], [5], [6]]
    search = packing._Search(sizes, bins, 10)
    before = sum(x * x for x in search.fills)
    left = search.run(4)
    assert sum(x * x for x in search.fills) > before and len(left) == 3
    assert sorted(i for own in left for i in own) == list(range(7))
