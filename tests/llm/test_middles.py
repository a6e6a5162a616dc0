"""Rearranged texts against plain slicing, and restored ones against the texts."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siftlayer.llm import middles
from siftlayer.llm.middles import MIDDLE, PREFIX, SUFFIX, arrange, fill_in_middle, restore, restored


def sliced(text, form, first, second):
    prefix, middle, suffix = text[:first], text[first:second], text[second:]
    if form == "plain":
        return text
    if form == "psm":
        return PREFIX + prefix + SUFFIX + suffix + MIDDLE + middle
    return SUFFIX + suffix + PREFIX + prefix + MIDDLE + middle


def drawn(doc_id, text):
    """The contract, one document at a time."""
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    first, second = sorted((h[0] % (len(text) + 1), h[1] % (len(text) + 1)))
    marked = any(m in text for m in (PREFIX, SUFFIX, MIDDLE))
    form = "plain" if not text or marked or h[2] % 100 >= 90 else "spm" if h[3] % 100 < 20 else "psm"
    return text, form, first, second


letters = st.text(st.sampled_from("<>PSMab é☃😀\n"), max_size=12)


@settings(deadline=None, max_examples=150)
@given(st.lists(st.tuples(letters, st.integers(0, 99), st.integers(0, 99), st.sampled_from(["psm", "spm", "plain"])), max_size=8))
@pytest.mark.parametrize("block", [1, 3, 2**20])
def test_scatter_and_gather(block, rows):
    rows = [(t, a % (len(t) + 1), b % (len(t) + 1), f) for t, a, b, f in rows]
    rows = [(t, min(a, b), max(a, b), "plain" if any(m in t for m in (PREFIX, SUFFIX, MIDDLE)) else f) for t, a, b, f in rows]
    before, middles.BLOCK = middles.BLOCK, block
    try:
        texts = pa.array([""] + [r[0] for r in rows], pa.string())[1:]
        n, first, second = (np.array(x, np.int64) for x in ([len(r[0]) for r in rows], [r[1] for r in rows], [r[2] for r in rows]))
        form = np.array([r[3] for r in rows], dtype=str)
        made = arrange(texts, n, first, second, form)
        assert made.to_pylist() == [sliced(t, f, a, b) for t, a, b, f in rows]
        assert restore(made, form).to_pylist() == [r[0] for r in rows]
    finally:
        middles.BLOCK = before


def test_odd_documents(spark, odd_documents, documents):
    extra = [(100 + i, text, None, None) for i, text in enumerate(["<P>", "a<M>b", "<S", "x" * 300_000 + "<P", "<<P", "ab" * 70])]
    extra += [(200, "copies of one row", "en", "s")] * 30
    for docs in (odd_documents, documents(extra), documents([(i, f"text {i} ☃ {'y' * i}", "en", "s") for i in range(300)])):
        docs = docs.selectExpr("*", "text as output", "text as form", "1 as n", "2 as h1")
        found = fill_in_middle(docs).withColumn("again", restored("output", "form")).collect()
        assert len(found) == docs.count()
        for r in found:
            text, form, first, second = drawn(r["row"]["doc_id"], r["row"]["text"])
            cuts = (None, None) if form == "plain" else (first, second - first)
            assert (r["form"], r["n"], r["prefix_chars"], r["middle_chars"]) == (form, len(text), *cuts)
            assert r["output"] == sliced(text, form, first, second) and r["again"] == text
    assert {r["form"] for r in found} == {"plain", "psm", "spm"}
    assert fill_in_middle(odd_documents.limit(0)).count() == 0


def test_share_and_seed_are_parameters(spark, documents):
    docs = documents([(i, "some words " * 5, "en", "s") for i in range(200)])
    forms = {r["form"]: r["count"] for r in fill_in_middle(docs, 50, 100).groupBy("form").count().collect()}
    assert set(forms) == {"plain", "spm"} and 60 < forms["spm"] < 140
    one, two = (fill_in_middle(docs, seed=s).agg(F.sum("prefix_chars")).first()[0] for s in ("1", "2"))
    assert one != two


def test_a_marker_across_two_outputs_is_none():
    made = arrange(pa.array(["<<M", ">"]), np.array([3, 1]), np.array([0, 0]), np.array([3, 0]), np.array(["psm", "plain"]))
    assert made.to_pylist() == ["<P><S><M><<M", ">"]
    assert middles.restore(made, np.array(["psm", "plain"])).to_pylist() == ["<<M", ">"]
