"""Fill-in-middle: texts cut in three and rearranged by a displacement scatter.

The texts of an Arrow batch lie behind each other in one buffer.  Two cuts part
each into prefix, middle and suffix, and every part moves as a whole: all its
bytes share one shift between their old and their new place.  A difference array
holds the change of the shift where a part begins; its cumulative sum is the
shift of every byte of the batch, by which one scatter writes the outputs.  The
markers go into the gaps.

Restoring looks for the markers, builds the differences the other way round and
gathers.  Both work through the buffer in blocks, so that beside texts and
outputs only a block of shifts is in memory, however long a text is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .common import whole_row

# The markers, and the forms of an output.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"

CHANGED_PERCENT = 90
SPM_PERCENT = 20
SEED = "1"
BLOCK = 2**20
_MARK = 3


def _buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and the place where each begins, with the end of the last."""
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    places = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or places[-1] == places[0]:
        return np.empty(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[places[0] : places[-1]], places - places[0]


def _texts(data: np.ndarray, places: np.ndarray) -> pa.Array:
    buffers = [None, pa.py_buffer(places.astype(np.int64)), pa.py_buffer(data)]
    return pa.Array.from_buffers(pa.large_string(), len(places) - 1, buffers).cast(pa.string())


def byte_places(data: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Where the code points with these ascending numbers begin; the end for one past the last."""
    out, seen = np.full(len(points), len(data), np.int64), 0
    for start in range(0, len(data), BLOCK):
        begins = np.flatnonzero((data[start : start + BLOCK] & 0xC0) != 0x80)
        low, high = np.searchsorted(points, [seen, seen + len(begins)])
        out[low:high] = start + begins[points[low:high] - seen]
        seen += len(begins)
    return out


def shifts(starts: np.ndarray, shift: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places ``0`` to ``size`` and the shift of each, block by block.

    ``starts`` ascend; the places from one start to the next share its shift.  Of
    equal starts, those of empty parts, the last one counts.
    """
    steps, carry = np.diff(shift, prepend=0), 0
    for start in range(0, size, BLOCK):
        end = min(size, start + BLOCK)
        low, high = np.searchsorted(starts, [start, end])
        change = np.zeros(end - start, np.int64)
        change[0] = carry
        np.add.at(change, starts[low:high] - start, steps[low:high])
        moved = np.cumsum(change)
        carry = moved[-1]
        yield np.arange(start, end), moved


def _parts(form: np.ndarray, prefix: np.ndarray, middle: np.ndarray, suffix: np.ndarray) -> list[np.ndarray]:
    """Where prefix, middle and suffix stand in an output, counted from its start."""
    spm = form == SPM
    changed = form != PLAIN
    at_prefix = np.where(spm, 2 * _MARK + suffix, np.where(changed, _MARK, 0))
    at_middle = np.where(changed, 3 * _MARK, 0) + prefix + np.where(changed, suffix, 0)
    at_suffix = np.where(spm, _MARK, np.where(changed, 2 * _MARK, middle) + prefix)
    return [at_prefix, at_middle, at_suffix]


def arrange(texts: pa.Array, n: np.ndarray, first: np.ndarray, second: np.ndarray, form: np.ndarray) -> pa.Array:
    """The outputs of texts of ``n`` code points, cut after ``first`` and ``second`` of them."""
    data, places = _buffers(texts)
    before = np.cumsum(n) - n
    cuts = byte_places(data, np.stack([before + first, before + second], axis=1).ravel()).reshape(-1, 2)
    begin, end = places[:-1], places[1:]
    cuts = np.clip(cuts, begin[:, None], end[:, None])
    starts = np.stack([begin, cuts[:, 0], cuts[:, 1]], axis=1)
    prefix, middle, suffix = cuts[:, 0] - begin, cuts[:, 1] - cuts[:, 0], end - cuts[:, 1]
    changed = form != PLAIN
    to = np.append(0, np.cumsum(end - begin + 3 * _MARK * changed))
    parts = np.stack(_parts(form, prefix, middle, suffix), axis=1) + to[:-1, None]
    out = np.empty(to[-1], np.uint8)
    for place, moved in shifts(starts.ravel(), (parts - starts).ravel(), len(data)):
        out[place + moved] = data[place]
    for number, mark in enumerate((PREFIX, MIDDLE, SUFFIX)):
        for i, byte in enumerate(mark.encode()):
            out[parts[changed, number] - _MARK + i] = byte
    return _texts(out, to)


def _marks(data: np.ndarray) -> np.ndarray:
    """Places of all markers; they cannot overlap, so a block needs to look two bytes ahead only."""
    found = [np.empty(0, np.int64)]
    letters = np.frombuffer("".join(m[1] for m in (PREFIX, SUFFIX, MIDDLE)).encode(), np.uint8)
    for start in range(0, len(data), BLOCK):
        some = data[start : start + BLOCK + 2]
        hit = (some[:-2] == ord("<")) & (some[2:] == ord(">")) & np.isin(some[1:-1], letters)
        found.append(np.flatnonzero(hit) + start)
    return np.concatenate(found)


def restore(outputs: pa.Array, form: np.ndarray) -> pa.Array:
    """The texts that outputs of these forms were made of.

    A text that holds a marker is plain, so a changed output holds three: what
    lies after each of them is a part.
    """
    data, places = _buffers(outputs)
    begin, end = places[:-1], places[1:]
    changed = np.flatnonzero(form != PLAIN)
    marks = _marks(data)
    owner = np.searchsorted(places, marks, side="right") - 1
    # The end of one output and the beginning of the next can look like a marker.
    marks = marks[(form[owner] != PLAIN) & (marks + _MARK <= end[owner])]
    marks = marks.reshape(len(changed), 3)
    bounds = np.stack([marks[:, 1] - marks[:, 0], marks[:, 2] - marks[:, 1], end[changed] - marks[:, 2]], axis=1)
    spm = (form[changed] == SPM)[:, None]
    # In the order prefix, middle, suffix.
    order = np.where(spm, [[1, 2, 0]], [[0, 2, 1]])
    source = np.repeat(begin[:, None], 3, axis=1)
    source[changed] = np.take_along_axis(marks, order, axis=1) + _MARK
    size = np.zeros((len(form), 3), np.int64)
    size[:, 0] = end - begin
    size[changed] = np.take_along_axis(bounds, order, axis=1) - _MARK
    to = np.append(0, np.cumsum(size.sum(axis=1)))
    starts = to[:-1, None] + np.cumsum(size, axis=1) - size
    out = np.empty(to[-1], np.uint8)
    for place, moved in shifts(starts.ravel(), (source - starts).ravel(), len(out)):
        out[place] = data[place + moved]
    return _texts(out, to)


def _forms(form: pa.Array) -> np.ndarray:
    return np.array(form.to_pylist(), dtype=object).astype(str)


@F.arrow_udf(StringType())
def _arranged(texts: pa.Array, n: pa.Array, first: pa.Array, second: pa.Array, form: pa.Array) -> pa.Array:
    return arrange(texts, n.to_numpy(), first.to_numpy(), second.to_numpy(), _forms(form))


@F.arrow_udf(StringType())
def _restored(outputs: pa.Array, form: pa.Array) -> pa.Array:
    return restore(outputs, _forms(form))


def restored(output: Column, form: Column) -> Column:
    """The text that an output of a form was made of."""
    return _restored(output, form)


def _drawn(doc_id: Column, seed: str) -> list[Column]:
    """Four numbers below 2^32 that depend on the id and the seed only."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(
    docs: DataFrame, changed_percent: int = CHANGED_PERCENT, spm_percent: int = SPM_PERCENT, seed: str = SEED
) -> DataFrame:
    """Every row of ``docs`` with its text rearranged for filling in the middle.

    Returns ``row`` (all input columns), ``n`` (code points), ``form``,
    ``prefix_chars`` and ``middle_chars`` (null for a plain text) and ``output``.
    Form and cuts follow from ``doc_id`` and ``seed``; repeated ids draw alike, a
    null id counts as an empty one.  A null text counts as empty; a text that is
    empty or holds a marker stays plain.  Rows keep their number; an empty table
    gives no row.
    """
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    h1, h2, h3, h4 = _drawn(docs["doc_id"], seed)
    drawn = docs.select(
        whole_row(docs),
        text.alias("text"),
        F.length(text).cast("long").alias("n"),
        *(h.alias(f"h{i}") for i, h in enumerate((h1, h2, h3, h4), 1)),
    )
    own = F.col("text")
    marked = own.contains(PREFIX) | own.contains(SUFFIX) | own.contains(MIDDLE)
    plain = (F.col("n") == 0) | marked | (F.col("h3") % 100 >= changed_percent)
    one, two = F.col("h1") % (F.col("n") + 1), F.col("h2") % (F.col("n") + 1)
    cut = drawn.select(
        "row",
        "text",
        "n",
        F.when(plain, PLAIN).when(F.col("h4") % 100 < spm_percent, SPM).otherwise(PSM).alias("form"),
        F.least(one, two).alias("first"),
        F.greatest(one, two).alias("second"),
    )
    is_cut = F.col("form") != PLAIN
    return cut.select(
        "row",
        "n",
        "form",
        F.when(is_cut, F.col("first")).alias("prefix_chars"),
        F.when(is_cut, F.col("second") - F.col("first")).alias("middle_chars"),
        _arranged("text", "n", "first", "second", "form").alias("output"),
    )
