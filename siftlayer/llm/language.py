"""Language identification by a byte convolutional network in numpy.

A text is read in windows of fixed length, all of them.  Every byte is one of 64
symbols; filters two, three and four symbols wide slide over a window, each
filter keeps its greatest response, and a softmax layer turns these into
probabilities.  A filter's response is a sum of table rows, one for each pair of
symbols it covers, so that scoring needs look-ups and no multiplications.  A text
gets the language with the greatest mean logarithm of probability over its windows.

The network is trained by gradient descent on a bounded sample of labelled
texts: of the ``SAMPLE`` rows of each language that a hash of the id puts first,
``SAMPLE_WINDOWS`` windows spread over the text.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import unit_hash, whole_row

WINDOW = 256
SAMPLE = 600
SAMPLE_WINDOWS = 4
FILTERS = 8
EPOCHS = 12
SEED = 11
UNKNOWN = "und"
_SYMBOLS = 64
_PAIRS = _SYMBOLS * _SYMBOLS
_SALTS = 64
_TOGETHER = 1024  # windows scored at once


def _symbols() -> np.ndarray:
    """Symbol of each byte: 0 beyond a text, 1 white space, 2 other marks, letters and
    high bytes by themselves, upper case as lower case."""
    out = np.full(256, 2, np.uint8)
    out[[9, 10, 11, 12, 13, 32]] = 1
    out[ord("0") : ord("9") + 1] = 3
    letters = np.arange(26) + 4
    out[ord("a") : ord("z") + 1] = out[ord("A") : ord("Z") + 1] = letters
    out[128:192] = 30 + np.arange(64) % 30
    out[192:256] = 60 + np.arange(64) % 4
    return out


def windows_of(text: str, table: np.ndarray, width: int) -> np.ndarray:
    """All windows of a text as rows of symbols; the last is filled with zeros."""
    data = table[np.frombuffer(text.encode(), np.uint8)]
    rows = max(1, -(-len(data) // width))
    out = np.zeros(rows * width, np.uint8)
    out[: len(data)] = data
    return out.reshape(rows, width)


@dataclass
class Network:
    """Filters of widths two, three and four as tables over pairs of symbols."""

    languages: list[str]
    tables: list[np.ndarray]  # for widths 2, 3, 3, 4, 4: the pair at the start, the pair after it
    bias: np.ndarray
    dense: np.ndarray
    offset: np.ndarray

    # For each table: its filters' width and the shift of the pair that it reads.
    LAYOUT = ((2, 0), (3, 0), (3, 1), (4, 0), (4, 2))

    @classmethod
    def fresh(cls, languages: list[str], filters: int, rng: np.random.Generator) -> Network:
        tables = [rng.normal(0, 0.3, (_PAIRS, filters)).astype(np.float32) for _ in cls.LAYOUT]
        dense = rng.normal(0, 0.1, (3 * filters, len(languages))).astype(np.float32)
        return cls(
            languages, tables, np.zeros(3 * filters, np.float32), dense, np.zeros(len(languages), np.float32)
        )

    def pooled(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Greatest response of each filter in each window, where it is, and the pairs."""
        pairs = rows[:, :-1].astype(np.int32) * _SYMBOLS + rows[:, 1:]
        best, place = [], []
        for width in (2, 3, 4):
            length = rows.shape[1] - width + 1
            total = None
            for table, (own, shift) in zip(self.tables, self.LAYOUT, strict=True):
                if own == width:
                    part = table[pairs[:, shift : shift + length]]
                    total = part if total is None else np.add(total, part, out=total)
            at = total.argmax(axis=1)
            place.append(at)
            best.append(np.take_along_axis(total, at[:, None, :], axis=1)[:, 0])
        return np.concatenate(best, axis=1) + self.bias, np.concatenate(place, axis=1), pairs

    def maxima(self, rows: np.ndarray) -> np.ndarray:
        """Greatest responses alone."""
        pairs = rows[:, :-1].astype(np.int32) * _SYMBOLS + rows[:, 1:]
        best = []
        for width in (2, 3, 4):
            length = rows.shape[1] - width + 1
            total = None
            for table, (own, shift) in zip(self.tables, self.LAYOUT, strict=True):
                if own == width:
                    part = np.take(table, pairs[:, shift : shift + length], axis=0)
                    total = part if total is None else np.add(total, part, out=total)
            best.append(total.max(axis=1))
        return np.concatenate(best, axis=1) + self.bias

    def scores(self, hidden: np.ndarray) -> np.ndarray:
        """Logarithms of the probabilities, from greatest responses."""
        logits = np.maximum(hidden, 0) @ self.dense + self.offset
        logits -= logits.max(axis=1, keepdims=True)
        return logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))

    def learn(self, rows: np.ndarray, labels: np.ndarray, rate: float) -> None:
        """One step of gradient descent, sparse in the tables."""
        hidden, place, pairs = self.pooled(rows)
        wrong = np.exp(self.scores(hidden))
        wrong[np.arange(len(labels)), labels] -= 1
        wrong /= len(labels)
        back = (wrong @ self.dense.T) * (hidden > 0)
        self.dense -= rate * np.maximum(hidden, 0).T @ wrong
        self.offset -= rate * wrong.sum(axis=0)
        self.bias -= rate * back.sum(axis=0)
        filters = self.tables[0].shape[1]
        row = np.arange(len(labels))[:, None]
        for table, (width, shift) in zip(self.tables, self.LAYOUT, strict=True):
            own = slice((width - 2) * filters, (width - 1) * filters)
            pair = pairs[row, place[:, own] + shift]
            np.subtract.at(table, (pair, np.arange(filters)), rate * 8 * back[:, own])


def train(
    texts: list[list[str]], labels: list[str], filters: int = FILTERS, epochs: int = EPOCHS, seed: int = SEED
) -> Network | None:
    """A network for the languages that occur, from parts of texts; none without any."""
    languages = sorted(set(labels))
    if not languages:
        return None
    rng, table = np.random.default_rng(seed), _symbols()
    number = {name: i for i, name in enumerate(languages)}
    rows, wanted = [], []
    for parts, label in zip(texts, labels, strict=True):
        rows.append(np.concatenate([windows_of(part, table, WINDOW)[:1] for part in parts]))
        wanted.append(np.full(len(parts), number[label]))
    rows, wanted = np.concatenate(rows), np.concatenate(wanted)
    network = Network.fresh(languages, filters, rng)
    for epoch in range(epochs):
        order = rng.permutation(len(rows))
        for start in range(0, len(order), 64):
            some = order[start : start + 64]
            network.learn(rows[some], wanted[some], 0.5 * (1 - epoch / epochs))
    return network


def has_letter(text: str | None) -> bool:
    if not text:
        return False
    return any(unicodedata.category(c)[0] == "L" for c in text) if not text.isascii() else any(map(str.isalpha, text))


def predict(network: Network | None, texts: list[str | None]) -> tuple[list[str], list[float]]:
    """Language and its probability for each text, over all windows of the whole text."""
    table, names, scores = _symbols(), [UNKNOWN] * len(texts), [0.0] * len(texts)
    waiting: list[tuple[int, np.ndarray]] = []
    sums = np.zeros((len(texts), len(network.languages) if network else 0))
    counts = np.zeros(len(texts))

    def flush() -> None:
        if waiting:
            rows = np.concatenate([own for _, own in waiting])
            owner = np.concatenate([np.full(len(own), i) for i, own in waiting])
            np.add.at(sums, owner, network.scores(network.maxima(rows)))
            np.add.at(counts, owner, 1)
            waiting.clear()

    known = [network is not None and has_letter(text) for text in texts]
    held = 0
    for i, text in enumerate(texts):
        if known[i]:
            rows = windows_of(text, table, WINDOW)
            for start in range(0, len(rows), _TOGETHER):
                waiting.append((i, rows[start : start + _TOGETHER]))
                held += len(waiting[-1][1])
                if held >= _TOGETHER:
                    flush()
                    held = 0
    flush()
    for i in np.nonzero(known)[0]:
        mean = sums[i] / counts[i]
        share = np.exp(mean - mean.max())
        share /= share.sum()
        names[i], scores[i] = network.languages[int(share.argmax())], float(share.max())
    return names, scores


def _sample(docs: DataFrame, size: int) -> DataFrame:
    """Parts of the labelled rows of each language that a hash of the id puts first.

    Each task sends at most ``size`` rows of a language on; these meet in
    ``_SALTS`` groups before the last choice, so that no task gets one share of
    every other.
    """
    spread = F.floor((F.length("text") - 1) / F.lit(SAMPLE_WINDOWS))
    parts = [F.substring("text", spread * i + 1, F.lit(WINDOW)) for i in range(SAMPLE_WINDOWS)]
    rank, tie = unit_hash("doc_id", seed=SEED).alias("rank"), F.xxhash64("text").alias("tie")
    rows = docs.select("lang", "doc_id", rank, tie, F.array_distinct(F.array(*parts)).alias("parts"))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", "tie"), F.lit(_SALTS)))
    for keys in (["lang", "salt"], ["lang"]):
        order = Window.partitionBy(*keys).orderBy("rank", "doc_id", "tie")
        rows = rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= size)
    return rows.orderBy("lang", "place").select("parts", "lang")


def _predictor(network: Network | None):
    """``lang_pred`` and ``score`` of a text; only texts go to the workers."""

    @F.pandas_udf("lang_pred string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            names, scores = predict(network, batch.tolist())
            yield pd.DataFrame({"lang_pred": names, "score": scores})

    return run


def held_out(doc_id, folds: int, fold: int):
    """Whether a document belongs to the fold that no model learns from."""
    number = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return (number % folds) == fold


def identify_languages(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Every row of ``docs`` with the language of its text.

    Returns ``row`` (all input columns), ``held_out``, ``lang_pred`` and
    ``score``.  The network learns from at most ``sample`` texts of each non-null
    language outside the held-out fold; only texts enter a prediction.  A text
    that is null, empty or without a letter, and every text where nothing is
    labelled, is ``und`` with score 0.  Repeated rows are predicted alike; a null
    id counts as an empty string in the fold; an empty table gives no row.
    """
    text, lang = docs["text"].cast("string").alias("text"), docs["lang"].cast("string").alias("lang")
    fold = held_out(docs["doc_id"], 4, 2)
    labelled = docs.where(~fold & lang.isNotNull() & text.isNotNull()).select(
        docs["doc_id"].cast("long").alias("doc_id"), text, lang
    )
    rows = [row for row in _sample(labelled, sample).collect() if has_letter("".join(row["parts"]))]
    network = train([row["parts"] for row in rows], [row["lang"] for row in rows])
    found = docs.select(whole_row(docs), fold.alias("held_out"), _predictor(network)(text).alias("found"))
    return found.select("row", "held_out", "found.lang_pred", "found.score")
