"""Language-model scores from a hashed maximum-entropy model.

A word's probability given those before it is that of its class times that of
the word within the class.  The most frequent words have classes of their own,
``SLOTS`` to a class, and a softmax within each; every other word falls into one
of sixteen classes by its spelling, and by its hash into one of ``SLOTS`` bins of it,
again with a softmax; within a bin exact counts decide.  The features are the word
before, the two before (hashed), two skips: the second and the third word before,
and for the class also the word before as it is, frequent or not, hashed into rows
that follow the vocabulary.  Weights add to the logarithms of the plain frequencies, so
that an untrained model is the unigram model.

Every task trains on its share of the training texts, in mini-batches with
gradient steps scaled by past gradients; the weights of all tasks are averaged
by their tokens, slice by slice.  Counts and weights cover all training texts.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace
from .language import held_out
from .packed import Chunks, answer_with, bucket_edges, joined, lengths_of, message_rows, mixed

SLOTS = 16
FREQUENT = 16  # classes of frequent words
SPELLED = 16  # classes of all others
TABLE_BITS = 13
WORD_BITS = 8, 15  # of the rows for words before: an eighth of the vocabulary, within these
BATCH = 16_384
RATE = 0.1
ROUNDS = 1
SLICES = 16
TEAMS = 256
END = b" "
_CLASSES = FREQUENT + SPELLED
_WORDS = FREQUENT * SLOTS
_START = _WORDS + SPELLED  # the feature of a place before the text
_FEATURES = _START + 1
_U = np.uint64
_LOG10 = np.log(10.0)


_BYTES = np.random.default_rng(3).integers(0, 2**64, 256, _U)
_STEP = _U(0x9E3779B97F4A7C15)
_POWERS = np.multiply.accumulate(np.append(_U(1), np.full(255, _STEP, _U)))


def word_keys(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A hash of each word, none empty, with its spelling class in the lowest four bits.

    The class goes by the last byte, the length, and whether there are letters
    beyond ASCII.  The hash sums a random number of each byte times a power for its
    place.
    """
    starts, sizes = offsets[:-1], np.diff(offsets)
    if not len(starts):
        return np.empty(0, _U)
    place = np.arange(offsets[0], offsets[-1]) - np.repeat(starts, sizes)
    data = data[offsets[0] : offsets[-1]]
    # Beyond 256 bytes the powers start again with another number of each byte.
    turn = (place >> 8).astype(_U)
    number = _BYTES[data] + turn * (turn + _STEP)
    number *= _POWERS[place & 255]
    at = starts - offsets[0]
    sums = mixed(np.add.reduceat(number, at) + sizes.astype(_U))
    last, beyond = data[at + sizes - 1], np.maximum.reduceat(data, at) > 127
    mark = np.select([(last >= 97) & (last != 124), last == 46, last == 44], [0, 1, 2], 3)
    spelled = mark * 4 + 2 * beyond + (sizes > 6)
    spelled[(sizes == 1) & (last == END[0])] = 0
    return sums & ~_U(15) | spelled.astype(_U)


def _keys(words: Iterable[bytes]) -> np.ndarray:
    words = list(words)
    offsets = np.append(0, np.cumsum([len(w) for w in words], dtype=np.int64))
    return word_keys(np.frombuffer(b"".join(words), np.uint8), offsets)


def _coded(texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of the distinct words, the number of each token in them, and where the documents begin.

    The end of a document is the last of its tokens and the first of the distinct words.
    """
    lower = pc.ascii_lower(pa.array([text or "" for text in texts], pa.large_string()))
    lists = pc.ascii_split_whitespace(lower)
    flat, ends = lists.flatten(), np.asarray(lists.offsets)[1:] - lists.offsets[0].as_py()
    coded = flat.dictionary_encode()
    distinct, index = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
    _, offsets, data = distinct.buffers()
    offsets = np.frombuffer(offsets, np.int64)[: len(distinct) + 1] if len(distinct) else np.zeros(1, np.int64)
    blank = np.flatnonzero(np.diff(offsets) == 0)
    if len(blank):  # what white space at an end splits off
        filled = index != blank[0]
        ends = np.append(0, np.cumsum(filled))[ends]
        index = index[filled]
        index = index - (index > blank[0])
        offsets = np.delete(offsets, blank[0])
    last = ends + np.arange(len(ends))
    out = np.zeros(len(index) + len(ends), np.int32)
    places = np.ones(len(out), bool)
    places[last] = False
    out[places] = index + 1
    data = np.frombuffer(data, np.uint8) if len(offsets) > 1 else np.empty(0, np.uint8)
    return np.append(_keys([END]), word_keys(data, offsets)), out, np.append(0, last + 1)[:-1]


# Counting.


def _counted(bits: int):
    """Counts of the training words of each batch, packed by bucket."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys, tokens, _ = _coded(batch["text"])
            number = np.bincount(tokens, minlength=len(keys))
            order = np.argsort(keys)
            keys, number = keys[order], number[order]
            edges = bucket_edges(keys, bits)
            rows = [
                (b, keys[i:j].tobytes(), number[i:j].tobytes())
                for b, (i, j) in enumerate(zip(edges[:-1], edges[1:], strict=True))
                if j > i
            ]
            yield pd.DataFrame(rows, columns=["bucket", "keys", "counts"])

    return run


def _summed(rows: pd.DataFrame) -> pd.DataFrame:
    """All words of a bucket with their counts, totals, masses of bins of spellings, and the most frequent."""
    keys, counts = joined(rows["keys"], _U), joined(rows["counts"], np.int64)
    keys, entry = np.unique(keys, return_inverse=True)
    counts = np.bincount(entry, weights=counts, minlength=len(keys)).astype(np.int64)
    top = np.lexsort((keys, -counts))[:_WORDS]
    spelled = np.bincount((keys & _U(255)).astype(np.int64), weights=counts + 0.5, minlength=SPELLED * SLOTS)
    row = (
        int(rows["bucket"].iloc[0]), keys.tobytes(), counts.tobytes(), int(counts.sum()), len(keys), spelled.tolist(),
        keys[top].view(np.int64).tolist(), counts[top].tolist(),
    )
    return pd.DataFrame([row], columns=_SUMMED_COLUMNS)


_SUMMED_COLUMNS = ["bucket", "keys", "counts", "tokens", "words", "spelled", "top_keys", "top_counts"]
_SUMMED = (
    "bucket int, keys binary, counts binary, tokens long, words long, spelled array<double>, top_keys array<long>,"
    " top_counts array<long>"
)


@dataclass
class Vocabulary:
    """The frequent words by class and slot, and how often everything occurs."""

    tokens: int
    words: int
    keys: np.ndarray  # of the frequent words, most frequent first
    counts: np.ndarray
    masses: np.ndarray  # of the spelled classes, without frequent words
    bins: np.ndarray | None = None  # of their bins

    def __post_init__(self) -> None:
        if self.bins is None:
            self.bins = np.repeat(self.masses[:, None] / SLOTS, SLOTS, axis=1)
        filled = np.zeros(_WORDS)
        filled[: len(self.counts)] = self.counts + 0.5
        by_class = filled.reshape(FREQUENT, SLOTS)
        with np.errstate(divide="ignore"):
            parts = np.concatenate([by_class, self.bins + 0.5])
            within = parts / parts.sum(axis=1, keepdims=True).clip(1e-9)
            self.within = np.log(within).clip(-60).astype(np.float32)
            self.classes = np.log(np.concatenate([by_class.sum(axis=1), self.masses + 0.5]))
        self.classes -= np.log(np.exp(self.classes).sum())
        self.classes = self.classes.clip(-60).astype(np.float32)

    @classmethod
    def of(cls, table: DataFrame) -> Vocabulary:
        """Totals of all buckets; the driver sees ``_WORDS`` words and one row of sums."""
        row = table.agg(F.sum("tokens").alias("n"), F.sum("words").alias("v")).first()
        masses = np.zeros(SPELLED * SLOTS)
        for place, mass in table.select(F.posexplode("spelled")).groupBy("pos").agg(F.sum("col")).collect():
            masses[place] = mass
        pairs = table.select(F.explode(F.arrays_zip("top_keys", "top_counts")).alias("x")).select("x.*")
        top = pairs.orderBy(F.col("top_counts").desc(), "top_keys").limit(_WORDS).collect()
        keys = np.array([r["top_keys"] for r in top], np.int64).view(_U)
        counts = np.array([r["top_counts"] for r in top], np.int64)
        np.subtract.at(masses, (keys & _U(255)).astype(np.int64), counts + 0.5)
        bins = masses.clip(0).reshape(SLOTS, SPELLED).T
        return cls(row["n"] or 0, row["v"] or 0, keys, counts, bins.sum(axis=1), bins)


def _bins(keys: np.ndarray) -> np.ndarray:
    """The bin of each word in its spelled class."""
    return ((keys >> _U(4)) & _U(SLOTS - 1)).astype(np.int32)


def _features(keys: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    """The number of a frequent word, or the spelling class of another."""
    out = _WORDS + (keys & _U(15)).astype(np.int32)
    order = np.argsort(vocabulary.keys)
    if len(order):
        at = order[np.minimum(np.searchsorted(vocabulary.keys, keys, sorter=order), len(order) - 1)]
        known = vocabulary.keys[at] == keys
        out[known] = at[known]
    return out


@dataclass
class _Text:
    """The tokens of some documents: their words, places and contexts."""

    distinct: np.ndarray  # keys
    word: np.ndarray  # of each token, in ``distinct``
    feature: np.ndarray
    slot: np.ndarray  # in its class: of a frequent word, or the bin of another
    starts: np.ndarray  # of the documents

    @classmethod
    def of(cls, texts: Iterable[str | None], vocabulary: Vocabulary) -> _Text:
        keys, tokens, starts = _coded(texts)
        feature = _features(keys, vocabulary)
        slot = np.where(feature < _WORDS, feature % SLOTS, _bins(keys))
        return cls(keys, tokens, feature[tokens], slot[tokens], starts)

    def contexts(self) -> list[np.ndarray]:
        """The features of the first, second and third word before each token, and a hash of the first."""
        count = len(self.word)
        since = np.arange(count) - np.repeat(self.starts, np.diff(np.append(self.starts, count)))
        out = []
        for back in (1, 2, 3):
            before = np.full(count, _START, np.int32)
            before[back:] = self.feature[:-back] if count > back else []
            before[since < back] = _START
            out.append(before)
        word = np.zeros(count, np.uint32)
        word[1:] = (self.distinct >> _U(32)).astype(np.uint32)[self.word[:-1]] if count > 1 else []
        word[since < 1] = 0
        return [*out, word]


class Model:
    """Weights by hashed feature: for classes, and for the slots within a class."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        low, high = WORD_BITS
        self.word_bits = min(high, max(low, vocabulary.words.bit_length() - 3))
        rows = 3 * _FEATURES + 2**TABLE_BITS + 2**self.word_bits
        self.classes = np.zeros((rows, _CLASSES), np.float32)
        self.slots = np.zeros((2 * _CLASSES * _FEATURES, SLOTS), np.float32)

    def class_rows(self, before: list[np.ndarray]) -> list[np.ndarray]:
        first, second, third, word = before
        pair = (second.astype(np.uint32) * np.uint32(_FEATURES) + first.astype(np.uint32)) * np.uint32(2654435769)
        hashed = (pair >> np.uint32(32 - TABLE_BITS)).astype(np.int32)
        own = (word >> np.uint32(32 - self.word_bits)).astype(np.int32) + (3 * _FEATURES + 2**TABLE_BITS)
        return [first, second + _FEATURES, third + 2 * _FEATURES, hashed + 3 * _FEATURES, own]

    def slot_rows(self, before: list[np.ndarray], class_: np.ndarray) -> list[np.ndarray]:
        first, second = before[:2]
        return [class_ * _FEATURES + first, (_CLASSES + class_) * _FEATURES + second]

    @staticmethod
    def _logs(table: np.ndarray, rows: list[np.ndarray], base: np.ndarray) -> np.ndarray:
        """Logarithms of a softmax over sums of table rows."""
        total = base + table[rows[0]]
        for more in rows[1:]:
            total += table[more]
        total -= total.max(axis=1, keepdims=True)
        total -= np.log(np.exp(total).sum(axis=1, keepdims=True))
        return total

    def batches(self, text: _Text) -> Iterator[tuple]:
        """Class, slot and context of the tokens, some thousands at a time."""
        before = text.contexts()
        for start in range(0, len(text.word), BATCH):
            part = slice(start, start + BATCH)
            feature = text.feature[part]
            class_ = np.where(feature < _WORDS, feature // SLOTS, feature - _WORDS + FREQUENT)
            yield part, class_, text.slot[part], [x[part] for x in before]

    def logs(self, text: _Text) -> np.ndarray:
        """Natural logarithms of each token's class and, for frequent words, of the word in it."""
        classes, slots = self.split_logs(text)
        return classes + np.where(text.feature < _WORDS, slots, 0)

    def split_logs(self, text: _Text) -> tuple[np.ndarray, np.ndarray]:
        """Natural logarithms of each token's class, and of its slot or bin in that."""
        out = np.empty(len(text.word)), np.empty(len(text.word))
        for part, class_, slot, before in self.batches(text):
            own = np.arange(len(class_))
            out[0][part] = self._logs(self.classes, self.class_rows(before), self.vocabulary.classes)[own, class_]
            rows = self.slot_rows(before, class_)
            out[1][part] = self._logs(self.slots, rows, self.vocabulary.within[class_])[own, slot]
        return out


class _Trainer:
    """Gradient steps on a task's share of the texts."""

    def __init__(self, model: Model) -> None:
        self.model, self.seen = model, 0
        self.past = np.full(model.classes.shape, 1e-2, np.float32), np.full(model.slots.shape, 1e-2, np.float32)

    def _step(self, number: int, rows: list[np.ndarray], wrong: np.ndarray) -> None:
        table, past = (self.model.classes, self.model.slots)[number], self.past[number]
        for own in rows:
            order = np.argsort(own.astype(np.int16) if len(table) < 2**15 else own, kind="stable")
            ordered = own[order]
            starts = np.nonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))[0]
            slope, at = np.add.reduceat(wrong[order], starts), ordered[starts]
            past[at] += slope * slope
            table[at] -= RATE * slope / np.sqrt(past[at])

    def learn(self, text: _Text) -> None:
        model = self.model
        self.seen += len(text.word)
        for _, class_, slot, before in model.batches(text):
            rows = model.class_rows(before)
            wrong = np.exp(model._logs(model.classes, rows, model.vocabulary.classes))
            wrong[np.arange(len(class_)), class_] -= 1
            self._step(0, rows, wrong)
            rows = model.slot_rows(before, class_)
            wrong = np.exp(model._logs(model.slots, rows, model.vocabulary.within[class_]))
            wrong[np.arange(len(class_)), slot] -= 1
            self._step(1, rows, wrong)


def _flat(model: Model) -> np.ndarray:
    return np.concatenate([model.classes.ravel(), model.slots.ravel()])


def _filled(vocabulary: Vocabulary, weights: np.ndarray | None) -> Model:
    model = Model(vocabulary)
    if weights is not None:
        cut = model.classes.size
        model.classes = weights[:cut].reshape(model.classes.shape).astype(np.float32)
        model.slots = weights[cut:].reshape(model.slots.shape).astype(np.float32)
    return model


def _trained(vocabulary: Vocabulary, weights: np.ndarray | None):
    """A task's weights times its tokens, in slices."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trainer = _Trainer(_filled(vocabulary, weights))
        for batch in batches:
            for start in range(0, len(batch), 512):
                trainer.learn(_Text.of(batch["text"].iloc[start : start + 512], vocabulary))
        if trainer.seen:
            parts = np.array_split(_flat(trainer.model), SLICES)
            yield pd.DataFrame(
                {
                    "slice": range(SLICES),
                    "team": TaskContext.get().partitionId() % TEAMS,
                    "tokens": trainer.seen,
                    "weights": [part.astype(np.float32).tobytes() for part in parts],
                }
            )

    return run


_WEIGHTS = "slice int, team int, tokens long, weights binary"


def _averaged(rows: pd.DataFrame) -> pd.DataFrame:
    """The mean of one slice of several tasks' or teams' weights, by tokens."""
    total, tokens = 0.0, int(rows["tokens"].sum())
    for seen, part in zip(rows["tokens"], rows["weights"], strict=True):
        total = total + seen * np.frombuffer(part, np.float32).astype(float)
    mean = (total / tokens).astype(np.float32).tobytes()
    row = int(rows["slice"].iloc[0]), int(rows["team"].iloc[0]), tokens, mean
    return pd.DataFrame([row], columns=["slice", "team", "tokens", "weights"])


def train(docs: DataFrame, vocabulary: Vocabulary, rounds: int = ROUNDS) -> Model:
    """The model after ``rounds`` passes over all training texts."""
    weights = None
    for _ in range(rounds):
        sent = docs.select("text").mapInPandas(_trained(vocabulary, weights), _WEIGHTS)
        # First within teams of tasks, so that no task gets a share of every other.
        teams = sent.groupBy("slice", "team").applyInPandas(_averaged, _WEIGHTS)
        mean = teams.groupBy("slice").applyInPandas(_averaged, _WEIGHTS)
        parts = sorted(mean.collect())
        if not parts:
            break
        weights = np.concatenate([np.frombuffer(row["weights"], np.float32) for row in parts])
    return _filled(vocabulary, weights)


# Scoring.


def _asked(bits: int, vocabulary: Vocabulary):
    """The distinct words of a chunk, but the frequent ones, by bucket."""

    def make(docs: pd.DataFrame) -> pd.DataFrame:
        keys = _coded(docs["text"])[0]
        keys = np.sort(keys[~np.isin(keys, vocabulary.keys)])
        edges = bucket_edges(keys, bits)
        chunk = docs["chunk"].iloc[0]
        spans = enumerate(zip(edges[:-1], edges[1:], strict=True))
        return message_rows([(chunk, b, 1, keys[i:j].tobytes(), None, None, None) for b, (i, j) in spans if j > i])

    return make


def _rare(text: _Text, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys of the words that are not frequent, and their places among the distinct words."""
    order = np.argsort(text.distinct)
    order = order[~np.isin(text.distinct[order], vocabulary.keys)]
    return text.distinct[order], order


def _looked_up(rows: pd.DataFrame, table: pd.DataFrame) -> pd.DataFrame:
    """Counts of the words that each chunk asks for."""
    if rows.empty:
        return message_rows([])
    asked, sizes = joined(rows["a"], _U), lengths_of(rows["a"], 8)
    found = np.zeros(len(asked), np.int64)
    if len(table):
        keys, counts = joined(table["keys"], _U), joined(table["counts"], np.int64)
        at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
        found = np.where(keys[at] == asked, counts[at], 0)
    # Most counts are small: 32 bits, and 64 where one needs them.
    width = np.uint32 if found.max(initial=0) < 2**32 else np.int64
    parts = np.split(found.astype(width), np.cumsum(sizes)[:-1])
    wide = np.array([width is np.int64]).tobytes()
    keys = zip(rows["chunk"], rows["bucket"], parts, strict=True)
    return message_rows([(c, b, 1, x.tobytes(), wide, None, None) for c, b, x in keys])


_COLUMNS = ["doc_id", "n_tokens", "n_known", "base_score", "score"]


def _scored(model: Model):
    vocabulary = model.vocabulary

    def make(docs: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if docs.empty:
            return pd.DataFrame(columns=_COLUMNS)
        text = _Text.of(docs["text"], vocabulary)
        _, places = _rare(text, vocabulary)
        counts = np.zeros(len(text.distinct), np.int64)
        ordered = rows.sort_values("bucket")
        kinds = [np.int64 if x[0] else np.uint32 for x in ordered["b"]]
        found = [np.frombuffer(x, kind) for x, kind in zip(ordered["a"], kinds, strict=True)]
        counts[places] = np.concatenate(found) if found else 0
        known = {int(key): int(count) for key, count in zip(vocabulary.keys, vocabulary.counts, strict=True)}
        frequent = np.nonzero(np.isin(text.distinct, vocabulary.keys))[0]
        counts[frequent] = [known[int(key)] for key in text.distinct[frequent]]
        base = np.log10((counts + 0.5) / (vocabulary.tokens + 0.5 * (vocabulary.words + 1)))
        spelled = (text.distinct & _U(15)).astype(np.int64)
        within = np.log((counts + 0.5) / (vocabulary.bins + 0.5)[spelled, _bins(text.distinct)]).clip(-700, 0)
        within[frequent] = 0
        logs = (sum(model.split_logs(text)) + within[text.word]) / _LOG10
        return pd.DataFrame(
            {
                "doc_id": docs["doc_id"].astype("Int64").to_numpy(),
                "n_tokens": np.diff(np.append(text.starts, len(text.word))),
                "n_known": np.add.reduceat((counts > 0)[text.word].astype(np.int64), text.starts),
                "base_score": np.add.reduceat(base[text.word], text.starts),
                "score": np.add.reduceat(logs, text.starts),
            }
        )

    return make


def score_texts(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Scores of all texts under a model of those outside the held-out fold.

    Returns ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` and ``score``, both base-10 logarithms.  A null or empty text
    is its end alone; a null id counts as an empty string in the fold; repeated
    rows are scored alike.  Without any training text all words are unknown.  An
    empty table gives no row; further columns are not read.
    """
    space = Workspace(docs.sparkSession)
    chunks = Chunks(docs)
    training = docs.where(~held_out(docs["doc_id"], 5, 1)).select(docs["text"].cast("string").alias("text"))
    counted = training.mapInPandas(_counted(chunks.bits), "bucket int, keys binary, counts binary")
    table = space.keep(counted.groupBy("bucket").applyInPandas(_summed, _SUMMED))
    vocabulary = Vocabulary.of(table)
    model = train(training, vocabulary, rounds)
    counts = answer_with(chunks.send(_asked(chunks.bits, vocabulary)), table.select("bucket", "keys", "counts"), _looked_up)
    schema = "doc_id long, n_tokens long, n_known long, base_score double, score double"
    scored = chunks.send(_scored(model), [counts], schema)
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id"), 5, 1).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(vocabulary.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )
