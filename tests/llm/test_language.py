"""Held-out accuracy, and what the network may not see."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from siftlayer.llm import language
from siftlayer.llm.language import identify_languages


def _predictions(df):
    rows = identify_languages(df, sample=80).select("row.doc_id", "row.lang", "held_out", "lang_pred", "score").collect()
    return [tuple(r) for r in rows]


def test_held_out_accuracy_and_no_leak(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = _predictions(docs)
    assert all(held == (zlib.crc32(str(i).encode()) % 4 == 2) for i, _, held, _, _ in rows)
    right = [lang == got for _, lang, held, got, _ in rows if held]
    assert len(right) > 20 and np.mean(right) >= 0.95
    assert all(0 <= score <= 1 for *_, score in rows)
    # Labels of held-out rows, and source, change nothing.
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    masked = docs.withColumn("lang", F.when(~fold, F.col("lang"))).withColumn("source", F.lit("x"))
    again = {r[0]: r[3:] for r in _predictions(masked)}
    assert again == {r[0]: r[3:] for r in rows}


def test_odd_rows(odd_documents):
    found = {r[0]: r[3:] for r in _predictions(odd_documents)}
    assert found[1] == found[2] == found[3] == ("und", 0.0)
    assert {found[i][0] for i in (4, 5, 9, -7)} <= {"en", "de"}
    assert len(_predictions(odd_documents)) == odd_documents.count()
    unlabelled = odd_documents.withColumn("lang", F.lit(None).cast("string"))
    assert {r[3:] for r in _predictions(unlabelled)} == {("und", 0.0)}
    assert _predictions(odd_documents.limit(0)) == []


def test_windows_cover_the_whole_text():
    table = language._symbols()
    text = "ab\n" * 1000 + "é"
    rows = language.windows_of(text, table, 256)
    data = table[np.frombuffer(text.encode(), np.uint8)]
    assert (rows.ravel()[: len(data)] == data).all() and not rows.ravel()[len(data) :].any()
    # The end of a text counts as much as its start.
    network = language.train([["das ist ein haus und der hund"] * 3, ["the house is here and that dog"] * 3], ["de", "en"], epochs=60)
    english, german = "the house is here and that dog " * 9, "das ist ein haus und der hund " * 9
    (names, scores) = language.predict(network, [english + german * 9, german + english * 9])
    assert names == ["de", "en"]


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(0)
    network = language.Network.fresh(["a", "b", "c"], 4, rng)
    rows, labels = rng.integers(0, 64, (6, 40)).astype(np.uint8), rng.integers(0, 3, 6)

    def loss():
        hidden, _, _ = network.pooled(rows)
        assert np.allclose(hidden, network.maxima(rows))
        return -network.scores(hidden)[np.arange(6), labels].mean()

    start = loss()
    for _ in range(30):
        network.learn(rows, labels, 0.1)
    assert loss() < start * 0.7
