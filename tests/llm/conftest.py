import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that the operators use for columns of their own.
CLASHING = ("row", "size", "crc", "shard", "rank", "bucket", "chunk", "carry", "score", "copies", "fp", "bin", "part")


@pytest.fixture
def documents(spark):
    """A table of documents from texts, or from (id, text, lang, source) rows."""

    def make(rows):
        full = []
        for number, row in enumerate(rows):
            doc_id, text, lang, source = row if isinstance(row, tuple) else (number, row, "en", "s")
            full.append((doc_id, text, lang, source, None if text is None else len(text)))
        df = spark.createDataFrame(full, SCHEMA)
        return df.select("*", *(df["n_chars"].alias(name) for name in CLASHING))

    return make


@pytest.fixture
def odd_documents(documents):
    """Nulls in every column, empty and blank texts, ties, repeated rows, a very long text."""
    long = "the quick brown fox jumps over the lazy dog and " * 9000
    return documents(
        [
            (1, None, None, None),
            (2, "", "en", None),
            (3, " \n\t ", "de", "a"),
            (4, long, "en", "b"),
            (5, long, "en", "b"),
            (5, long, "en", "b"),
            (None, "words without an id", None, "a"),
            (None, None, None, None),
            (9, "Grüße, été ☃ 你好 emoji😀", "de", "c"),
            (-7, "negative ids come first", "en", "c"),
            (2**62, "great ids come last", "en", "c"),
        ]
    )
