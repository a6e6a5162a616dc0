"""The corpus pipeline: from raw documents to packed training sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftlayer.llm.common import Workspace, default_tokenizer, table
from siftlayer.llm.language import UNKNOWN, identify_languages
from siftlayer.llm.mixing import mixed_rows
from siftlayer.llm.packing import pack_documents
from siftlayer.llm.simhash import RADIUS, SHINGLE, near_duplicates
from siftlayer.llm.suffixes import remove_repeats


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the network can tell; those without letters go.

    Where no labelled row lies outside the held-out fold nothing is learnt, every
    prediction is unknown, and only the rows without a letter go.
    """
    told = F.col("lang_pred") != UNKNOWN
    untaught = ~told & F.coalesce(F.col("row.text").rlike(r"\p{L}"), F.lit(False))
    return identify_languages(docs).where(told | untaught).select("row.*")


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints link: the one with the least id.

    Of rows without an id, or equal ones, the first read stays; an id comes
    before none.  Rows are told apart by a number of their own, so one id may
    hold several texts.
    """
    number = "number_" + "_".join(docs.columns)  # no column is called like that
    rows = Workspace(spark).keep(docs.withColumn(number, F.monotonically_increasing_id()))
    id_and_text = rows.select(F.col(number).alias("doc_id"), "text")
    group = near_duplicates(id_and_text, SHINGLE, RADIUS).select(F.col("doc_id").alias("row"), "component_id")
    own = rows.select(F.col(number).alias("row"), F.col("doc_id").cast("long").alias("id"))
    place = F.struct(F.col("id").isNull().alias("absent"), "id", "row")
    first = group.join(own, "row").groupBy("component_id").agg(F.min(place).alias("first"))
    kept = first.select(F.col("first.row").alias(number))
    return rows.join(kept, number, "left_semi").select(*[rows[f"`{name}`"] for name in docs.columns])


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes that stand in a document with a smaller id.

    A character of which a part is left goes as a whole; ``n_chars`` follows the
    text.  A document that loses all of it stays, with the empty text.  Other
    columns travel as JSON, which holds numbers, texts and what is made of them.
    """
    rest = docs.drop("doc_id", "text", "n_chars")
    carried = F.to_json(F.struct(*[docs[f"`{name}`"] for name in rest.columns])) if rest.columns else None
    left = remove_repeats(docs, carried, characters=True)
    text = F.col("kept").cast("string")
    columns = {"doc_id": F.col("doc_id"), "text": text, "n_chars": F.length(text).cast("long")}
    if rest.columns:
        left = left.withColumn("carried", F.from_json("carry", rest.schema))
        columns |= {name: F.col("carried").getField(name) for name in rest.columns}
    return left.select(*[columns[name].alias(name) for name in docs.columns])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources mixed to their target weights: rows repeated or left out."""
    return mixed_rows(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2048 tokens."""
    return pack_documents(docs, default_tokenizer())


STAGES = [
    ("language", language),
    ("near_duplicate", near_duplicate),
    ("repeated_passages", repeated_passages),
    ("mix", mix),
    ("pack", pack),
]

#: A trained network, fingerprints and a tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written and read again as the documents of the next."""
    space = Workspace(spark)
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = space.keep(stage(spark, docs, sf_dir))
    return docs
