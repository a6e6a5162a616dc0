"""The registered queries of this package; each applies one operator to a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .codebooks import compress_vectors, with_label_errors
from .common import default_tokenizer, table
from .language import identify_languages
from .maxent import score_texts
from .middles import fill_in_middle, restored
from .mixing import mix_sources
from .order_minhash import order_fingerprints
from .packing import pack_documents
from .pages import main_texts
from .permutations import near_neighbours
from .pivots import exact_top_k
from .sharding import shard_by_bytes
from .simhash import near_duplicates
from .suffixes import remove_repeats


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return main_texts(table(spark, sf_dir, "pages"))


def op2_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of near equal bytes."""
    return shard_by_bytes(table(spark, sf_dir, "documents")).select(
        F.col("row.doc_id").alias("doc_id"),
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes that each document loses to documents with smaller ids."""
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        (F.size("spans") / 2).cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five highest inner products of every fiftieth vector with all others."""
    return exact_top_k(table(spark, sf_dir, "embeddings"))


_OP4_SQL = """
WITH whole AS (
    SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(CAST(x AS DOUBLE))]) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
        CAST(coalesce(list_sum([q.v[i] * c.v[i] FOR i IN range(1, len(q.v) + 1)]), 0) AS BIGINT) AS score
    FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
), ranked AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
        vec_id, score
    FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


def op5_maxent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram and maximum-entropy scores of all documents."""
    return score_texts(table(spark, sf_dir, "documents"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of each document."""
    return identify_languages(table(spark, sf_dir, "documents")).select(
        F.col("row.doc_id").cast("long").alias("doc_id"), "held_out", "lang_pred", "score"
    )


def op7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document."""
    return mix_sources(table(spark, sf_dir, "documents")).select(
        F.col("row.doc_id").alias("doc_id"),
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).cast("long").alias("taken"),
    )


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of near-duplicates of each document."""
    return near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def op9_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents, of their edited texts, and how alike they are."""
    return order_fingerprints(table(spark, sf_dir, "documents"))


def op10_pack(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """All documents in sequences of 2048 tokens; ``tokenizer`` is the vocabulary file."""
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer or default_tokenizer())


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all vectors, and what they are off by."""
    found = compress_vectors(table(spark, sf_dir, "embeddings"))
    return with_label_errors(found.rows).select(
        "vec_id",
        F.lower(F.hex("code")).alias("code"),
        "error",
        "label_error",
        F.lit(found.digest()).alias("codebooks_sha256"),
    )


# The vectors of these tables have 64 components, so each of 16 parts has four.
_OP11_NEAR = """
near_{after} AS MATERIALIZED (
    SELECT p.place, p.part,
        min(list_sum([(p.w[i] - b.w[i]) * (p.w[i] - b.w[i]) FOR i IN [1, 2, 3, 4]]) * 64 + b.entry) AS best
    FROM parts p JOIN {before} b USING (part)
    GROUP BY p.place, p.part
)"""
_OP11_MEAN = """
{after} AS MATERIALIZED (
    SELECT b.part, b.entry, coalesce(m.w, b.w) AS w
    FROM {before} b LEFT JOIN (
        SELECT part, CAST(best % 64 AS BIGINT) AS entry,
            [CAST(floor(sum(w[1]) / count(*)) AS BIGINT), CAST(floor(sum(w[2]) / count(*)) AS BIGINT),
             CAST(floor(sum(w[3]) / count(*)) AS BIGINT), CAST(floor(sum(w[4]) / count(*)) AS BIGINT)] AS w
        FROM parts JOIN near_{after} USING (place, part) GROUP BY ALL
    ) m USING (part, entry)
)"""
_OP11_SQL = f"""
WITH kept AS MATERIALIZED (
    SELECT vec_id, label, row_number() OVER (ORDER BY vec_id NULLS LAST) AS place,
        [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(CAST(x AS DOUBLE))]) = 0
), parts AS MATERIALIZED (
    SELECT place, part, [v[4 * part + 1], v[4 * part + 2], v[4 * part + 3], v[4 * part + 4]] AS w
    FROM kept, range(16) AS r(part)
), book0 AS MATERIALIZED (
    SELECT part, place - 1 AS entry, w FROM parts WHERE place <= 64
), {_OP11_NEAR.format(before="book0", after="book1")}, {_OP11_MEAN.format(before="book0", after="book1")},
{_OP11_NEAR.format(before="book1", after="book2")}, {_OP11_MEAN.format(before="book1", after="book2")},
{_OP11_NEAR.format(before="book2", after="codes")}, coded AS (
    SELECT place, string_agg(printf('%02x', CAST(best % 64 AS BIGINT)), '' ORDER BY part) AS code,
        CAST(sum(best // 64) AS BIGINT) AS error
    FROM near_codes GROUP BY place
), books AS (
    SELECT sha256(string_agg(array_to_string(w, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book2
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN coded USING (place), books
"""


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents rearranged for filling in the middle, and restored again."""
    made = fill_in_middle(table(spark, sf_dir, "documents"))
    return made.select(
        F.col("row.doc_id").alias("doc_id"),
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored("output", "form").cast("binary"), 256).alias("restored_sha256"),
    )


_OP12_SQL = """
WITH drawn AS (
    SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
    FROM documents
), cut AS (
    SELECT doc_id, t, CAST(length(t) AS BIGINT) AS n,
        CAST('0x' || substr(h, 1, 8) AS BIGINT) % (length(t) + 1) AS a,
        CAST('0x' || substr(h, 9, 8) AS BIGINT) % (length(t) + 1) AS b,
        CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 90 THEN 'plain'
            WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM drawn
), parts AS (
    SELECT doc_id, t, n, form, least(a, b) AS first, greatest(a, b) AS second,
        substr(t, 1, least(a, b)) AS prefix,
        substr(t, least(a, b) + 1, greatest(a, b) - least(a, b)) AS middle,
        substr(t, greatest(a, b) + 1) AS suffix
    FROM cut
)
SELECT doc_id, n, form,
    CASE WHEN form <> 'plain' THEN CAST(first AS BIGINT) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN CAST(second - first AS BIGINT) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t
        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
    sha256(t) AS restored_sha256
FROM parts
"""

def op13_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty nearest vectors found for every twentieth one."""
    return near_neighbours(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_main_text": op1_main_text,
    "op2_shard": op2_shard,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_top_k": op4_top_k,
    "op5_maxent": op5_maxent,
    "op6_language": op6_language,
    "op7_mix": op7_mix,
    "op8_simhash": op8_simhash,
    "op9_order_minhash": op9_order_minhash,
    "op10_pack": op10_pack,
    "op11_vector_codes": op11_vector_codes,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_permutation_index": op13_permutation_index,
}

ORACLE = {"op4_top_k": _OP4_SQL, "op11_vector_codes": _OP11_SQL, "op12_fill_in_middle": _OP12_SQL}
