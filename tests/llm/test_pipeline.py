"""The stages one by one, and what the registry promises."""

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from siftlayer.llm.queries import ORACLE, QUERIES


def test_all_operators_and_the_pipeline_are_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= contract.queries().keys()
    assert ORACLE.items() <= contract.oracle_sql().items()
    assert len(corpus_pipeline.STAGES) == 5


def _stages(spark, docs, tmp_path):
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, out[-1], "").write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def test_stages_take_effect(spark, documents, tmp_path):
    body = [" ".join(f"word{i}x{j}" for j in range(80)) for i in range(12)]
    shared = " ".join(f"shared{j}" for j in range(60))
    rows = [(i, text, "en", f"s{i % 2}") for i, text in enumerate(body)]
    rows += [(20, body[3], "en", "s0"), (21, body[4] + " more", "en", "s1"), (22, "123 456", "en", "s0"), (23, None, None, None)]
    rows += [(30, body[0][:300] + " x " + shared, "en", "s1"), (31, "other words before " + shared, "en", "s1")]
    docs = documents(rows).drop("part", "row", "bucket")
    start, known, single, cut, mixed, packed = _stages(spark, docs, tmp_path)
    assert all(df.columns == docs.columns for df in (known, single, cut, mixed))
    ids = [sorted(r["doc_id"] for r in df.select("doc_id").collect()) for df in (known, single, cut)]
    assert ids[0] == sorted({i for i, *_ in rows} - {22, 23})
    assert ids[1] == ids[2] == sorted(set(ids[0]) - {20, 21})
    texts = {r["doc_id"]: r for r in cut.collect()}
    assert shared in texts[30]["text"] and body[0][:200] not in texts[30]["text"]
    assert texts[31]["text"].strip() == "other words before" and texts[31]["n_chars"] == len(texts[31]["text"])
    assert texts[3]["text"] == body[3] and texts[3]["lang"] == "en" and texts[3]["source"] == "s1"
    assert {r["doc_id"] for r in mixed.collect()} <= set(ids[2])
    assert packed.where("piece = 0").count() == mixed.count() > 0


def test_odd_rows_and_no_rows(spark, odd_documents, tmp_path):
    odd = odd_documents.drop("part", "row", "bucket")
    start, known, single, cut, mixed, packed = _stages(spark, odd, tmp_path / "odd")
    assert known.where("text IS NULL OR trim(text) = ''").count() == 0
    assert known.where("doc_id IS NULL").count() == single.where("doc_id IS NULL").count() == 1
    assert packed.count() > 0
    for df in _stages(spark, odd.limit(0), tmp_path / "none")[1:]:
        assert df.count() == 0


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, sf_dir, name):
    import duckdb

    for view in ("documents", "embeddings"):
        duckdb.sql(f"CREATE OR REPLACE VIEW {view} AS FROM '{sf_dir}/{view}.parquet'")
    expected = duckdb.sql(ORACLE[name])
    found = QUERIES[name](spark, sf_dir)
    assert found.columns == expected.columns
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, expected.fetchall()))


def test_one_row_of_each_group_of_near_copies_stays(spark, documents):
    """Rows without an id, rows repeated whole, and one id with two texts."""
    from siftlayer.llm.simhash import _bit_sums, fingerprint

    texts = [" ".join(f"w{i}x{j}" for j in range(60)) for i in range(5)]
    rows = [(7, texts[0], "en", "s"), (3, texts[0] + " end", "en", "s"), (7, texts[1], "en", "s")]
    rows += [(None, texts[2], "en", "s")] * 20 + [(None, texts[0], "en", "s"), (None, None, None, None)]
    rows += [(9, texts[3], "en", "s")] * 20 + [(9, texts[4], "en", "t"), (10, "", "en", "s")]
    docs = documents(rows).repartition(4)
    prints = {text: fingerprint(text or "", 4, _bit_sums()) % 2**64 for _, text, *_ in rows}
    groups = {}
    for doc_id, text, *_ in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        near = [t for t in groups if (prints[t] ^ prints[text]).bit_count() <= 4]
        groups.setdefault(near[0] if near else text, doc_id)
    kept = corpus_pipeline.near_duplicate(spark, docs, "").collect()
    assert sorted((str(r["doc_id"]) for r in kept)) == sorted(map(str, groups.values()))
    assert docs.columns == corpus_pipeline.near_duplicate(spark, docs, "").columns


def test_language_keeps_texts_where_nothing_is_labelled(spark, documents):
    docs = documents([(1, "some words", None, "s"), (2, "123", None, "s"), (3, None, None, "s"), (4, "più parole", None, "s")])
    docs = docs.drop("row", "bucket", "part")
    assert sorted(r["doc_id"] for r in corpus_pipeline.language(spark, docs, "").collect()) == [1, 4]
