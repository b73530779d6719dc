"""Queries against their SQL, and hard or empty input through every operator and stage."""

import hashlib

import pytest
from conftest import SF, duckdb_over
from llm_cases import CLASHING, PROSE, ROWS, hard_documents, no_documents

import corpus_pipeline
from stratalake.llm import (
    bpe,
    exact_dedup,
    hilbert_shards,
    html_extract,
    language_id,
    mixing,
    near_dup,
    quality,
    secret_scan,
    warc,
)
from stratalake.llm.registry import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_gives_what_its_sql_gives(spark, name):
    got, want = QUERIES[name](spark, SF).toPandas(), duckdb_over(SF).execute(ORACLE_SQL[name]).df()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    as_rows = lambda df: sorted(map(repr, df[columns].astype(object).where(df[columns].notna(), None).itertuples(index=False, name=None)))
    assert as_rows(got) == as_rows(want)


DOCUMENT_OPERATORS = {
    "exact_dedup": lambda d: exact_dedup.find_duplicates(d, exact_dedup.new_index(d.sparkSession)),
    "language_id": lambda d: language_id.predict(d, language_id.learn(d)),
    "hilbert_shards": hilbert_shards.assign_shards,
    "near_dup": near_dup.group_near_duplicates,
    "quality": quality.judge,
    "secret_scan": secret_scan.find_secrets,
    "bpe": bpe.round_trip,
}


@pytest.mark.parametrize("name", sorted(DOCUMENT_OPERATORS))
def test_hard_documents_give_one_row_each(spark, name):
    rows = DOCUMENT_OPERATORS[name](hard_documents(spark)).collect()
    ids = sorted(repr(r["doc_id"]) for r in rows)
    assert ids == sorted(repr(r[0]) for r in ROWS)


@pytest.mark.parametrize("name", sorted(DOCUMENT_OPERATORS))
def test_no_documents_give_no_rows(spark, name):
    assert DOCUMENT_OPERATORS[name](no_documents(spark)).collect() == []


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_take_hard_documents_and_keep_their_columns(spark, name, stage):
    docs = hard_documents(spark)
    out = stage(spark, docs, None)
    kept = out.collect()
    if name != "bpe_encode":
        assert out.columns == docs.columns
        for column in CLASHING:
            assert {r[column] for r in kept} <= {f"own {column}"}
    assert stage(spark, no_documents(spark), None).collect() == []


def test_mixing_and_rates_take_hard_documents(spark):
    docs = hard_documents(spark)
    rows = mixing.mix(docs, mixing.target_rates(docs, size=3.0)).collect()
    assert {r["source"] for r in rows} == {"a", "b", "c", None}
    assert [r["order_key"] for r in rows] == sorted(r["order_key"] for r in rows)
    assert mixing.mix(no_documents(spark), mixing.target_rates(no_documents(spark))).collect() == []
    none = mixing.mix(docs, mixing.target_rates(docs, weights={"a": 1.0, "missing": 3.0}))
    assert {r["source"] for r in none.collect()} <= {"a"}


PAGES = [
    (1, "http://h.example/1", "<html><body><article><p>one</p></article></body></html>", "x"),
    (1, "http://h.example/1", "<html><body><article><p>one</p></article></body></html>", "x"),
    (None, None, None, "x"),
    (2, "not a url", "", "x"),
    (3, "http://h.example/3", "<p>" * 30_000 + "deep", "x"),
    (4, "http://h.example/4", "no tags & 1 < 2 &lt;3 &#x41; &nosuch; <", "x"),
    (5, "http://h.example/5", "<script>a<b</script><div>t<!-- c", "x"),
]


def test_pages_operators_take_hard_pages(spark, folder):
    pages = spark.createDataFrame(PAGES, "page_id bigint, url string, html string, host string").repartition(2)
    texts = html_extract.extract(pages).collect()
    by_id = {r.page_id: r for r in texts}
    assert len(texts) == len(PAGES)
    assert (by_id[1].text, by_id[None].text, by_id[2].text) == ("one", "", "")
    assert by_id[3].text == "deep"
    assert by_id[4].text == "no tags & 1 < 2 <3 A &nosuch; <"
    assert by_id[5].text == "t"
    assert all(r.n_chars == len(r.text) for r in texts)
    assert html_extract.extract(pages.where("false")).collect() == []

    warc.write_archives(pages, f"{folder}/warc")
    records = warc.page_records(warc.read_archives(spark, f"{folder}/warc")).collect()
    assert sorted(repr(r.page_id) for r in records) == sorted(repr(p[0]) for p in PAGES)
    warc.write_archives(pages.where("false"), f"{folder}/none")
    assert warc.read_archives(spark, f"{folder}/none").collect() == []


def test_last_stage_decodes_what_it_encodes(spark):
    docs = spark.createDataFrame([(1, PROSE), (2, ""), (3, None)], "doc_id bigint, text string")
    rows = {r.doc_id: r for r in corpus_pipeline.bpe_encode(spark, docs, None).collect()}
    coder = bpe.coder(bpe.default_path())
    for i, text in ((1, PROSE), (2, ""), (3, "")):
        ids = coder.encode(text)
        assert (rows[i].ids, rows[i].decoded_sha256) == (ids, hashlib.sha256(coder.decode(ids).encode()).hexdigest())
