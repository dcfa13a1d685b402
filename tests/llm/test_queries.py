"""Registered corpus queries: SQL of another engine, contracts, and the pipeline by stages."""

import zlib

import duckdb
import pytest

import corpus_pipeline
from starloom.llm.queries import LLM_QUERIES, LLM_SQL
from starloom.llm.shared import held_out, stored, table
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def other_engine():
    connection = duckdb.connect()
    for name in ("documents", "benchmark", "labels"):
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(LLM_SQL))
def test_sql(spark, other_engine, name):
    found = LLM_QUERIES[name](spark, SMALL)
    expected = other_engine.sql(LLM_SQL[name])
    assert sorted(found.columns) == sorted(expected.columns)
    order = [expected.columns.index(c) for c in found.columns]
    right = sorted((tuple(r[i] for i in order) for r in expected.fetchall()), key=repr)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == right


# op11 is of embeddings; tests/llm/test_whitening.py holds its query against plain loops
@pytest.mark.parametrize("name", sorted(set(LLM_QUERIES) - set(LLM_SQL) - {"op11_whitening"}))
def test_a_row_for_each_document(spark, other_engine, name):
    found = LLM_QUERIES[name](spark, SMALL).collect()
    ids = {r[0] for r in other_engine.sql("SELECT doc_id FROM documents").fetchall()}
    assert {r.doc_id for r in found} == ids and len(found) == len(ids)


def test_folds(spark):
    ids = [0, 1, 2, 77, 123456789012, -5]
    frame = spark.createDataFrame([(i,) for i in [*ids, None]], "doc_id long")
    found = {r.doc_id: r.h for r in frame.select("doc_id", held_out("doc_id", 5, 0).alias("h")).collect()}
    assert found == {**{i: zlib.crc32(str(i).encode()) % 5 == 0 for i in ids}, None: False}


def test_pipeline(spark):
    from starloom.llm import decontaminate, language, pii, simhash

    docs, names = table(spark, SMALL, "documents"), []
    benchmark = table(spark, SMALL, "benchmark")
    for name, stage in corpus_pipeline.STAGES:
        names.append(name)
        after = stored(stage(spark, docs, SMALL), "test-stage")
        before = {r.doc_id: r for r in docs.collect()}
        rows = after.collect()
        if name != "mixture":
            assert after.columns == docs.columns
            assert len({r.doc_id for r in rows}) == len(rows)
        if name == "language":
            kept = language.identify(docs, language.learn(docs)).where("language.lang_pred != 'und'")
            assert {r.doc_id for r in rows} == {r.doc_id for r in kept.collect()}
        if name == "near_copies":
            groups = simhash.near_copies(docs).collect()
            assert {r.doc_id for r in rows} == {r.component_id for r in groups}
        if name == "decontamination":
            bad = decontaminate.contamination(docs, benchmark).where(decontaminate.is_contaminated())
            assert {r.doc_id for r in rows} == set(before) - {r.doc_id for r in bad.collect()}
        if name == "personal_data":
            model = pii.learn(docs)
            for r in rows:
                assert r.text == pii.masked(before[r.doc_id].text, pii.all_spans(before[r.doc_id].text, model)[1])
                assert not pii.base_spans(r.text)
        if name != "personal_data":
            assert all(r.text == before[r.doc_id].text for r in rows)
        docs = after
    assert names == ["language", "near_copies", "decontamination", "personal_data", "mixture"]
