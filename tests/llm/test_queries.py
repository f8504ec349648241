"""Registered operator queries: DuckDB where SQL can express them, stable schemas, the pipeline against its parts."""

import inspect

import corpus_pipeline
import pytest
from cases import SF01, edge_documents

import __spark_entry__ as entry
from shoplens.llm import decontam, minhash, packing, queries, secrets
from shoplens.plans.compare import compare, duckdb_connection


def test_all_operators_and_the_pipeline_are_registered():
    names = list(entry.queries())
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13 and "pipeline" in names


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_query_matches_oracle(spark, name):
    rep = compare(queries.queries()[name](spark, SF01), duckdb_connection(SF01), queries.oracle_sql()[name])
    assert rep["values_match"] and rep["types_match"], rep


def test_pipeline_equals_its_parts(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    d = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        d = stage(spark, d, SF01)
        assert d.columns == docs.columns
    kept = {r.doc_id: r.text for r in d.collect()}
    near = {r.doc_id for r in minhash.near_duplicates(docs, minhash.GENERAL).where("kept").collect()}
    bad = {r.doc_id for r in decontam.contamination(docs, spark.read.parquet(f"{SF01}/benchmark.parquet")).where("contaminated").collect()}
    assert set(kept) == near - bad                      # every text of this table has a language
    assert kept == {r.doc_id: secrets.redact_text(r.text) for r in docs.collect() if r.doc_id in kept}
    rows = corpus_pipeline.run(spark, SF01).collect()
    assert {r.doc_id for r in rows} == set(kept)
    total = sum(r.length for r in rows)
    assert len({r.sequence_id for r in rows}) <= 1.02 * (-(-total // packing.SEQUENCE))


def test_stages_survive_edge_rows(spark):
    """Nulls, empty and very long texts, repeated rows and columns named like the operators' own."""
    docs = edge_documents(spark)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        assert name == "language_id" or docs.columns == columns
        assert len(inspect.signature(stage).parameters) == 3
        docs = stage(spark, docs, SF01)
    assert docs.count() > 0


def test_pipeline_of_empty_tables(spark, tmp_path):
    for table in ("documents", "benchmark"):
        spark.read.parquet(f"{SF01}/{table}.parquet").limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.collect() == [] and out.columns[:7] == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def test_every_stage_of_an_empty_table_keeps_its_columns(spark):
    docs = edge_documents(spark).limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF01)
        assert out.columns == docs.columns and out.collect() == []
