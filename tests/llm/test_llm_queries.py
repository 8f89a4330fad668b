"""Queries with SQL against DuckDB, the shape of the others, and the pipeline."""
import os
from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from mercaflow.llm.queries import oracle_sql, queries
from tests.llm.helpers import documents

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="supplied tables not present")


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, name):
    database = duckdb.connect()
    for table in ("documents", "conversations", "embeddings"):
        database.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    df, expected = queries()[name](spark, SF_DIR), database.sql(oracle_sql()[name])
    columns = sorted(df.columns)
    assert columns == sorted(expected.columns)
    rows = expected.select(*columns).fetchall()
    assert rows and Counter(tuple(r) for r in df.select(*columns).collect()) == Counter(rows)


def test_one_query_for_each_operator():
    assert sorted(int(q.split("_")[0][2:]) for q in queries()) == list(range(1, 14))


def test_pipeline_stages_keep_columns_and_decide(spark, tmp_path):
    docs = documents(spark)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    text = docs.filter("doc_id = 5").first().text
    spark.createDataFrame([(1, text)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    at, kept = docs, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        at = stage(spark, at, str(tmp_path))
        at.write.parquet(f"{tmp_path}/{name}")
        at = spark.read.parquet(f"{tmp_path}/{name}")
        assert at.columns == docs.columns
        kept[name] = {r.doc_id for r in at.collect()}
    everything = {r.doc_id for r in docs.collect()}
    wordless = {r.doc_id for r in docs.filter("text is null or not text rlike '[a-zA-ZÄ-ü]'").collect()}
    assert kept["language"] == everything - wordless
    assert 5 not in kept["decontaminate"] and 3 in kept["decontaminate"]
    # The second of two long copies has no line left.
    assert 63 in kept["line_dedup"] and 64 not in kept["line_dedup"]
    mixed = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id for r in mixed.collect()} <= kept["decontaminate"]
