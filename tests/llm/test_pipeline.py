"""The registered queries on the driver's smallest tables, those with SQL against DuckDB; and the pipeline's stages against what they say."""

import os

import duckdb
import pytest

import corpus_pipeline
from millrace.llm import registry
from tests.test_queries import rows

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the driver's tables are not here")


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for table in os.listdir(FOLDER):
        con.execute(f"create view {table[:-8]} as select * from '{FOLDER}/{table}'")
    got, want = registry.QUERIES[name](spark, FOLDER).toPandas(), con.execute(registry.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and rows(got) == rows(want)


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in registry.QUERIES) == list(range(1, 14))


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    before = docs.count()
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        after = stage(spark, docs, FOLDER)
        if i == len(corpus_pipeline.STAGES) - 1:
            break
        assert after.columns == docs.columns
        after.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.count() == before if name == "line_dedup" else 0 < docs.count() <= before
        before = docs.count()
    pieces = after.toPandas()
    assert set(pieces.doc_id) == {r.doc_id for r in docs.select("doc_id").collect()}
    assert (pieces.groupby("doc_id").length.sum() == pieces.groupby("doc_id").doc_tokens.first()).all()
    assert len(corpus_pipeline.run(spark, FOLDER).toPandas()) == len(pieces)
