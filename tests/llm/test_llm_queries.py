"""The registered training-data queries that have SQL, and the pipeline's decisions."""

import duckdb
import pytest

import corpus_pipeline
from annoframe.llm import queries
from annoframe.llm.common import documents, stored

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_matches_sql(spark, name):
    c = duckdb.connect()
    for table in ("documents", "embeddings", "conversations"):
        c.sql(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    want = c.sql(queries.ORACLES[name]).df()
    got = queries.QUERIES[name](spark, FOLDER).toPandas()[list(want.columns)]
    plain = lambda f: sorted(tuple(f"{v:.6g}" if isinstance(v, float) else str(v) for v in r) for r in f.itertuples(index=False))
    assert plain(got) == plain(want)


def test_pipeline(spark):
    docs = documents(spark, FOLDER)
    columns, before = docs.columns, docs.count()
    counts = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, FOLDER), name)
        assert docs.columns == columns
        counts.append(docs.count())
    assert before > counts[0] >= counts[1] >= counts[2] > 0 and counts[3] > 0
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert pieces.groupBy("sequence_id").sum("length").where("`sum(length)` > 4096").count() == 0
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.select("doc_id").distinct().collect()}
