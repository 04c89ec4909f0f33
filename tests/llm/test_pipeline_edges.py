"""The pipeline on null, empty, repeated and odd tables, and each stage's decisions against the other tests' brute force."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from annoframe.llm import digest_index, mixing, quality, similar
from tests.llm.test_mixing_and_index import groups, norm
from tests.llm.test_similar import brute


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(k, 1, 0) for k in range(60)] + [(k, 0, 1) for k in range(230, 236)] + [(None, 1, None)], "doc_id long, quality int, toxic int")


def folder(tmp_path, docs, labels):
    docs.write.parquet(f"file://{tmp_path}/documents.parquet")
    labels.write.parquet(f"file://{tmp_path}/labels.parquet")
    return f"file://{tmp_path}"


def test_awkward_table(spark, docs, labels, tmp_path):
    d = folder(tmp_path, docs, labels)
    pieces = corpus_pipeline.run(spark, d).collect()
    kept = quality.keep_good(docs, labels)
    good = [(r.doc_id, r.text) for r in kept.collect()]
    keep, _ = groups(good)
    exact = digest_index.keep_one(kept)
    assert Counter((norm(r.text), -1 if r.doc_id is None else r.doc_id) for r in exact.collect()) == Counter(keep.items())
    left = [(r.doc_id, r.text) for r in exact.collect()]
    root = brute(left)
    near = similar.keep_one(exact)
    assert near.columns == docs.columns and near.count() == len(set(root))
    mixed = Counter({r.doc_id: r["count"] for r in mixing.mix(near).groupBy("doc_id").count().collect()})
    starts = Counter(p.doc_id for p in pieces if p.start == 0)
    assert starts == mixed
    assert max(p.offset + p.length for p in pieces) <= 4096


@pytest.mark.parametrize("rows", [[], [(None, None, None, None)], [(1, "", "en", "s")], [(1, None, None, None)] * 3, [(k, "the same text of some words here", "en", "s") for k in range(20)]])
def test_small_tables(spark, labels, tmp_path, rows):
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, `odd name` string")
    out = corpus_pipeline.run(spark, folder(tmp_path, docs, labels)).collect()
    assert len({(p.sequence_id, p.offset) for p in out}) == len(out)
    assert len({p.doc_id for p in out}) <= 1


def test_tables_of_stages_are_removed(spark, docs, labels, tmp_path):
    import os

    shared = spark.conf.get("spark.checkpoint.dir").removeprefix("file://")
    before = set(os.listdir(shared))  # other tests store tables under these names
    corpus_pipeline.run(spark, folder(tmp_path, docs.where(F.col("doc_id") < 30), labels)).count()
    names = [n.rpartition("-")[0] for n in set(os.listdir(shared)) - before]
    assert not {name for name, _ in corpus_pipeline.STAGES[:-1]} & set(names)
