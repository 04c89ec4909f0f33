"""Layers cut by text: what is grouped, joined or sorted inside texts moves no rows again."""

import re

import pytest
from pyspark.sql import functions as F

from annoframe.functions import pieces
from annoframe.operators import annotate as A
from annoframe.operators import diff as D
from annoframe.operators import entities as E
from annoframe.operators import layers as L
from annoframe.operators import layout
from annoframe.sources import store as S

TEXTS = [(1, "Ab. cd 12, Éf"), (2, None), (3, ""), (4, "  x\n\ny. "), (5, "𝒳y Zed! " * 300)]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(TEXTS, "text_id long, text string").withColumn("category", F.lit("c")).withColumn("file", F.lit("f"))


def moves(rows, capsys):
    """How rows are dealt anew, besides by text."""
    capsys.readouterr()
    rows.explain()
    return re.findall(r"Exchange (?!hashpartitioning\(text_id#\d+L, \d+\), REPARTITION_BY_NUM)[^\n]*", capsys.readouterr().out)


@pytest.mark.parametrize("cut", [L.words, L.sentences])
def test_same_pieces(texts, cut):
    assert sorted(cut(texts).collect()) == sorted(cut(texts, by_text=True).collect())
    assert cut(texts).schema.simpleString() == cut(texts, by_text=True).schema.simpleString()


def test_inside_texts_nothing_moves(spark, texts, capsys):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        w = L.words(texts, by_text=True)
        a, b = L.labelled(w), L.trimmed(w)
        diff, pairs = D.span_diff(a, b), D.conflicts(a, b)
        found = w.where("length(token) > 3").select("text_id", "start", (F.col("start") + 3).alias("end"), F.lit("x").alias("label"))
        rows = [diff, D.annotation_status(diff), pairs, D.records(diff, pairs), D.linked_groups(pairs, by_text=True), L.snippets(a, texts, 5), A.voted(a), E.expanded(found, E.pieces(w, 3), texts)]
        for r in rows:
            assert moves(r, capsys) == []
        assert moves(D.span_diff(L.labelled(L.words(texts)), b), capsys)  # of a layer that is not cut by text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_snippets_are_those_of_single_spans(texts):
    spans = L.words(texts).select("text_id", "start", "end", "token")
    want = spans.join(texts, "text_id").select("text_id", "start", "end", "token", L.snippet(F.col("text"), F.col("start"), F.col("end"), 5).alias("context"))
    assert sorted(L.snippets(spans, texts, 5).collect()) == sorted(want.collect())


def test_status_reads_the_diff_once(texts, capsys):
    w = L.words(texts)
    D.annotation_status(D.span_diff(L.labelled(w), L.trimmed(w))).explain()
    assert capsys.readouterr().out.count("MapInArrow") == 2  # one for each version; three times as many before


def test_groups_read_the_pairs_once(texts, capsys):
    w = L.words(texts, by_text=True)
    pairs = D.conflicts(L.labelled(w), L.trimmed(w))
    layout.printed(texts, pairs, D.conflict_groups(pairs).withColumn("global_id", F.col("grp"))).explain()
    assert capsys.readouterr().out.count("MapInArrow run_lists") == 4  # of pairs and groups; six before


def test_spans_of_few_texts_are_held(spark, monkeypatch):
    monkeypatch.setattr(A, "HELD", 10)  # shows in workers that are forked from here only; the rows are the same anyhow
    rows = spark.createDataFrame([(k, None if k == 3 else "1 22 x " * k) for k in range(30)], "text_id long, text string").coalesce(1)

    def fails():
        def one(text):
            if len(text) == 35:
                raise ValueError("five")
            return A.pattern_annotator("[0-9]+", "n")()(text)

        return one

    got = {r.text_id: r for r in A.annotate(rows, fails).collect()}
    assert sorted(got) == list(range(30))
    assert got[5].spans is None and got[5].error == "ValueError: five"
    assert all(len(got[k].spans) == (0 if k == 3 else 2 * k) for k in got if k != 5)
    assert got[2].spans[3].asDict() == {"start": 9, "end": 11, "label": "n"}


def test_parts_are_enough_for_joins(spark, texts):
    assert pieces.parts_for(texts) >= int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_small_groups_are_one_file(spark, tmp_path):
    rows = spark.range(2000).selectExpr("id AS text_id", "concat('t', id) AS text", "concat('s', id % 3) AS source")
    S.write_layout(rows, f"file://{tmp_path}/x", "source", F.expr("text_id div 100"))
    n = len(list((tmp_path / "x").rglob("*.parquet")))
    assert 60 <= n <= 60 + 4  # by up to eight tasks each before
    found = S.read_layout(spark, f"file://{tmp_path}/x", ["s1", "s2"], [0, 3, 77], "source")
    assert sorted(r.text_id for r in found.collect()) == [k for k in [*range(100), *range(300, 400)] if k % 3]
    assert len(found.inputFiles()) <= 4 + 4  # only the folders asked for are listed
    assert S.read_layout(spark, f"file://{tmp_path}/x", ["none"], None, "source").count() == 0
    assert S.read_layout(spark, f"file://{tmp_path}/x", file="source").count() == 2000
