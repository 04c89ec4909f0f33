"""Queries that move little: what is dealt anew and what is stored, and the forms that it is kept in, against plainer ones."""

import os
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from annoframe import registry
from annoframe.functions import pieces
from annoframe.operators import collection as C
from annoframe.operators import diff as D
from annoframe.operators import entities as E
from annoframe.operators import layers as L
from annoframe.operators import records as R
from annoframe.sources import markup as M
from annoframe.sources import store as S

FOLDER = "/root/testdata/sf0.001"


def moves(rows, capsys):
    capsys.readouterr()
    rows.explain()
    return re.findall(r"(?<!Broadcast)Exchange (?!SinglePartition)[^\n]*", capsys.readouterr().out)


def stored(spark, name):
    root = spark.conf.get("spark.checkpoint.dir").removeprefix("file://")
    newest = max((d for d in os.listdir(root) if d.startswith(name + "-")), key=lambda d: os.path.getmtime(f"{root}/{d}"))
    return [f for _, _, files in os.walk(f"{root}/{newest}") for f in files if f.startswith("part-")]


def test_vert_documents_move_no_rows(spark, capsys):
    assert moves(registry.QUERIES["vert_documents"](spark, FOLDER), capsys) == []
    assert all(f.endswith(".gz") for f in stored(spark, "vert"))


def test_lists_are_those_of_tokens(spark, tmp_path):
    text = '<doc id="1">\n<p>\n<s>\r\na\tb\tc\n<g/>\n <x>\ty\tz\nplain\n<s id="2">  \nd\te\tf\n</s>\ng\th\ti\n<doc id="2">\n</doc>\n<doc id="3">\n<s>\n</s>\n<s>\n<s>\tq\tr\n' + "k\tl\tm\n" * 1200
    (tmp_path / "a.vert").write_bytes(text.encode())
    found = M.blocks(spark, str(tmp_path), "doc")
    want = {}
    for r in M.tokens(found, ["doc_nr"]).orderBy("doc_nr", "pos").collect():
        want.setdefault(r.doc_nr, []).append((r.sent, r.token, r.line))
    got = {r.doc_nr: [(s.sent, t) for s in r.sentences for t in s.tokens] for r in M.sentence_lists(found, ["doc_nr"]).collect()}
    assert got == {k: [x[:2] for x in want.get(k, [])] for k in range(3)}
    lists = M.feature_columns(found, ["doc_nr"], 3).select("doc_nr", M.feature_lists(F.col("runs"), 3).alias("f"))
    assert {r.doc_nr: ["\t".join(x) for x in r.f] for r in lists.collect()} == {k: [x[2] for x in want.get(k, [])] for k in range(3)}
    with pytest.raises(Exception, match="without 2 features"):
        M.feature_columns(found, ["doc_nr"], 2).collect()


def test_places_are_kept_in_two_parts(spark):
    rows = spark.createDataFrame([(1, "ab " * 30_000 + "z"), (2, "\U0001d54fy  q")], "text_id long, text string")
    got = L.words(rows, by_text=True)
    assert sorted(got.collect()) == sorted(L.words(rows).collect())
    assert pieces.cut_lists(rows, pieces.words).schema["low"].dataType.simpleString() == "array<tinyint>"


def test_known_sentences_move_fingerprints(spark, capsys):
    found = moves(registry.QUERIES["known_sentences"](spark, FOLDER), capsys)
    assert len(found) == 2 and all("hashpartitioning(text_id" in x and "REPARTITION_BY_NUM" in x for x in found)  # one for each side


def test_syntax_lines_move_texts_once(spark, capsys):
    found = moves(registry.QUERIES["syntax_token_lines"](spark, FOLDER), capsys)
    assert len(found) == 2 and all("hashpartitioning(text_id" in x and "REPARTITION_BY_NUM" in x for x in found)  # one for each side


@pytest.mark.parametrize("name", ["printed_differences", "stacked_differences"])
def test_printing_moves_texts_and_counts(spark, capsys, name):
    rows = registry.QUERIES[name](spark, FOLDER)
    assert not [x for x in moves(rows, capsys) if re.search(r"\b(start|end|low|bucket|place)#", x)]
    rows.explain()
    assert "MapInArrow run_lists" not in capsys.readouterr().out  # words are not dealt


def test_conflicts_of_one_text_are_those_of_the_join(spark):
    draw = random.Random(5)
    sides = [[(k, a, a + draw.randint(0, 6), draw.choice("xy")) for k in range(20) for a in draw.sample(range(60), 12)] for _ in "ab"]
    a, b = (spark.createDataFrame(v, "text_id long, start long, end long, label string") for v in sides)
    pairs = D.conflicts(a, b)
    want, groups = {}, {}
    for r in pairs.collect():
        want.setdefault(r.text_id, []).append(((r.a_start, r.a_end, r.a_label), (r.b_start, r.b_end, r.b_label)))
    for r in D.conflict_groups(pairs).orderBy("text_id", "start").collect():
        groups.setdefault(r.text_id, []).append((r.start, r.end))
    for k in range(20):
        x, y = ([s[1:] for s in sorted(v) if s[0] == k] for v in sides)
        got = D.conflicts_in(x, y)
        assert sorted(got) == sorted(want.get(k, [])) and D.groups_in(got) == groups.get(k, [])
        start, end, other_start, other_end = (np.array([s[i] for s in v]) for v, i in ((x, 0), (x, 1), ([s for s in y if s[0] < s[1]], 0), ([s for s in y if s[0] < s[1]], 1)))
        assert [s for s, hit in zip(x, D.in_conflict(start, end, other_start, other_end)) if hit] == sorted({p[0] for p in got}, key=x.index)


def test_first_ids_are_those_of_all_rows(spark):
    rows = spark.createDataFrame([(k, f"s{k % 3}", n) for k in range(50) for n in range(k % 4)], "text_id long, file string, n long")
    whole = C.global_ids(rows.withColumn("block", F.expr("text_id div 7")).withColumn("place", F.struct("text_id", "n")), "file", "place", "block")
    want = {(r.text_id, r.n): r.global_id for r in whole.collect()}
    first = C.first_ids(rows.groupBy("text_id", "file").agg(F.count("*").alias("n")), "file", "text_id", F.expr("text_id div 7"))
    assert {(r.text_id, j): r.first_id + j for r in first.collect() for j in range(r.n)} == want


def test_tasks_are_written_packed_and_move_no_rows(spark, tmp_path, capsys):
    texts = spark.read.parquet(f"{FOLDER}/documents.parquet").selectExpr("doc_id AS text_id", "text")
    lists = R.listed_tasks(L.two_versions(texts))
    assert moves(lists, capsys) == []
    w = L.words(texts)
    assert sorted(map(str, lists.collect())) == sorted(map(str, R.tasks(L.labelled(w), L.trimmed(w)).collect()))
    R.write_tasks(lists, f"file://{tmp_path}/t", packed=True)
    assert all(f.endswith(".json.gz") for f in os.listdir(tmp_path / "t") if f.startswith("part-"))
    assert R.read_tasks(spark, f"file://{tmp_path}/t").count() == lists.count()


def test_entities_meet_texts_as_lists(spark, capsys):
    rows = registry.QUERIES["entities_without_infixes"](spark, FOLDER)
    rows.explain()
    assert not re.search(r"\b(Window|posexplode\(regexp)", capsys.readouterr().out)  # runs of characters are no rows


def test_entities_of_odd_texts(spark):
    span = "text_id long, start long, end long, label string"
    texts = spark.createDataFrame([(1, "x Abcde Fg\u0085HijⅠk"), (2, None)], "text_id long, text string")
    found = spark.createDataFrame([(1, 2, 5, "e"), (1, 2, 5, "f"), (1, 8, 9, "e"), (2, 0, 3, "e"), (3, 0, 3, "e")], span)
    tokens = spark.createDataFrame([(1, 2, 5, "t"), (1, 5, 7, "t"), (1, 8, 10, "t"), (2, 0, 3, "t")], span)
    got = sorted(tuple(r) for r in E.expanded(found, tokens, texts).collect())
    assert got == [(1, 2, 7, "e", True), (1, 2, 7, "f", True), (1, 8, 9, "e", False), (2, 0, 3, "e", False), (3, 0, 3, "e", False)]
    left = sorted(tuple(r) for r in E.without_infixes(E.expanded(found, tokens, texts).drop("grown"), texts).collect())
    assert left == [(1, 2, 7, "e"), (1, 2, 7, "f"), (2, 0, 3, "e"), (3, 0, 3, "e")]


def test_document_folders_are_listed_by_group(spark, tmp_path):
    rows = spark.range(240).selectExpr("id AS text_id", "concat('t', id) AS text", "concat('s', id % 2) AS source")
    S.write_documents(rows, f"file://{tmp_path}/x", "source", F.expr("text_id div 120"), "text_id")
    sc, at = spark.sparkContext, f"file://{tmp_path}/x"
    sc.setJobGroup("listing", "")
    found = M.json_documents(spark, at, "text string", "*.json")
    stages = [sc.statusTracker().getStageInfo(s) for j in sc.statusTracker().getJobIdsForGroup("listing") for s in sc.statusTracker().getJobInfo(j).stageIds]
    sc.setJobGroup("", "")
    assert sum(s.numTasks for s in stages) <= 4  # as many as groups; before a task for each document
    assert {r.path_id: r.text for r in found.collect()} == {k: f"t{k}" for k in range(240)}
    alone = M.json_documents(spark, f"{at}/source=s0/doc_group=0/text_id=4", "text string", "*.json")
    assert [(r.path_id, r.text) for r in alone.collect()] == [(4, "t4")]


def test_a_layout_of_many_small_files_is_written_by_many_tasks(spark, tmp_path):
    rows = spark.range(2000).selectExpr("id AS text_id", "concat('t', id) AS text", "concat('s', id % 3) AS source")
    S.write_layout(rows, f"file://{tmp_path}/x", "source", F.expr("text_id div 100"))
    assert len({f.name.split("-")[1] for f in (tmp_path / "x").rglob("part-*.parquet")}) >= 3  # one before
