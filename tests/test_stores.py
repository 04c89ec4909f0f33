"""Layouts, continued tables, database chunks, archives by member, models in workers, line diffs, large samples, counts."""

import difflib
import io
import os
import random
import tarfile
import zipfile
from collections import Counter

import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from annoframe.operators import annotate, collection, entities, layers, records, sample
from annoframe.plans import store_queries
from annoframe.sources import database, markup, store

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def ndiff_ratio(a, b):
    kinds = Counter(x[0] for x in difflib.ndiff(a.splitlines(keepends=True), b.splitlines(keepends=True)))
    return round(kinds[" "] / (kinds[" "] + kinds["-"] + kinds["+"]), 2)


def test_line_diff_keeps_the_order_of_lines():
    a = "one\ntwo\nthree\nfour\n"
    assert collection.lines_in_order(a, "two\nthree\nfour\none\n") == (3, 5)
    assert collection.lines_in_order(a, "one\ntwo\nthree\nfour") == (3, 5)
    rng = random.Random(1)
    for _ in range(150):
        x = [f"line {rng.randrange(12)}" for _ in range(rng.randint(1, 40))]
        y = list(x)
        for _ in range(rng.randint(0, 8)):
            y.insert(rng.randrange(len(y) + 1), y.pop(rng.randrange(len(y)))) if rng.random() < 0.5 else y.insert(rng.randrange(len(y) + 1), rng.choice(["new", "", "line 3"]))
        equal, total = collection.lines_in_order("\n".join(x), "\n".join(y))
        assert round(equal / total, 2) == ndiff_ratio("\n".join(x), "\n".join(y))


def test_near_copies_by_line(spark):
    body = [f"line {k}" for k in range(20)]
    texts = ["\n".join(body), "\n".join(body[:1] + body[11:] + body[1:11]), "\n".join(body[:19]), "line 0\nno", "line 0 other", "\n".join(body), None, "", ""]
    rows = [(k, t, "f" if k != 5 else None, "title" if k != 2 else "another") for k, t in enumerate(texts)]
    t = spark.createDataFrame(rows, "text_id long, text string, source string, title string")
    got = {r.text_id: (r.first_id, r.ratio, r["class"]) for r in collection.near_copies_in_order(t).collect()}
    assert got[1] == (0, ndiff_ratio(texts[0], texts[1]), "far") and got[2] == (0, ndiff_ratio(texts[0], texts[2]), "near") and got[8] == (7, 1.0, "exact")
    assert 4 not in got and 5 not in got  # no line of it is the first one's; another file
    assert 2 not in {r.text_id for r in collection.near_copies_in_order(t, "title").collect()} | {r.text_id for r in collection.near_copies(t, "title").collect()}
    assert {r.text_id: r.ratio for r in collection.near_copies(t).collect()}[1] == 1.0  # wherever lines stand


def test_near_copies_query(spark):
    rows = {r.doc_id: r for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect() if r.text is not None}
    first, want = {}, set()
    for k, r in sorted(rows.items()):
        own = first.setdefault((r.source, r.text[:10]), k)
        if own != k and (ratio := ndiff_ratio(rows[own].text, r.text)) >= 0.1:
            want.add((k, own, ratio, "exact" if ratio == 1 else "far" if ratio < 0.7 else "near"))
    assert {tuple(r) for r in store_queries.near_copies_by_line(spark, FOLDER).collect()} == want and want


def test_layout_is_pruned(spark, tmp_path):
    rows = spark.range(900).select("id", (F.col("id") % 3).cast("string").alias("file"), F.lit("t").alias("text"))
    store.write_layout(rows, f"file://{tmp_path}/x", "file", F.expr("id div 100"))
    found = store.read_layout(spark, f"file://{tmp_path}/x", ["1"], [4])
    assert found.count() == 34 and "PartitionFilters: [" in plan(found) and "doc_group" in plan(found).split("PartitionFilters")[1].split("]")[0]
    assert len({os.path.dirname(f) for f in found.inputFiles()}) == 1 or "isnotnull(doc_group" in plan(found)
    assert store.read_layout(spark, f"file://{tmp_path}/x").count() == 900


def test_a_table_is_continued(spark, tmp_path):
    table = store.StoredTable(spark, f"file://{tmp_path}/t", ["key"])
    rows = lambda *k: spark.createDataFrame([(f"f{x % 2}", x, f"text {x}") for x in k], "file string, key long, text string")
    with pytest.raises(ValueError, match="no table"):
        table.rows()
    table.append(rows(1, 2), 1)
    table.append(rows(2, 3, 4), 2)
    before = sorted(map(tuple, table.rows().select("file", "key", "text").collect()))
    assert [r[1] for r in before] == [2, 4, 1, 3]
    table.append(rows(2, 3, 4), 2)  # given again
    assert sorted(map(tuple, table.rows().select("file", "key", "text").collect())) == before
    parts = sorted(p for p in os.listdir(tmp_path / "t") if p.startswith("file="))
    os.rename(tmp_path / "t" / parts[0] / "batch=2", tmp_path / "gone")  # broken off after one file
    table.append(rows(2, 3, 4), 2)
    assert sorted(map(tuple, table.rows().select("file", "key", "text").collect())) == before
    with pytest.raises(Exception, match="key occurs twice"):
        table.append(rows(7, 7), 3)
    assert sorted(map(tuple, table.rows().select("file", "key", "text").collect())) == before


def test_layers_are_added_once(spark, tmp_path):
    folder, x = f"file://{tmp_path}/c", spark.range(3)
    assert store.add_stored_layers(spark, folder, {"a": x}, ["a"]) == ["a"]
    with pytest.raises(ValueError, match="exist"):
        store.add_stored_layers(spark, folder, {"a": x}, ["a"])
    with pytest.raises(ValueError, match="not given"):
        store.add_stored_layers(spark, folder, {"a": x}, ["b"], update=True)
    os.makedirs(tmp_path / "c/b/_temporary")  # a write that was broken off
    assert store.add_stored_layers(spark, folder, {"a": x.where("false"), "b": x}, ["a", "b"], update=True) == ["b"]
    assert spark.read.parquet(f"{folder}/a").count() == 3


def test_database_chunks(spark):
    options = {"url": "jdbc:derby:memory:chunks;create=true", "driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    rows = spark.range(100).select("id", (F.col("id") % 4).cast("string").alias("part"), F.concat(F.lit("t"), "id").alias("text"))
    rows.write.format("jdbc").options(**options).option("dbtable", "texts").option("createTableColumnTypes", "part VARCHAR(9)").save()
    found = database.table_chunk(spark, options, "texts", chunk=("part", "1"), rows=10).select("id", "text")
    assert sorted(r.id for r in found.collect()) == list(range(1, 100, 4)) and found.rdd.getNumPartitions() == 10
    assert "EqualTo(part,1)" in plan(found)
    rows.limit(1).write.format("jdbc").options(**options).option("dbtable", "texts").mode("append").save()
    with pytest.raises(ValueError, match="different id"):
        database.table_chunk(spark, options, "texts")
    rows.where("false").write.format("jdbc").options(**options).option("dbtable", "nothing_yet").save()
    assert database.table_chunk(spark, options, "nothing_yet").count() == 0


def archives():
    texts = {f"d/m{k}.xml": f"<body>{k} õäö {'x' * (k * 997 % 5000)}</body>" for k in range(60)} | {"d/other.txt": "no"}
    out = {}
    for kind in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED, zipfile.ZIP_BZIP2):
        raw = io.BytesIO()
        with zipfile.ZipFile(raw, "w", kind) as z:
            for name, text in texts.items():
                z.writestr(name, text)
        out[f"a{kind}.zip"] = raw.getvalue()
    for mode in ("w", "w:gz"):
        raw = io.BytesIO()
        with tarfile.open(fileobj=raw, mode=mode) as t:
            for name, text in texts.items():
                info = tarfile.TarInfo(name)
                info.size = len(text.encode())
                t.addfile(info, io.BytesIO(text.encode()))
        out["b.tar" if mode == "w" else "b.tar.gz"] = raw.getvalue()
    return texts, out


def test_archives_by_member(spark, monkeypatch):
    texts, files = archives()
    monkeypatch.setattr(markup, "SHARE", 2000)
    frame = spark.createDataFrame([(n, bytearray(b)) for n, b in files.items()], "path string, content binary")
    want = {(a, m, t) for a in files for m, t in texts.items() if m.endswith(".xml")}
    assert {tuple(r) for r in markup.members_of(frame).collect()} == want
    one = markup.members_of(frame.where("path = 'a8.zip'"), focus=["m7.xml", "m8.xml"])
    assert {r.member for r in one.collect()} == {"d/m7.xml", "d/m8.xml"}
    spread = markup.members_of(frame.where("path = 'a0.zip'")).select(F.spark_partition_id().alias("p")).distinct()
    assert spread.count() > 1  # one archive, several tasks
    raw = bytearray(files["a0.zip"])
    raw[raw.index(b"<body>7 ")] = 65
    with pytest.raises(PythonException, match="damaged"):
        markup.members_of(spark.createDataFrame([("x.zip", raw)], "path string, content binary")).collect()


def test_models_are_made_once_a_worker(spark, tmp_path):
    def make():
        with open(tmp_path / f"{os.getpid()}-{random.random()}", "w"):
            pass
        return lambda text: [(0, 1, f"{os.getpid()}")]

    t = spark.range(0, 400, 1, 40).select(F.col("id").alias("text_id"), F.lit("x").alias("text"))
    for _ in range(2):
        spans = annotate.annotate(t, make, model="counted").select(F.explode("spans").alias("s")).select("s.label")
        workers = {r.label for r in spans.distinct().collect()}
    made = [n.split("-")[0] for n in os.listdir(tmp_path)]
    assert set(made) >= workers and len(made) == len(set(made)) and len(made) < 40


def test_large_samples_need_no_order(spark, monkeypatch):
    rows = spark.range(3000).select("id", (F.col("id") % 7).alias("other"))
    for k in (1, 60, 500, 1500, 2999, 3000, 9000):
        monkeypatch.setattr(sample, "FEW", 10_000)
        want = sorted(r.id for r in sample.pick(rows, k, 3, "id").collect())
        monkeypatch.setattr(sample, "FEW", 50)
        got = sample.pick(rows, k, 3, "id")
        assert sorted(r.id for r in got.collect()) == want and len(want) == min(k, 3000)
    half = sample.pick(rows, 1500, 3, "id")
    assert all(int(n) <= 50 for n in __import__("re").findall(r"TakeOrderedAndProject\(limit=(\d+)", plan(half)))
    assert sample.pick(rows.select(F.lit(1).alias("id"), "other"), 100, 3, "id").count() == 100  # all tie


def test_counts_beside_the_write(spark, tmp_path):
    rows = spark.createDataFrame([(1, [1, 2]), (2, []), (3, None), (4, [5])], "text_id long, spans array<int>")
    assert layers.written_sparse(rows, f"file://{tmp_path}/s") == {"texts": 4, "skipped": 2, "spans": 3}
    assert sorted(r.text_id for r in spark.read.parquet(f"file://{tmp_path}/s").collect()) == [1, 4]
    assert layers.written_sparse(rows.where("false"), f"file://{tmp_path}/e") == {"texts": 0, "skipped": 0, "spans": 0}


def test_too_many_rules_are_an_error(spark, monkeypatch):
    layer = spark.createDataFrame([(1, 0, 3, "x")], "text_id long, start long, end long, label string")
    kind = "facts_layer string, fact_attr string, value_attr string, fact_name string, value string, fact_type string"
    mapping = spark.createDataFrame([("l", "label", None, None, f"v{k}", "t") for k in range(5)], kind)
    assert len(records.facts(layer, "l", mapping).first().facts) == 5
    assert records.facts(layer, "none", mapping).count() == 0
    monkeypatch.setattr(records, "MAPPED", 4)
    with pytest.raises(ValueError, match="more than 4"):
        records.facts(layer, "l", mapping)


def test_an_entity_without_tokens_is_an_error(spark):
    span = "text_id long, start long, end long, label string"
    found, tokens = spark.createDataFrame([(1, 0, 3, "e"), (1, 9, 12, "e")], span), spark.createDataFrame([(1, 0, 2, "t"), (1, 2, 3, "t")], span)
    assert entities.grouped(found.where("start = 0"), tokens).first().n_tokens == 2
    with pytest.raises(Exception, match="no tokens in entity"):
        entities.grouped(found, tokens).collect()


def test_tasks_are_written_and_read(spark, tmp_path):
    a = spark.createDataFrame([(k, 0, 3, "x") for k in range(5)], "text_id long, start long, end long, label string")
    tasks = records.tasks(a, a.where("text_id > 2"))
    records.write_tasks(tasks, f"file://{tmp_path}/t", a_file=2)
    assert sorted(map(str, records.read_tasks(spark, f"file://{tmp_path}/t").collect())) == sorted(map(str, tasks.select("text_id", "spans").collect()))
    assert max(sum(1 for _ in open(tmp_path / "t" / f)) for f in os.listdir(tmp_path / "t") if f.endswith(".json")) <= 2
