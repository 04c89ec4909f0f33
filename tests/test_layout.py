"""Token places, routing, guards, statuses and printed differences against plain Python."""

import pytest
from pyspark.sql import functions as F

from annoframe.operators import annotate, collection, diff, layers, layout, sample
from annoframe.sources import store


def texts(spark, *values):
    return spark.createDataFrame([(k, v, "en", "s") for k, v in enumerate(values)], "text_id long, text string, lang string, source string")


def test_token_places(spark):
    values = ["Tere,  maailm!\nÕige 👍 nii.", None, "", "ab"]
    tokens = [(0, k, x) for k, x in enumerate(["Tere", ",", "maailm", "!", "Õi", "ge", "👍", "nii", "."])]
    frame = spark.createDataFrame(tokens + [(3, 0, "a"), (3, 1, "x")], "text_id long, id long, token string")
    got = {(r.text_id, r.id): r for r in layers.token_places(texts(spark, *values), frame).collect()}
    assert len(got) == 11 and all(got[0, k].ok and values[0][got[0, k].start : got[0, k].end] == x for _, k, x in tokens)
    assert got[3, 0].ok and not got[3, 1].ok
    with pytest.raises(Exception, match="not in its place"):
        layers.checked_places(layers.token_places(texts(spark, *values), frame)).collect()


def test_routes(spark):
    n = spark.createDataFrame([(1, 1, 5), (1, 2, 40), (2, 1, 15)], "text_id long, sent_id long, n long")
    rows = lambda s: {(r.text_id, r.sent_id): (r.route, r.n_chunks) for r in layers.routed(n, 15, s).collect()}
    assert rows("NONE") == {(1, 1): ("gpu", 1), (1, 2): ("gpu", 1), (2, 1): ("gpu", 1)}
    assert rows("CHUNKING")[1, 2] == ("gpu", 3) and rows("CHUNKING")[2, 1] == ("gpu", 1)
    assert rows("USE_CPU") == {(1, 1): ("cpu", 1), (1, 2): ("cpu", 1), (2, 1): ("gpu", 1)}
    with pytest.raises(ValueError):
        layers.routed(n, 15, "other")


def test_guard(spark):
    layer = layers.labelled(layers.words(texts(spark, "One two", "x")))
    sizes = {r.text_id: r.json_size for r in layers.guarded(layer).collect()}
    assert sizes == {r.text_id: r.n for r in layers.nested(layer).select("text_id", F.length(F.to_json("spans")).alias("n")).collect()}
    with pytest.raises(Exception, match="layer too large in text 0"):
        layers.guarded(layer, 40).collect()


def test_status(spark):
    def make():
        def one(text):
            if text == "bad":
                raise ValueError("no")
            return [(0, len(text), "all")], {"length": str(len(text))}

        return one

    got = {r.text_id: r for r in annotate.annotate_with_status(texts(spark, "good", "bad", None), make).collect()}
    assert got[0].status == {"length": "4"} and got[1].status == {"error": "ValueError: no"} and got[1].spans is None
    assert got[2].spans[0].end == 0


def test_numbers_and_samples(spark):
    rows = spark.createDataFrame([(f, k, k // 10) for f in "ab" for k in range(40)], "file string, k long, block long")
    plain, blocks = (sorted(map(tuple, collection.global_ids(rows, "file", "k", b).select("file", "k", "global_id").collect())) for b in (None, "block"))
    assert plain == blocks and [r[2] for r in plain] == list(range(80))
    ids = spark.createDataFrame([("a", "1", 3), ("a", "x2", 4), ("b", "3", 5), ("c", "4", 6), (None, "5", 1)], "file string, id string, size long")
    picked = sample.pick_even_numeric(ids, "file", 4, 1, "id", ["c"])
    assert {r.id for r in picked.collect()} <= {"1", "3", "5"} and sample.total(picked.where("false"), "size").first().total == 0


def test_printed(spark):
    text = "one two.\nthree"
    pairs = spark.createDataFrame([(1, 4, 8, "x", 4, 7, "y")], "text_id long, a_start long, a_end long, a_label string, b_start long, b_end long, b_label string")
    groups = diff.conflict_groups(pairs).withColumn("global_id", F.lit(5).cast("long"))
    named = spark.createDataFrame([(1, "cat", "file", text)], "text_id long, category string, file string, text string")
    block = layout.printed(named, pairs, groups, ("first", "b")).first().block
    assert block == "=" * 85 + "\n\n  cat::file::5\n\n first   ...one {two.} /x\\nthree...\n b       ...one {two} /y.\\nthree...\n\n"
    block = layout.printed(named, pairs, groups, ("first", "b"), "horizontal").first().block
    thin = "-" * 25
    assert block == "=" * 85 + f"\n\n  cat::file::5\n\n         ...one \n{thin}\n first   two. // x\n{thin}\n b       two // y\n{thin}\n         \\nthree... ***\n\n"


def test_layouts_of_odd_groups():
    text, thin = "aa bb cc dd", "-" * 25
    both = {"x": [(0, 2, "A"), (6, 8, "C")], "y": []}
    assert layout.beside(text, both, (0, 8), 3) == [" x   ...{aa} /A bb {cc} /C dd...", " y   ...aa bb cc dd..."]
    assert layout.stacked(text, both, (0, 8), 3) == ["     ...", thin, " x   aa // A", "      bb ", " x   cc // C", thin, " y   ", thin, "      dd... ***"]
    assert layout.stacked(text, {"x": [], "y": [(3, 5, "B")]}, (2, 5), 3)[0] == "     *** ...aa "


def test_clustered_table_keeps_rows(spark):
    rows = spark.range(100).withColumnRenamed("id", "text_id")
    table = store.clustered(rows, "clustered_test", buckets=4)
    assert table.count() == 100
    plan = table.join(table.withColumnRenamed("text_id", "other"), F.col("text_id") == F.col("other"))._jdf.queryExecution().executedPlan().toString()
    spark.sql("DROP TABLE clustered_test")
    assert "Exchange hashpartitioning" not in plan
