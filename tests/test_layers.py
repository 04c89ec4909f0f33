"""Edge cases of the layer, diff and sampling operators against plain Python."""

from pyspark.sql import functions as F

from annoframe.operators import collection, diff, layers, sample


def texts(spark, *values):
    return spark.createDataFrame([(k, v, "en", "s") for k, v in enumerate(values)], "text_id long, text string, lang string, source string")


def test_words_and_sentences_find_themselves(spark):
    values = ["", None, "One.", "Tere! Võtaks õige siit kohast uuesti.", "a  b\n\nc d...e\n", "no end"]
    t = texts(spark, *values)
    for r in layers.words(t).collect():
        assert values[r.text_id][r.start : r.end] == r.token
    for r in layers.sentences(t).collect():
        assert values[r.text_id][r.start : r.end] == r.sentence
    assert {r.text_id for r in layers.words(t).collect()} == {2, 3, 4, 5}


def test_greedy_cut(spark):
    t = texts(spark, "Tere! Võtaks õige siit kohast uuesti.")
    for most, parts in ((5, 2), (15, 1), (100, 1)):
        assert layers.greedy_cut(layers.sentences(t), most).count() == parts


def test_fingerprint_is_of_pythons_list(spark):
    import hashlib

    for words in (["d", "e", "c", "1"], ["a", "b", "c"], ["it's", 'say "x"', "b\\c", "both ' and \""], []):
        frame = spark.createDataFrame([(words,)], "w array<string>")
        assert frame.select(layers.fingerprint(F.col("w"))).first()[0] == hashlib.sha256(str(words).encode()).hexdigest()


def test_diff_conserves_spans(spark):
    w = layers.words(texts(spark, "One, two three. Four 5!", "Same"))
    a, b = layers.labelled(w), layers.trimmed(w)
    n = {r.status: r["count"] for r in diff.span_diff(a, b).groupBy("status").count().collect()}
    assert n.get("unchanged", 0) + n.get("modified", 0) + n.get("missing", 0) == a.count()
    assert n.get("unchanged", 0) + n.get("modified", 0) + n.get("extra", 0) == b.count()


def test_conflicts_cross_buckets(spark):
    kind = "text_id long, start long, end long, label string"
    a = spark.createDataFrame([(0, 0, 200, "x"), (0, 300, 310, "x")], kind)
    b = spark.createDataFrame([(0, 60, 70, "y"), (0, 130, 140, "y"), (0, 300, 310, "y"), (1, 0, 5, "y")], kind)
    assert sorted((r.a_start, r.b_start) for r in diff.conflicts(a, b).collect()) == [(0, 60), (0, 130)]


def test_even_quotas(spark):
    rows = spark.createDataFrame([(k, f"f{k % 6}") for k in range(60)], "id long, f string")
    assert [r.quota for r in sample.quotas(rows, "f", 15).orderBy("f").collect()] == [3, 3, 3, 2, 2, 2]
    assert sample.pick_even(rows, "f", 15, 1, "id").count() == 15


def test_sources_are_normalised(spark):
    names = {"Web 2021": "Web 2021", "Wikipedia 2023": "Wikipedia", "Literature Old 1864–1945": "Literature Old", None: None}
    frame = spark.createDataFrame([(k,) for k in names], "s string")
    assert {r.s: r.n for r in frame.select("s", collection.normalize_src(F.col("s")).alias("n")).collect()} == names


def test_path_groups(spark):
    frame = spark.createDataFrame([(0,), (30001,), (60001,), (99999,)], "i long")
    assert [r[0] for r in frame.select(collection.doc_group(F.col("i"))).collect()] == [0, 1, 2, 3]
