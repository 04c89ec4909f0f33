"""Readers of marked-up files, dates, annotators in Python, against hand-written fixtures and plain Python."""

import json
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from annoframe.functions import dates
from annoframe.operators import annotate, entities, records
from annoframe.sources import markup

VERT = """junk
<doc id="1" src="Web <b> 2021" id="2">
<p>
<s>
Tere\ttere
<g/>
!\t!\tZ
</s>
</p>
outside\tx
</doc>
<doc id="3">
</doc>
<doc id="4">
<s>
a\tb\tc
no tab here
<unknown x="1">
<p>\tnot a tag
"""


def test_vert(spark, tmp_path):
    (tmp_path / "a.vert").write_text(VERT)
    docs = markup.blocks(spark, str(tmp_path), "doc")
    got = {r.doc_nr: (r.meta, r.start_line) for r in docs.collect()}
    assert got == {0: ({"id": "2", "src": "Web <b> 2021"}, 2), 1: ({"id": "3"}, 12), 2: ({"id": "4"}, 14)}
    words = markup.tokens(docs, ["doc_nr"]).orderBy("doc_nr", "pos").collect()
    assert [(r.doc_nr, r.par, r.sent, r.word, r.token, r.n_features, r.glued) for r in words] == [(0, 1, 1, 1, "Tere", 2, False), (0, 1, 1, 2, "!", 3, True), (2, 0, 1, 1, "a", 3, False), (2, 0, 1, 2, "<p>", 2, False)]
    assert [r.text for r in markup.sentence_texts(markup.tokens(docs, ["doc_nr"]), ["doc_nr"]).orderBy("doc_nr").collect()] == ["Tere!", "a <p>"]


def test_blocks_number_over_splits(spark, tmp_path):
    (tmp_path / "a.vert").write_text("".join(f'<doc id="{k}">\n<s>\n{"x" * (k % 50)}\ty\n</s>\n</doc>\n' for k in range(500)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        rows = markup.blocks(spark, str(tmp_path), "doc").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted((int(r.meta["id"]), r.doc_nr, r.start_line) for r in rows) == [(k, k, 5 * k + 1) for k in range(500)]


def test_syntax_line(spark):
    row = spark.createDataFrame([("a\tb",), ("\t".join("abcdefghijklmnop"),)], "line string")
    got = [r[0].split("\t") for r in row.select(markup.syntax_line(F.col("line"), [F.lit(1), F.lit(0), F.lit("root")], [F.lit(None).cast("string")] * 5)).collect()]
    assert got == [["a", "b"] + [""] * 11 + ["1", "0", "root"] + [""] * 5, list("abcdefghijklm") + ["1", "0", "root"] + [""] * 5]


def test_plain_numbers(spark):
    frame = spark.createDataFrame([("12 000",), ("a 1",), ("7",), (None,)], "t string")
    assert [r[0] for r in frame.select(markup.plain_number(F.col("t"))).collect()] == ["12000", "a 1", "7", None]


def test_prevert_needs_a_domain(spark, tmp_path):
    (tmp_path / "a").write_text('<doc id="5" web_domain="x.ee">\n<p heading="1">\nTere\n</p>\n<p>\n \n</p>\n</doc>\n')
    r = markup.paragraphs(markup.blocks(spark, str(tmp_path), "doc").withColumn("id", F.col("meta")["id"]), ["id"]).collect()
    assert [(x.web_domain, x.par, x.meta, x.text) for x in r] == [("x.ee", 1, {"heading": "1"}, "\nTere\n")]
    (tmp_path / "a").write_text('<doc id="5">\n<p>\nTere\n</p>\n</doc>\n')
    with pytest.raises(Exception, match="web_domain"):
        markup.paragraphs(markup.blocks(spark, str(tmp_path), "doc").withColumn("id", F.col("meta")["id"]), ["id"]).collect()


def test_tei(spark, tmp_path):
    (tmp_path / "a.xml").write_text('<?xml version="1.0"?><body><div1 id="1" src="a&amp;b"><p><s>One &lt;.</s><s>Two.</s></p><p><s> </s></p><p><s>Three</s></p></div1><div1 id="2"/></body>')
    assert [tuple(r) for r in markup.tei_texts(spark, str(tmp_path)).orderBy("id").collect()] == [("1", "a&b", "One <.\nTwo.\n\nThree"), ("2", None, "")]
    assert markup.tei_texts(spark, str(tmp_path), keep_empty=False).count() == 1


def test_archives_and_json(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("d/one.xml", "<a>õ</a>")
        z.writestr("d/two.xml", "<b/>")
        z.writestr("d/three.txt", "x")
    rows = lambda **k: sorted((r.member, r.content) for r in markup.archive_members(spark, str(tmp_path / "a.zip"), **k).collect())
    assert rows() == [("d/one.xml", "<a>õ</a>"), ("d/two.xml", "<b/>")] and rows(focus=["two.xml"]) == [("d/two.xml", "<b/>")]
    folder = tmp_path / "c" / "v" / "0" / "17"
    folder.mkdir(parents=True)
    (folder / "doc_01.json").write_text(json.dumps({"text": "Tere"}, indent=1))
    (folder / "other.json").write_text("{}")
    assert [(r.text, r.path_id, r.path_name) for r in markup.json_documents(spark, str(tmp_path / "c"), "text string").collect()] == [("Tere", 17, "doc_01.json")]


def test_log_blocks(spark, tmp_path):
    sep = markup.LOG_SEPARATOR
    (tmp_path / "log").write_text(f"start\n(!) clauses_errors in text with id 7 (a.xml)\n{sep}\nwrong_end::1\n{sep}\nei 7 8 aux\n\n{sep}\nwrong_end::2 ok\n{sep}\nb 1\n(!) clauses_errors in text with id 9 (b.xml)\n{sep}\nx::3\n{sep}\nc")
    got = [(r.err_type, r.err_nr, r.judgement, r.text_id, r.lines) for r in markup.log_blocks(spark, str(tmp_path)).orderBy("nth").collect()]
    assert got == [("wrong_end", 1, "", 7, ["ei 7 8 aux"]), ("wrong_end", 2, "ok", 7, ["b 1"]), ("x", 3, "", 9, ["c"])]


def test_dates(spark):
    issues = {"Luup Nr . 9 ( 118 ) , 29. aprill 2000": "2000-04-29", "Luup Nr . 9 , 1.aprill 2000": "2000-04-01", "Luup , 19 jaanuar 2000": "2000-01-19", "Luup Nr . 12 ( 139 ) , detsember 2000": "2000-12-XX", "Luup , 1. mai 1999": None, "": None, None: None}
    frame = spark.createDataFrame([(k,) for k in issues], "i string")
    assert {r.i: r.d for r in frame.select("i", dates.issue_date(F.col("i"), F.lit("2000")).alias("d")).collect()} == issues
    free = {"30.09.2003 09:48": "2003-09-30T09:48", "Wed , 24 Oct 2001 16:28:08 +0200 ( EET )": "2001-10-24T16:28", "11 Feb 2003 11:31:39 +0200": "2003-02-11T11:31", "25. veebruar 2004. a. 18:06:27": "2004-02-25T18:06",
            "Thu , 04 Dec 03 01:51:31 GMT": "2003-12-04T01:51", "21-06-2003 , 16:48": "2003-06-21T16:48", "29.12.2003": "2003-12-29TXX:XX", "yesterday": None, None: None}
    frame = spark.createDataFrame([(k,) for k in free], "i string")
    assert {r.i: r.d for r in frame.select("i", dates.iso_minutes(F.col("i")).alias("d")).collect()} == free
    kinds = {"2003-01-02": "full_date", "2003-XX-XX": "partial_date", "2003-05-XX": "partial_date", "XXXX-XX-XX": "unknown_date", None: "unknown_date"}
    frame = spark.createDataFrame([(k,) for k in kinds], "i string")
    assert {r.i: r.d for r in frame.select("i", dates.completeness(F.col("i")).alias("d")).collect()} == kinds
    with pytest.raises(Exception, match="unknown month"):
        spark.createDataFrame([("maius?",), ("foo",)], "m string").select(dates.month_number(F.col("m"), strict=True)).collect()


def slow_batches(text, most, ends=".!?"):
    if len(text) < most:
        return [(0, len(text))]
    out, at = [], 0
    while at < len(text):
        stop = min(len(text), at + most)
        inside = [k for k in range(at + 2, stop) if text[k] in ends]
        stop = max(inside) + 1 if inside else stop
        out.append((at, stop))
        later = [k for k in range(stop, len(text)) if not text[k].isspace()]
        at = later[0] if later else stop
    return out


def test_budget_batches():
    rng = random.Random(3)
    for _ in range(300):
        text = "".join(rng.choice("ab .!\n") for _ in range(rng.randrange(60)))
        most = rng.randrange(1, 20)
        assert [x[:2] for x in annotate.budget_spans(text, most)] == slow_batches(text, most)


def test_annotate_goes_on_after_errors(spark):
    frame = spark.createDataFrame([(1, "ab"), (2, None), (3, "bad"), (4, "")], "text_id long, text string")

    def make():
        def one(text):
            if text == "bad":
                raise ValueError("no")
            return [(0, len(text), "all")] if text else []

        return one

    layer, bad = annotate.good_and_bad(annotate.annotate(frame, make))
    assert [tuple(r) for r in layer.collect()] == [(1, 0, 2, "all")] and [tuple(r) for r in bad.collect()] == [(3, "ValueError: no")]


def test_pair_annotations():
    x = lambda r, p, f: {"root": r, "pos": p, "form": f}
    names = ["root", "pos", "form"]
    assert annotate.pair_annotations([x("a", "S", "n"), x("b", "V", "d")], [x("b", "V", "g"), x("a", "S", "n"), x("q", "Q", "Q")], names, ["root"]) == [("COMMON", 0, 1, names), ("MODIFIED", 1, 0, ["root", "pos"]), ("EXTRA", -1, 2, [])]
    assert annotate.pair_annotations([x("a", "S", "n")], [x("z", "Z", "z")], names, []) == [("MISSING", 0, -1, []), ("EXTRA", -1, 0, [])]
    assert annotate.pair_annotations([], [], names, []) == []


def test_entity_repair(spark):
    t = spark.createDataFrame([(1, "Pärnuga ja MART VÕRK, Kesk.")], "text_id long, text string")
    span = "text_id long, start long, end long, label string"
    e = spark.createDataFrame([(1, 0, 5, "LOC"), (1, 13, 14, "PER"), (1, 22, 26, "ORG")], span)
    tokens = spark.createDataFrame([(1, 0, 5), (1, 5, 7), (1, 11, 13), (1, 13, 14), (1, 22, 26)], "text_id long, start long, end long")
    grown = entities.expanded(e, tokens, t)
    assert sorted((r.start, r.end, r.grown) for r in grown.collect()) == [(0, 7, True), (13, 14, False), (22, 26, False)]
    assert sorted((r.start, r.end) for r in entities.without_infixes(grown, t).collect()) == [(0, 7), (22, 26)]


def test_add_layers():
    with pytest.raises(ValueError, match="not given"):
        records.add_layers({}, {}, ["a"])
    with pytest.raises(ValueError, match="exist"):
        records.add_layers({"a": 1}, {"a": 2}, ["a"])
    assert records.add_layers({"a": 1}, {"a": 2, "b": 3, "c": 4}, ["a", "b"], update=True) == {"a": 1, "b": 3}
