"""Operators against plain loops on small, awkward tables."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from annoframe.functions import dates
from annoframe.operators import annotate, collection, diff, layers, records, sample
from annoframe.sources import markup

SPAN = "text_id long, start long, end long, label string"


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "text_id long, text string").repartition(3)


def awkward(rng, n):
    return [None, "", " ", "\n\n", "...", "a", "é.\n", "日本 語!? x", "ab" * 700_000 + " c. d", *("".join(rng.choices("ab .!?\néß日👍\t", k=rng.randint(0, 40))) for _ in range(n))]


def test_words_and_sentences_against_patterns(spark):
    texts = awkward(random.Random(1), 300)
    t = frame(spark, texts)
    want = Counter((k, n, *m.span(), m[0]) for k, x in enumerate(texts) for n, m in enumerate(re.finditer("[^ \n]+", x or ""), 1))
    assert Counter(tuple(r) for r in layers.words(t).collect()) == want
    want = Counter()
    for k, x in enumerate(texts):
        kept = [m for m in re.finditer(r"[^.!?\n]+[.!?]*|[.!?\n]", x or "") if m[0][0] not in ".!?\n"]
        want.update((k, n, *m.span(), m[0]) for n, m in enumerate(kept, 1))
    assert Counter(tuple(r) for r in layers.sentences(t).collect()) == want
    plan = layers.words(t)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and plan.count("Exchange") == frame(spark, texts)._jdf.queryExecution().executedPlan().toString().count("Exchange")


def test_cuts_against_loops(spark):
    rng = random.Random(2)
    texts = awkward(rng, 150)
    s = layers.sentences(frame(spark, texts)).cache()
    of = defaultdict(list)
    for r in sorted(s.collect(), key=lambda r: r.start):
        of[r.text_id].append((r.start, r.end))
    for most in (1, 7, 20):
        want, summed = Counter(), Counter()
        for k, spans in of.items():
            chunks, begin = [], None
            for a, b in spans:
                begin = a if begin is None else begin
                last = b
                if b - begin >= most:
                    chunks.append((begin, b))
                    begin = None
            chunks += [(begin, last)] if begin is not None else []
            want.update((k, n, *c) for n, c in enumerate(chunks))
            n, size, total = 0, 0, 0
            for a, b in spans:
                size, total = size + 1, total + b - a
                if total >= most:
                    summed[k, n, size] += 1
                    n, size, total = n + 1, 0, 0
            summed.update([(k, n, size)] if size else [])
        assert Counter((r.text_id, r.chunk, r.start, r.end) for r in layers.greedy_cut(s, most).collect()) == want
        assert Counter((r.text_id, r.chunk, r.n_sentences) for r in layers.summed_cut(s, most).collect()) == summed


def spans(rng, n, texts=3, most=400):
    out = set()
    while len(out) < n:
        a = rng.randrange(most)
        out.add((rng.randrange(texts), a, a + rng.choice([0, 1, 3, 10, 150])))
    return sorted(out)


def test_containment_and_overlap(spark):
    rng = random.Random(3)
    a, b = spans(rng, 120), spans(rng, 60)
    x, y = (spark.createDataFrame([(*s, "l") for s in v], SPAN) for v in (a, b))
    got = Counter((r.text_id, r.x.start, r.x.end, r.s.start, r.s.end) for r in layers.contained(x, y, bucket=16).collect())
    assert got == Counter((p[0], p[1], p[2], q[1], q[2]) for p in a for q in b if p[0] == q[0] and p[1] >= q[1] and p[2] <= q[2])
    got = Counter((r.text_id, r.s_start, r.start, r.end) for r in layers.within(x, y, trim_overlapping=True).collect())
    want = Counter((p[0], q[1], max(p[1], q[1]) - q[1], min(p[2], q[2]) - q[1]) for p in a for q in b if p[0] == q[0] and p[1] < p[2] and q[1] < q[2] and p[1] < q[2] and q[1] < p[2])
    assert got == want


def linked(pairs):
    """Groups of (a, b) pairs of one text by the rule: each side is tested against its own side of the last group."""
    groups = []
    for a, b in sorted(set(pairs), key=lambda p: (min(p), max(p), p[0])):
        goes_on = groups and any(s in own or s[0] in [e for _, e in own] for s, own in zip((a, b), groups[-1][:2]))
        if not goes_on:
            groups.append([[], [], 0])
        for s, own in zip((a, b), groups[-1]):
            if s not in own:
                own.append(s)
        groups[-1][2] += 1
    return [(min(a[0][0], b[0][0]), max(a[-1][1], b[-1][1]), n) for a, b, n in groups]


PAIRS = "text_id long, a_start long, a_end long, a_label string, b_start long, b_end long, b_label string"


def test_linked_groups(spark):
    rng = random.Random(4)
    a, b = ([s for s in spans(rng, 50, most=120) if s[1] < s[2]] for _ in range(2))
    pairs = diff.conflicts(*(spark.createDataFrame([(*s, "l") for s in v], SPAN) for v in (a, b))).cache()
    want, of = Counter(), defaultdict(list)
    for r in pairs.collect():
        of[r.text_id].append(((r.a_start, r.a_end), (r.b_start, r.b_end)))
    for k, rows in of.items():
        want.update((k, n, *g) for n, g in enumerate(linked(rows), 1))
    assert Counter(tuple(r) for r in diff.linked_groups(pairs).collect()) == want


def test_a_span_does_not_continue_one_of_the_other_side(spark):
    rows = [(1, 0, 8, "x", 5, 10, "y"), (1, 10, 15, "x", 12, 14, "y"), (2, 0, 8, "x", 5, 10, "y"), (2, 8, 15, "x", 12, 14, "y"), (3, 0, 9, "x", 2, 3, "y"), (3, 0, 9, "x", 4, 5, "y")]
    got = sorted(tuple(r) for r in diff.linked_groups(spark.createDataFrame(rows, PAIRS)).collect())
    assert got == [(1, 1, 0, 10, 1), (1, 2, 10, 15, 1), (2, 1, 0, 15, 2), (3, 1, 0, 9, 2)]


def test_a_long_group_keeps_few_spans(spark):
    """One text whose conflicts are all linked, over many batches; what a group holds stays short."""
    group, most = diff.LinkedGroup(0), 0
    for k in range(20_000):
        pair = (10 * k, 10 * k + 10), (10 * k + 2, 10 * k + 6)
        assert not k or group.takes(pair)
        group.add(pair)
        if k % 1000 == 0:
            group.forget(10 * k)
        most = max(most, sum(map(len, group.sides)))
    assert most < 2100
    rows = spark.range(30_000).selectExpr("7L as text_id", "10 * id as a_start", "10 * id + 10 as a_end", "'x' as a_label", "10 * id + 2 as b_start", "10 * id + 6 as b_end", "'y' as b_label")
    assert [tuple(r) for r in diff.linked_groups(rows).collect()] == [(7, 1, 0, 300_000, 30_000)]
    assert diff.linked_groups(rows.where("false")).count() == 0


def test_spans_without_gaps(spark):
    t = frame(spark, ["one  two three", "abc"])
    s = spark.createDataFrame([(0, 1, 0, 3, "x"), (0, 1, 5, 8, "x"), (0, 1, 9, 14, "x"), (0, 2, 0, 3, "y"), (0, 2, 9, 14, "y"), (1, 1, 0, 1, "z"), (1, 1, 1, 2, "z")], "text_id long, span_id long, start long, end long, label string")
    got = sorted((r.text_id, r.span_id, r.part, r.start, r.end, r.label) for r in layers.cut_out(s, t).collect())
    assert got == [(0, 1, 1, 0, 14, "x"), (0, 2, 1, 0, 3, "y"), (0, 2, 2, 9, 14, "y"), (1, 1, 1, 0, 2, "z")]


def test_metadata_names():
    assert collection.metadata_names(["id", "src", "genre", "genre2", "year1990", "x10", "x1"]) == {"id": "initial_id", "src": "initial_src", "genre": "genre", "year1990": "year1990", "x10": "x10", "x1": "x1"}
    assert collection.metadata_names(["id", "src", "a", "a2"], keep_id=False, rename_src=False, merge_numbered=False) == {"src": "src", "a": "a", "a2": "a2"}
    for name in ("text_id", "initial_src", "initial_id"):
        with pytest.raises(ValueError, match="reserved"):
            collection.metadata_names([name])


def test_field_registry_goes_on_from_an_earlier_list(spark):
    meta = spark.createDataFrame([("a", 5, {"x": "1", "_own": "1", "y": "1"}), ("a", 2, {"z": "1"}), ("b", 1, {"y": "1"})], "file string, text_id long, meta map<string,string>")
    old = spark.createDataFrame([("a", "gone", 1), ("a", "y", 2)], "file string, field string, nth int")
    got = sorted((r.file, r.nth, r.field, r.first_text, r.n) for r in collection.field_registry(meta, "file", old).collect())
    assert got == [("a", 1, "gone", None, 0), ("a", 2, "y", 5, 1), ("a", 3, "z", 2, 1), ("a", 4, "x", 5, 1), ("b", 1, "y", 1, 1)]
    with pytest.raises(ValueError, match="fields"):
        collection.discovered_metadata(meta.select("text_id", "meta"), most=2)


def test_keys_are_inserted_once(spark):
    rows = lambda *k: spark.createDataFrame([(x,) for x in k], "key string")
    assert sorted(r.key for r in collection.appended(rows("a", "b"), rows("b", "c"), ["key"]).collect()) == ["c"]
    assert collection.inserted(rows("a"), rows("b", "c"), ["key"]).count() == 2
    for bad in (lambda: collection.appended(rows("a"), rows("c", "c"), ["key"]), lambda: collection.inserted(rows("a"), rows("a", "b"), ["key"]), lambda: collection.inserted(rows("a"), rows("b", "b"), ["key"])):
        with pytest.raises(Exception, match="key"):
            bad().collect()
    assert [r[0] for r in spark.sql("select 1").select(collection.chunk_key(F.lit("f"), F.lit(3), F.lit(None), F.lit(2))).collect()] == ["f:3:2"]


def test_layers_under_new_names(spark, tmp_path):
    links = spark.createDataFrame([("w", None, None), ("m", "w", None), ("s", None, "w")], "layer string, parent string, enveloping string")
    layer = spark.createDataFrame([(1, 0, 2, "x")], SPAN)
    tables, structure = layers.write_layers({"w": layer, "m": layer}, links, f"file://{tmp_path}/c", {"w": "words"})
    assert sorted(tables) == ["m", "words"] and tables["words"].count() == 1
    assert sorted(map(tuple, structure.collect()), key=str) == sorted([("words", None, None), ("m", "words", None), ("s", None, "words")], key=str)
    with pytest.raises(ValueError, match="one name"):
        layers.write_layers({"w": layer, "m": layer}, links, f"file://{tmp_path}/d", {"w": "m"})


def test_swapped_needs_one_annotation(spark):
    kind = "text_id long, start long, end long, a string, b string, f boolean"
    one = spark.createDataFrame([(1, 0, 1, "x", "y", False)], kind)
    assert [tuple(r) for r in layers.swapped(one, "a", "b", "f").collect()] == [(1, 0, 1, "y", "x", True)]
    with pytest.raises(Exception, match="more than one annotation"):
        layers.swapped(one.union(one), "a", "b", "f").collect()


def test_samples_of_large_categories(spark):
    rng = random.Random(5)
    rows = [(k, rng.choice("aaaaab"), rng.randint(0, 9)) for k in range(2000)]
    r = spark.createDataFrame(rows, "k long, c string, size long").repartition(4)
    got = {x.k for x in sample.pick_budget(r, "c", "size", 3000, 7, "k").collect()}
    total, of = sum(z for _, _, z in rows), defaultdict(list)
    import hashlib

    for k, c, z in rows:
        of[c].append((hashlib.md5(f"7|{k}".encode()).hexdigest(), k, z))
    want = set()
    for own in of.values():
        goal, at = int(sum(z for *_, z in own) / total * 3000), 0
        for _, k, z in sorted(own):
            if at < goal:
                want.add(k)
            at += z
    assert got == want
    with pytest.raises(Exception, match="over the whole"):
        sample.pick_budget(r, "c", "size", total + 1, 7, "k").count()
    n = {(x.k): x.nth for x in collection.numbered(r.withColumn("b", F.expr("k div 100")), "c", "k", "b").collect()}
    assert all(n[k] == m for own in of.values() for m, k in enumerate(sorted(k for _, k, _ in own), 1))
    assert [x.grp for x in sample.round_robin(r.withColumn("b", F.expr("k div 100")), "c", 3, "k", "b").where("c = 'b'").orderBy("k").collect()][:5] == [0, 1, 2, 0, 1]
    ends = collection.first_and_last(r, "c", "k", 2).where("c = 'b'").orderBy("k").collect()
    own = sorted(k for _, k, _ in of["b"])
    assert [(x.k, x.nth, x.from_end) for x in ends] == [(own[0], 1, len(own)), (own[1], 2, len(own) - 1), (own[-2], len(own) - 1, 2), (own[-1], len(own), 1)]
    few = collection.first_and_last(r.where("k < 3").withColumn("c", F.lit("x")), "c", "k", 2)
    assert sorted((x.k, x.nth, x.from_end) for x in few.collect()) == [(0, 1, 3), (1, 2, 2), (2, 3, 1)]
    with pytest.raises(ValueError):
        sample.checked_size(r, 2001)
    assert tuple(sample.extremes(r, "size").first()) == (2000, total, 0, 9)


def test_log_over_many_splits(spark, tmp_path):
    sep = markup.LOG_SEPARATOR
    text, want = "", []
    for k in range(400):
        text += (f"(!) x_errors in text with id {k} (a.xml)\n" if k % 7 == 0 else "") + f"{sep}\nkind{k % 3}::{k}\n{sep}\nline {k}\n\n"
        want.append((k + 1, f"kind{k % 3}", k, k - k % 7, [f"line {k}"]))
    (tmp_path / "log").write_text(text)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "900")
    try:
        rows = markup.log_blocks(spark, str(tmp_path))
        assert rows.rdd.getNumPartitions() >= 1
        got = sorted((r.nth, r.err_type, r.err_nr, r.text_id, r.lines) for r in rows.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == want


def test_vert_with_missing_ends_and_odd_values(spark, tmp_path):
    (tmp_path / "a.vert").write_bytes('<doc id="1" title="a<b>c" src="S">\r\n<s>\r\nx\ty\r\n</s>\r\n<doc doaj_id="7" src="S" src="T">\n<s>\nz\ty\n</doc>\n<doc url="u" src="Feeds 2014–2021">\n</doc>'.encode())
    found = markup.blocks(spark, str(tmp_path), "doc").orderBy("doc_nr")
    got = [(r.doc_nr, r.start_line, r.meta, r.id) for r in found.withColumn("id", markup.document_id(F.col("meta"), F.col("start_line"))).collect()]
    assert got == [(0, 1, {"id": "1", "title": "a<b>c", "src": "S"}, "1"), (1, 5, {"doaj_id": "7", "src": "T"}, "7"), (2, 9, {"url": "u", "src": "Feeds 2014–2021"}, "u(doc@line:9)")]
    assert [(r.doc_nr, r.token) for r in markup.tokens(found, ["doc_nr"]).orderBy("doc_nr").collect()] == [(0, "x"), (1, "z")]


def test_words_carried_by_place(spark):
    w = lambda *rows: spark.createDataFrame(list(rows), "text_id long, word_id long, start long, end long, lemma string")
    pairs = spark.createDataFrame([(2, 1)], "text_id long, from_id long")
    got = collection.carried_by_place(pairs, w((1, 1, 0, 1, "a"), (1, 2, 2, 3, "b")), w((2, 1, 0, 1, "q"), (2, 2, 2, 4, "q")), ["lemma"])
    assert sorted(tuple(r) for r in got.collect()) == [(2, 1, 0, 1, "a"), (2, 2, 2, 4, "b")]
    with pytest.raises(Exception, match="differ in words"):
        collection.carried_by_place(pairs, w((1, 1, 0, 1, "a")), w((2, 1, 0, 1, "q"), (2, 2, 2, 4, "q")), ["lemma"]).collect()


def test_split_documents_are_refused(spark):
    parts = spark.createDataFrame([(1, False), (2, True)], "text_id long, _split_document boolean")
    assert records.whole_documents(parts.where("text_id = 1")).count() == 1
    with pytest.raises(Exception, match="split document: 2"):
        records.whole_documents(parts).collect()


def test_chained_annotators(spark):
    make = annotate.chained(annotate.pattern_annotator("[a-z]+", "w"), lambda: lambda text, found: [(a, b, text[a:b].upper()) for a, b, _ in found if b - a > 1])
    layer, _ = annotate.good_and_bad(annotate.annotate(frame(spark, ["ab c de", None]), make))
    assert sorted(tuple(r) for r in layer.collect()) == [(0, 0, 2, "AB"), (0, 5, 7, "DE")]


def test_batches_over_the_limit(spark):
    """The counts of over_limit_batches against loops."""
    from annoframe import registry
    from tests.test_sources import slow_batches

    folder = "/root/testdata/sf0.001"
    want, rows = defaultdict(lambda: [0, 0, 0, 0]), spark.read.parquet(f"{folder}/documents.parquet").collect()
    for r in rows:
        of = want[r.source]
        found = [m.span() for m in re.finditer("[^ \n]+", r.text or "")]
        for a, b in slow_batches(r.text or "", 1750):
            n = sum(x < b and a < y for x, y in found)
            if n:
                of[0] += 1
                of[1] += n > 300
                of[2] += max(0, n - 300)
                of[3] += n
    got = {r.source: (r.batches, r.over_limit, r.words_lost, r.pct) for r in registry.QUERIES["over_limit_batches"](spark, folder).collect()}
    assert got == {k: (a, b, c, round(c * 100 / n, 4)) for k, (a, b, c, n) in want.items()}


def test_chat_years(spark):
    names = {"delfi150999.x": "1999-09-15", "delfi150903.x": "2003-09-15"}
    f = spark.createDataFrame([(k,) for k in names], "f string")
    none = F.lit(None).cast("string")
    got = {r.f: r.d for r in f.select("f", dates.creation_time_mixed(F.col("f"), F.lit("jututoavestlus"), none, none, none).alias("d")).collect()}
    assert got == names
