"""Annotation layers as frames with one row per span: build, flatten, cut, merge, project.

Spans are [start, end) in characters.  Every row carries its ordinal; nothing relies on the order of files.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from annoframe.functions import pieces
from annoframe.functions.pieces import dealt
from annoframe.operators.collection import numbered

def starts_of(parts: DataFrame, extra: int) -> DataFrame:
    """parts: text_id, pos, piece; start = lengths (and separators) of all earlier pieces of the text."""
    before = Window.partitionBy("text_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumn("start", F.coalesce(F.sum(F.length("piece") + extra).over(before), F.lit(0)).cast("long"))


def words(texts: DataFrame, by_text: bool = False) -> DataFrame:
    """text_id, word_id (from 1), start, end, token: runs between spaces and line ends.  by_text: rows of a text are together, so
    what is grouped, joined or sorted inside texts moves no rows."""
    return pieces.cut_texts(texts, pieces.words, "word_id", "token", by_text)


def sentences(texts: DataFrame, by_text: bool = False) -> DataFrame:
    """text_id, sent_id (from 1), start, end, sentence: runs up to closing marks or line ends.  by_text: as in `words`."""
    return pieces.cut_texts(texts, pieces.sentences, "sent_id", "sentence", by_text)


def shape(token: Column) -> Column:
    """A label for a word's form: digit, cap or other."""
    return F.when(token.rlike("^[0-9]"), "digit").when(token.rlike("^[A-Z]"), "cap").otherwise("other")


def labelled(word_layer: DataFrame) -> DataFrame:
    return word_layer.select("text_id", "start", "end", shape(F.col("token")).alias("label"))


#: Marks that a second version of a word layer cuts off.
CLOSING_MARKS = ".,!?;:*$%#&|"


def trimmed(word_layer: DataFrame, marks: str = CLOSING_MARKS) -> DataFrame:
    """A second version of a word layer without closing marks, short capitals unlabelled."""
    token = F.rtrim(F.col("token"), F.lit(marks))
    cut = word_layer.withColumn("token", token).where("token <> ''")
    label = F.when((shape(F.col("token")) == "cap") & (F.length("token") <= 3), "other").otherwise(shape(F.col("token")))
    return cut.select("text_id", "start", (F.col("start") + F.length("token")).alias("end"), label.alias("label"))


def versions_in(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, pa.ListArray, pa.ListArray]]:
    """Of runs of a batch's texts: ids, and the spans (start, end, label) of `labelled` and of `trimmed` words of each text as lists."""
    of = lambda token, mark: pc.match_substring_regex(token, mark)
    label = lambda token: pc.case_when(pc.make_struct(of(token, "^[0-9]"), of(token, "^[A-Z]")), "digit", "cap", "other")
    lists = lambda ends, start, length, label: pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.StructArray.from_arrays([pa.array(start), pa.array(start + length), label], names=["start", "end", "label"]))
    for ids, _, before, start, end, token in pieces.found_in(batch, pieces.words):
        a = lists(before, start, end - start, label(token))
        bare = pc.utf8_rtrim(token, characters=CLOSING_MARKS)
        length = pc.utf8_length(bare).to_numpy(zero_copy_only=False).astype(np.int64)
        kept = length > 0
        at, bare, length = pa.array(np.flatnonzero(kept)), bare.filter(pa.array(kept)), length[kept]
        own = label(bare)
        own = pc.if_else(pc.and_(pc.equal(own, "cap"), pa.array(length <= 3)), "other", own)
        yield ids, a, lists(np.concatenate(([0], np.cumsum(kept)))[before], start[at.to_numpy()], length, own)


def two_versions(texts: DataFrame) -> DataFrame:
    """text_id, a, b: `versions_in` of each text that has words.  No rows move."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for columns in versions_in(batch):
                yield pa.RecordBatch.from_arrays(list(columns), names=["text_id", "a", "b"])

    spans = "array<struct<start: long, end: long, label: string>>"
    schema = StructType([texts.schema["text_id"], *StructType.fromDDL(f"a {spans}, b {spans}").fields])
    return texts.select("text_id", "text").mapInArrow(run, schema).where("size(a) > 0")


def nested(layer: DataFrame) -> DataFrame:
    """One row per text with its spans in order, the at-rest form."""
    return layer.groupBy("text_id").agg(F.array_sort(F.collect_list(F.struct("start", "end", "label"))).alias("spans"))


def flat(layer: DataFrame) -> DataFrame:
    """One row per span of a nested layer."""
    return layer.select("text_id", F.posexplode("spans").alias("span_id", "s")).select("text_id", "span_id", "s.*")


def renamed(structure: DataFrame, names: dict[str, str]) -> DataFrame:
    """structure: layer, parent, enveloping (names of layers or null).  The same with new names, wherever a name stands."""
    new = F.create_map(*[x for k, v in names.items() for x in (F.lit(k), F.lit(v))]) if names else None
    own = lambda c: F.coalesce(F.try_element_at(new, F.col(c)), F.col(c)).alias(c) if names else F.col(c)
    return structure.select(own("layer"), own("parent"), own("enveloping"))


def write_layers(tables: dict[str, DataFrame], structure: DataFrame, folder: str, names: dict[str, str]) -> tuple[dict[str, DataFrame], DataFrame]:
    """Write each layer as a table of its own, in order of text_id, and the structure beside them, under new names; read both
    back.  Two layers of one name are an error."""
    spark, new = structure.sparkSession, {k: names.get(k, k) for k in tables}
    if len(set(new.values())) < len(new):
        raise ValueError(f"two layers of one name: {sorted(new.values())}")
    for old, name in new.items():
        tables[old].repartitionByRange("text_id").sortWithinPartitions("text_id").write.parquet(f"{folder}/{name}__layer")
    renamed(structure, names).write.parquet(f"{folder}/structure")
    return {name: spark.read.parquet(f"{folder}/{name}__layer") for name in new.values()}, spark.read.parquet(f"{folder}/structure")


def as_label(layer: DataFrame, attribute: str, pick_first: bool = False) -> DataFrame:
    """text_id, start, end, label: one attribute under the common name.  layer: one row per annotation with its number
    ann_id; of an ambiguous span all stay, or the first."""
    if pick_first:
        first = layer.groupBy("text_id", "start", "end").agg(F.min_by(attribute, "ann_id").alias("label"))
        return first.select("text_id", "start", "end", "label")
    return layer.select("text_id", "start", "end", F.col(attribute).alias("label"))


def cut_out(spans: DataFrame, texts: DataFrame) -> DataFrame:
    """Spans of several pieces as spans without gaps.  spans: text_id, span_id, start, end, label, one row per piece.  Pieces
    with only white space between them become one; other gaps stay open: text_id, span_id, part (from 1), start, end, label."""
    order = Window.partitionBy("text_id", "span_id").orderBy("start")
    met = spans.withColumn("last", F.lag("end").over(order)).join(texts.select("text_id", "text"), "text_id")
    between = F.substr("text", (F.col("last") + 1).cast("int"), (F.col("start") - F.col("last")).cast("int"))
    opens = met.select("text_id", "span_id", "start", "end", "label", F.when(F.col("last").isNull() | between.rlike(r"\S"), 1).otherwise(0).alias("opens"))
    part = F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return opens.withColumn("part", part).groupBy("text_id", "span_id", "part").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.first("label").alias("label"))


def sparse(layer: DataFrame, texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The layer without texts that have no spans in it, which is how it is kept, and one row: how many texts that skips."""
    skipped = texts.join(layer.select("text_id").distinct(), "text_id", "left_anti").agg(F.count("*").alias("skipped"))
    return layer, skipped


def written_sparse(texts_with_spans: DataFrame, path: str) -> dict[str, int]:
    """Write a layer (text_id, spans of every text, null or empty where there are none) without texts that have none, and count
    on the way: texts, skipped, spans.  The counts come with the write, from the one pass over the input."""
    counts = Observation()
    n = F.coalesce(F.size("spans"), F.lit(0))
    n = F.when(n > 0, n).otherwise(0)  # size of null is -1 in some settings
    seen = texts_with_spans.observe(counts, F.count("*").alias("texts"), F.count_if(n == 0).alias("skipped"), F.coalesce(F.sum(n), F.lit(0)).alias("spans"))
    seen.where(n > 0).write.parquet(path)
    return {k: int(v) for k, v in counts.get.items()}


def swapped(layer: DataFrame, a: str, b: str, flag: str) -> DataFrame:
    """Two attributes exchanged and the flag turned over.  A span with more than one annotation is an error."""
    said = F.concat(F.lit("more than one annotation at "), F.concat_ws(":", "text_id", "start", "end"))
    one = F.count("*").over(Window.partitionBy("text_id", "start", "end")) == 1
    own = [F.col(b).alias(a) if c == a else F.col(a).alias(b) if c == b else (~F.col(c)).alias(c) if c == flag else F.col(c) for c in layer.columns]
    return layer.withColumn("one", one).where(F.assert_true("one", said).isNull()).select(*own)


def fragments(texts: DataFrame) -> DataFrame:
    """Sentences as texts of their own: text_id, para_nr (paragraphs are lines with text, from 1), sent_nr (from 1 through the
    whole text), para_start, sent_start, sent_end (in the paragraph), text."""
    paragraphs = pieces.cut_texts(texts, pieces.lines, "para_nr", "line").drop("line")
    met = contained(sentences(texts), paragraphs)
    return met.select("text_id", F.col("s.para_nr").alias("para_nr"), F.col("x.sent_id").alias("sent_nr"), F.col("s.start").alias("para_start"), (F.col("x.start") - F.col("s.start")).alias("sent_start"), (F.col("x.end") - F.col("s.start")).alias("sent_end"), F.col("x.sentence").alias("text"))


def fingerprint_map(hashed: DataFrame) -> DataFrame:
    """hashed: text_id, sentence_id, sha256.  The sentences of each hash, one row each, numbered: sha256, nth (from 1), text_id,
    sentence_id.  A hot hash keeps its rows apart: they are numbered by text ranges."""
    return numbered(hashed.withColumn("part", F.expr("text_id div 1000")), "sha256", F.struct("text_id", "sentence_id"), "part").drop("part")


def _closed(spans: DataFrame, most: int, summed: bool) -> DataFrame:
    """Sentences with the number of their chunk.  A chunk closes at the first sentence that brings it to `most`: by the distance
    from its start, or by the sum of its sentences' lengths.  One walk over each text's sentences, in arrays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("s")
            offsets, flat = lists.offsets.to_numpy(), lists.flatten()
            offsets = offsets - offsets[0]
            start, end = (flat.field(k).to_numpy() for k in ("start", "end"))
            # what is measured from a chunk's first sentence on: ends, or sums of lengths
            reach = np.cumsum(end - start) if summed else end
            base = reach - (end - start) if summed else start
            chunk = np.zeros(len(start), np.int64)
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                at, n = a, 0
                while at < b:
                    stop = min(b, at + 1 + int(np.searchsorted(reach[at:b], base[at] + most)))
                    chunk[at:stop] = n
                    at, n = stop, n + 1
            owner = pa.array(np.repeat(np.arange(len(batch)), np.diff(offsets)))
            yield pa.RecordBatch.from_arrays([batch.column("text_id").take(owner), pa.array(chunk), pa.array(start), pa.array(end)], names=["text_id", "chunk", "start", "end"])

    lists = spans.groupBy("text_id").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("s"))
    return lists.mapInArrow(run, StructType([spans.schema["text_id"], *StructType.fromDDL("chunk long, start long, end long").fields]))


def greedy_cut(sentence_layer: DataFrame, most: int) -> DataFrame:
    """Chunks that close at the first sentence whose end is `most` or more after the chunk's start: text_id, chunk (from 0),
    start, end, separator (what of the text lies before the next chunk, as [end, next start); null after the last)."""
    chunks = _closed(sentence_layer, most, False).groupBy("text_id", "chunk").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    following = F.lead("start").over(Window.partitionBy("text_id").orderBy("chunk"))
    return chunks.withColumn("separator", F.when(following.isNotNull(), F.struct(F.col("end").alias("start"), following.alias("end")))).withColumn("chunk", F.col("chunk").cast("int"))


def summed_cut(sentence_layer: DataFrame, most: int) -> DataFrame:
    """Chunks that close when their summed sentence lengths reach `most`: text_id, chunk (from 0), n_sentences."""
    chunks = _closed(sentence_layer, most, True).groupBy("text_id", "chunk").agg(F.count("*").cast("int").alias("n_sentences"))
    return chunks.withColumn("chunk", F.col("chunk").cast("int"))


def contained(layer: DataFrame, sections: DataFrame, bucket: int = 256) -> DataFrame:
    """Spans inside a section: text_id, x (row of the layer), s (row of the section).  Sections are dealt to the stretches of
    text that they touch and spans to the one that they begin in, so a long text is spread and never joined as a whole."""
    a = layer.select("text_id", F.expr(f"start div {bucket}").alias("bucket"), F.struct(*layer.columns).alias("x"))
    touched = F.sequence(F.expr(f"start div {bucket}"), F.expr(f"end div {bucket}"))
    b = sections.select("text_id", F.explode(touched).alias("bucket"), F.struct(*sections.columns).alias("s"))
    return a.join(b, ["text_id", "bucket"]).where("x.start >= s.start and x.end <= s.end").drop("bucket")


def within(layer: DataFrame, sections: DataFrame, trim_overlapping: bool = False) -> DataFrame:
    """Spans inside a section, with places counted from its start.  trim_overlapping: spans that reach over a section's
    edge are cut there; otherwise they are left out."""
    if trim_overlapping:
        met = overlapping(layer, sections).select("text_id", "s", F.greatest("x.start", "s.start").alias("start"), F.least("x.end", "s.end").alias("end"), F.col("x.label").alias("label"))
    else:
        met = contained(layer, sections).select("text_id", "s", F.col("x.start").alias("start"), F.col("x.end").alias("end"), F.col("x.label").alias("label"))
    return met.select("text_id", F.col("s.start").alias("s_start"), (F.col("start") - F.col("s.start")).alias("start"), (F.col("end") - F.col("s.start")).alias("end"), "label")


def overlapping(a: DataFrame, b: DataFrame, bucket: int = 64) -> DataFrame:
    """Pairs of spans of one text that share a character: text_id, x (row of a), s (row of b).  Both sides are dealt to the
    stretches that they touch; a pair counts where its later start lies."""
    def stretched(rows: DataFrame, name: str) -> DataFrame:
        touched = F.sequence(F.expr(f"start div {bucket}"), F.expr(f"(end - 1) div {bucket}"))
        return rows.where("start < end").select("text_id", F.explode(touched).alias("bucket"), F.struct(*rows.columns).alias(name))

    met = stretched(a, "x").join(stretched(b, "s"), ["text_id", "bucket"]).where("x.start < s.end and s.start < x.end")
    return met.where(f"bucket = greatest(x.start, s.start) div {bucket}").drop("bucket")


def chunked_ids(tree: DataFrame, most: int) -> DataFrame:
    """Long sentences in runs of `most` words, word ids restarting at 1: adds chunk and local."""
    return tree.withColumn("chunk", F.expr(f"(id - 1) div {most}")).withColumn("local", F.pmod(F.col("id") - 1, F.lit(most)) + 1)


def merged_ids(chunks: DataFrame, most: int) -> DataFrame:
    """Back to ids of the whole sentence; heads move alike and the root's head stays 0."""
    id_, head = F.col("chunk") * most + F.col("local"), F.when(F.col("local_head") == 0, 0).otherwise(F.col("chunk") * most + F.col("local_head"))
    return chunks.withColumn("id", id_).withColumn("head", head)


def parents(tree: DataFrame) -> DataFrame:
    """Each word with its head's token and the number and least id of its children.  tree: text_id, sent_id, id, head, token."""
    key = ["text_id", "sent_id"]
    up = tree.select(*key, F.col("id").alias("head"), F.col("token").alias("parent"))
    down = tree.groupBy(*key, F.col("head").alias("id")).agg(F.count("*").alias("n_children"), F.min("id").alias("first_child"))
    return tree.join(up, [*key, "head"], "left").join(down, [*key, "id"], "left").select(*key, "id", "head", "token", "parent", F.coalesce("n_children", F.lit(0)).alias("n_children"), "first_child")


def modern_spelling(token: Column) -> Column:
    """v for w in words that have w."""
    return F.when(F.lower(token).contains("w"), F.translate(token, "wW", "vV"))


#: Letters that a model does not know, and those that stand for them.
MODEL_SAFE = ("еиò", "eio")


def model_safe(text: Column) -> Column:
    return F.translate(text, *MODEL_SAFE)


def snippet(text: Column, start: Column, end: Column, width: int) -> Column:
    """A span with `width` characters on either side, line ends shown as backslash n."""
    begin = F.greatest(start - width, F.lit(0))
    return F.replace(F.substring(text, begin.cast("int") + 1, (F.least(end + width, F.length(text).cast("long")) - begin).cast("int")), F.lit("\n"), F.lit("\\n"))


def snippets(spans: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """spans: text_id, start, end and more.  The same rows with `context`, the `snippet` of each.  A text meets its spans once, as a list,
    and is cut from its start to its end in one go; spans of layers that were cut by_text don't move."""
    more = [f for f in spans.schema.fields if f.name != "text_id"]
    lists = spans.groupBy("text_id").agg(F.collect_list(F.struct(*[f.name for f in more])).alias("spans"))
    met = dealt(texts.select("text_id", "text")).join(lists, "text_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, text in enumerate(batch.column("text").to_pylist()):
                own = batch.column("spans").slice(k, 1).flatten()
                start, end = (own.field(c).to_numpy(zero_copy_only=False) for c in ("start", "end"))
                cut = zip(np.maximum(start - width, 0).tolist(), (end + width).tolist())
                context = pa.array([None] * len(own) if text is None else [text[a:b].replace("\n", "\\n") for a, b in cut], pa.string())
                ids = batch.column("text_id").take(pa.array(np.full(len(own), k)))
                yield pa.RecordBatch.from_arrays([ids, *own.flatten(), context], names=["text_id", *[f.name for f in more], "context"])

    return met.mapInArrow(run, StructType([spans.schema["text_id"], *more, *StructType.fromDDL("context string").fields]))


def bio_entities(tags: DataFrame) -> DataFrame:
    """tags: text_id, word_id, start, end, tag (B-x, I-x, O).  An entity opens at B-, or where the type changes; O closes."""
    by_word = Window.partitionBy("text_id").orderBy("word_id")
    kind = F.when(F.col("tag") != "O", F.substring_index("tag", "-", -1))
    t = tags.withColumn("kind", kind).withColumn("last", F.lag("kind").over(by_word))
    opens = F.col("kind").isNotNull() & (F.col("tag").startswith("B-") | F.col("last").isNull() | (F.col("last") != F.col("kind")))
    t = t.withColumn("entity", F.sum(opens.cast("int")).over(by_word.rowsBetween(Window.unboundedPreceding, 0))).where("kind is not null")
    return t.groupBy("text_id", "entity", "kind").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("n_words"))


def joined_neighbours(spans: DataFrame) -> DataFrame:
    """Spans of one label where one ends as the next starts become one."""
    order = Window.partitionBy("text_id", "label").orderBy("start", "end")
    island = F.when(F.lag("end").over(order) == F.col("start"), 0).otherwise(1)
    s = spans.withColumn("new", island).withColumn("island", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return s.groupBy("text_id", "label", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("n")).drop("island")


@lru_cache
def unprintable() -> str:
    """The characters that Python's repr escapes, as a pattern."""
    bad = [not chr(i).isprintable() for i in range(0x110000)] + [False]
    edges = [i for i in range(0x110001) if bad[i] != (i > 0 and bad[i - 1])]
    return "[" + "".join(f"\\x{{{a:X}}}-\\x{{{b - 1:X}}}" for a, b in zip(edges[::2], edges[1::2])) + "]"


def escaped(x: Column) -> Column:
    """Unprintable characters as Python's repr writes them."""
    def one(c: Column) -> Column:
        code = F.ascii(c)
        as_hex = lambda mark, n: F.concat(F.lit("\\" + mark), F.lpad(F.lower(F.hex(code)), n, "0"))
        short = F.when(c == "\t", "\\t").when(c == "\n", "\\n").when(c == "\r", "\\r")
        other = F.when(code < 0x100, as_hex("x", 2)).when(code < 0x10000, as_hex("u", 4)).otherwise(as_hex("U", 8))
        return F.when(c.rlike(unprintable()), F.coalesce(short, other)).otherwise(c)

    each = F.transform(F.regexp_extract_all(x, F.lit("(?s)."), F.lit(0)), one)
    # most tokens have none of the characters past the first few hundred printable ones
    return F.when(x.rlike(r"[^\x20-\x7E\xA1-\xAC\xAE-\u0377]"), F.array_join(each, "")).otherwise(x)


#: Anything but plain printable characters: quotes, backslashes, and all past the first few hundred.
SPECIAL = r"[^\x20-\x26\x28-\x5B\x5D-\x7E\xA1-\xAC\xAE-\u0377]"


def python_list(tokens: Column) -> Column:
    """How Python prints a list of strings, the text that sentence fingerprints are taken of.  A list is looked at once; only one
    with a special character has its tokens looked at one by one."""
    def quoted(x: Column) -> Column:
        plain = escaped(F.replace(x, F.lit("\\"), F.lit("\\\\")))
        single = F.concat(F.lit("'"), F.replace(plain, F.lit("'"), F.lit("\\'")), F.lit("'"))
        return F.when(x.contains("'") & ~x.contains('"'), F.concat(F.lit('"'), plain, F.lit('"'))).otherwise(single)

    plain = ~F.array_join(tokens, " ").rlike(SPECIAL) & (F.size(tokens) > 0)
    simple = F.concat(F.lit("['"), F.array_join(tokens, "', '"), F.lit("']"))
    return F.when(plain, simple).otherwise(F.concat(F.lit("["), F.array_join(F.transform(tokens, quoted), ", "), F.lit("]")))


def fingerprint(tokens: Column) -> Column:
    return F.sha2(python_list(tokens), 256)


def known_fingerprints(hashed: DataFrame, known: DataFrame) -> DataFrame:
    """hashed, known: text_id, sha256 (and more).  The same rows as hashed; a sentence whose fingerprint the other side of its
    text lacks is an error."""
    there = known.select("text_id", "sha256").distinct().withColumn("there", F.lit(True))
    said = F.concat(F.lit("sentence is not known in text "), F.col("text_id").cast("string"))
    met = hashed.join(there, ["text_id", "sha256"], "left").where(F.assert_true(F.col("there").isNotNull(), said).isNull())
    return met.select(*hashed.columns)


def only_fields(layer: DataFrame, fields: list[str], kept: list[str], instead: str = "_") -> DataFrame:
    """A layer as input for an annotator that may see some of its fields only: the others hold `instead`."""
    return layer.select(*[F.lit(instead).alias(c) if c in fields and c not in kept else F.col(c) for c in layer.columns])


def token_places(texts: DataFrame, tokens: DataFrame) -> DataFrame:
    """tokens: text_id, id (in order), token.  Adds start, end and ok: whether the token stands at its place in the text
    when spaces and line ends are skipped.  A token lies in the run of the text whose count of earlier characters is the
    last not over its own."""
    runs = words(texts, by_text=True)
    order = Window.partitionBy("text_id").orderBy("at", "id")
    before = lambda by, length: F.coalesce(F.sum(length).over(Window.partitionBy("text_id").orderBy(by).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    run = F.struct("at", "start", F.col("token").alias("piece"))
    there = runs.withColumn("at", before("word_id", F.length("token"))).select("text_id", "at", F.lit(None).cast("long").alias("id"), F.lit(None).cast("string").alias("token"), run.alias("run"))
    asked = tokens.withColumn("at", before("id", F.length("token"))).select("text_id", "at", F.col("id").cast("long").alias("id"), "token", F.lit(None).cast(there.schema["run"].dataType).alias("run"))
    met = there.union(asked).withColumn("run", F.last("run", ignorenulls=True).over(order)).where("id is not null")
    inside = F.col("at") - F.col("run.at")
    same = F.substring("run.piece", (inside + 1).cast("int"), F.length("token")) == F.col("token")
    start = F.col("run.start") + inside
    return met.select("text_id", "id", "token", start.alias("start"), (start + F.length("token")).alias("end"), F.coalesce(same, F.col("id").isNull()).alias("ok"))  # true for runs too, as a later check may be read before they are left out


def checked_places(placed: DataFrame) -> DataFrame:
    """The same rows; reading one that is not ok fails."""
    said = F.concat(F.lit("token not in its place: "), F.coalesce("token", F.lit("null")))
    return placed.where(F.assert_true("ok", said).isNull()).drop("ok")


def routed(sentence_sizes: DataFrame, most: int, strategy: str) -> DataFrame:
    """sentence_sizes: text_id, sent_id, n (words).  Adds route (gpu or cpu) and n_chunks of each sentence: NONE leaves long
    sentences whole, CHUNKING cuts those, USE_CPU sends all of a text that has one to the cpu."""
    if strategy == "NONE":
        return sentence_sizes.withColumn("route", F.lit("gpu")).withColumn("n_chunks", F.lit(1).cast("long"))
    if strategy == "CHUNKING":
        return sentence_sizes.withColumn("route", F.lit("gpu")).withColumn("n_chunks", F.greatest(F.ceil(F.col("n") / most), F.lit(1)).cast("long"))
    if strategy == "USE_CPU":
        longest = F.max("n").over(Window.partitionBy("text_id"))
        return sentence_sizes.withColumn("route", F.when(longest > most, "cpu").otherwise("gpu")).withColumn("n_chunks", F.lit(1).cast("long"))
    raise ValueError(f"unknown strategy {strategy}")


def via_helper(layer: DataFrame, helper: Callable[[DataFrame], DataFrame], annotate: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Annotate a layer by way of a helper layer that is never kept: `helper` may change tokens and spans but passes
    p_start and p_end, the place in the parent; labels of the helper's spans come out on the parent's."""
    own = layer.withColumn("p_start", F.col("start")).withColumn("p_end", F.col("end"))
    return annotate(helper(own)).select("text_id", F.col("p_start").alias("start"), F.col("p_end").alias("end"), "label")


def json_sizes(layer: DataFrame) -> DataFrame:
    """text_id, json_size: characters of the layer's spans as a JSON list without spaces; no list is built."""
    item = F.length(F.to_json(F.struct("start", "end", "label")))
    return layer.groupBy("text_id").agg((F.sum(item) + F.count("*") + 1).alias("json_size"))


def guarded(layer: DataFrame, most: int = 175_000_000) -> DataFrame:
    """json_sizes of a layer; reading a text whose layer is over `most` fails."""
    said = F.concat(F.lit("layer too large in text "), F.coalesce(F.col("text_id").cast("string"), F.lit("null")))
    return json_sizes(layer).where(F.assert_true(F.col("json_size") <= most, said).isNull())
