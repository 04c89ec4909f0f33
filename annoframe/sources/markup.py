"""Marked-up corpus files: vert, vrt, prevert, TEI XML, logs, indexes, JSON documents.

Files with one block per document are read with the block's opening tag as record separator, so that Spark splits them
anywhere.  Numbers inside a file come from counts per split and a running sum over the splits of a file (logs too); no task
sees a whole file but for archives, which one task lists and many unpack.  A block starts where its tag stands at a line's start; a missing closing tag is tolerated, and text before
the first block is dropped.  Empty files give no rows; attributes that repeat keep their last value.
"""

from __future__ import annotations

import bz2
import io
import re
import struct
import tarfile
import zipfile
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

ATTRIBUTE = r'([^\s="<>/]+)="([^"]*)"'
LOG_SEPARATOR = "=" * 50
PARTS = 4  # in which a task's blocks are dealt before their lines are taken apart
FEATURE_RUN = 500  # tokens whose features are put together
BLOCKS_AT_ONCE = 200  # whose tokens are held as objects


def _records(spark: SparkSession, path: str, separator: str) -> DataFrame:
    """file, split, at (order within the split), value."""
    raw = spark.read.option("lineSep", separator).option("recursiveFileLookup", "true").text(path)
    return raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("at"), "value")


def attributes(tag: Column) -> Column:
    """key="value" pairs of a tag as a map."""
    keys, values = (F.reverse(F.regexp_extract_all(tag, F.lit(ATTRIBUTE), F.lit(k))) for k in (1, 2))
    own = F.array_distinct(keys)
    return F.map_from_arrays(own, F.transform(own, lambda k: F.element_at(values, F.array_position(keys, k).cast("int"))))


#: Sources whose documents are named by their address.
ADDRESSED_SOURCES = ("Feeds 2014–2021", "Timestamped 2014–2023")


def document_id(meta: Column, line: Column) -> Column:
    """A tag's id; without one its doaj_id, its ISBN, in some sources its url with the line, else the line alone."""
    at = F.concat(F.lit("(doc@line:"), line.cast("string"), F.lit(")"))
    return F.coalesce(meta["id"], meta["doaj_id"], meta["ISBN"], F.when(meta["src"].isin(*ADDRESSED_SOURCES), F.concat(meta["url"], at)), at)


def blocks(spark: SparkSession, path: str, tag: str) -> DataFrame:
    """file, doc_nr (from 0 in the file), start_line (from 1), n_lines, meta, body of every block `<tag ...>`.  A split's blocks are counted
    by the task that reads it, so no text moves; a split learns of those before it by one row per split."""
    opening = f"<{tag} "

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, docs, lines = None, 0, 0  # of the split so far
        for batch in batches:
            value, before = batch.column("value"), []
            places = zip(*[batch.column(c).to_pylist() for c in ("file", "split")])
            for place, n, opens in zip(places, pc.count_substring(value, "\n").to_pylist(), pc.starts_with(value, opening).to_pylist()):
                first = place != here and place[1] == 0  # of its file
                here, docs, lines = place, *((docs, lines) if place == here else (0, 0))
                is_doc = opens or not first
                before.append((first, int(is_doc), n + 1, docs, lines))
                docs, lines = docs + is_doc, lines + n + 1
            more = [pa.array(c, kind) for c, kind in zip(zip(*before), [pa.bool_(), *[pa.int64()] * 4])] if before else [pa.array([], kind) for kind in [pa.bool_(), *[pa.int64()] * 4]]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, "first", "is_doc", "lines", "docs_before", "lines_before"])

    rows = _records(spark, path, f"\n{opening}").select("file", "split", "value").mapInArrow(run, "file string, split long, value string, first boolean, is_doc long, lines long, docs_before long, lines_before long")
    over_splits = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("file", "split").agg(F.sum("is_doc").alias("d"), F.sum("lines").alias("l"))  # one row per split
    bases = sums.select("file", "split", F.coalesce(F.sum("d").over(over_splits), F.lit(0)).alias("base_docs"), F.coalesce(F.sum("l").over(over_splits), F.lit(0)).alias("base_lines"))
    text = F.when(F.col("first"), F.substr("value", F.lit(len(opening) + 1))).otherwise(F.col("value"))
    # a left join, so that Spark leaves it out where neither number is asked for
    kept = rows.where("is_doc = 1").join(F.broadcast(bases), ["file", "split"], "left").withColumn("text", text).withColumn("head", F.substring_index("text", "\n", 1))
    body = F.substr("text", F.length("head") + 2)
    return kept.select("file", (F.col("base_docs") + F.col("docs_before")).alias("doc_nr"), (F.col("base_lines") + F.col("lines_before") + 1).alias("start_line"), F.col("lines").alias("n_lines"), attributes(F.col("head")).alias("meta"), body.alias("body"))


def line_kind(line: Column, sentence: str = "s", glue: str = "<g/>") -> Column:
    """Opening and closing tags of paragraphs and sentences, glue, other tags, tokens; null for anything else."""
    bare = F.rtrim(line)
    tag = lambda name: rf"^<{name}( [^<>]+)?>$"
    return (
        F.when(bare.rlike(tag("p")), "<p>").when(bare == "</p>", "</p>").when(bare.rlike(tag(sentence)), "<s>").when(bare == f"</{sentence}>", "</s>")
        .when(bare == glue, "<g/>").when(bare.rlike("^<[^<>]+>$"), "<tag>").when(line.contains("\t"), "token")
    )


def lines(found: DataFrame, key: list[str], sentence: str = "s", glue: str = "<g/>") -> DataFrame:
    """key, pos, line, kind of every line of the blocks' bodies."""
    split = found.select(*key, F.posexplode(F.split("body", "\n")).alias("pos", "line"))
    return split.withColumn("kind", line_kind(F.col("line"), sentence, glue))


def tokens(found: DataFrame, key: list[str], sentence: str = "s", glue: str = "<g/>") -> DataFrame:
    """Tokens between sentence tags: key, par, sent (from 1 in the document), word (from 1 in the sentence), pos, token,
    n_features, glued (no space before it), line.  Blocks are dealt to tasks by key before their lines are taken apart, so lines don't
    move."""
    found = found.select(*key, "body").repartition(max(int(found.sparkSession.conf.get("spark.sql.shuffle.partitions")), PARTS * found.rdd.getNumPartitions()), *key)
    order = Window.partitionBy(*key).orderBy("pos")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    count = lambda kind: F.sum((F.col("kind") == kind).cast("int")).over(so_far)
    marks = lines(found, key, sentence, glue).where("kind is not null")
    marks = marks.withColumn("sent", count("<s>")).withColumn("par", count("<p>"))
    marks = marks.withColumn("inside", F.last(F.when(F.col("kind").isin("<s>", "</s>"), F.col("kind")), ignorenulls=True).over(so_far))
    marks = marks.withColumn("glued", F.coalesce(F.lag("kind").over(order) == "<g/>", F.lit(False)))
    kept = marks.where("kind = 'token' and inside = '<s>'")
    features = F.split("line", "\t")
    word = F.row_number().over(Window.partitionBy(*key, "sent").orderBy("pos"))
    return kept.select(*key, "par", "sent", word.alias("word"), "pos", F.element_at(features, 1).alias("token"), F.size(features).alias("n_features"), "glued", "line")


def _tokens_in(body: str, sentence: str, glue: str) -> Iterator[tuple]:
    """par, sent, word, pos, glued, line of a block's tokens, as `tokens` finds them by expressions."""
    tail = "[\r\x85\u2028\u2029]?\\Z"  # Java's $ stands before a last line end too
    tag = lambda name: re.compile(rf"<{name}( [^<>]+)?>{tail}").match
    is_p, is_s, is_tag = tag("p"), tag(re.escape(sentence)), re.compile(f"<[^<>]+>{tail}").match
    par = sent = word = 0
    inside = after_glue = False
    for pos, line in enumerate(body.split("\n")):
        bare = line.rstrip(" ")
        marks = line.startswith("<")
        if marks and is_p(bare):
            par += 1
        elif marks and bare == "</p>":
            pass
        elif marks and is_s(bare):
            sent, word, inside = sent + 1, 0, True
        elif marks and bare == f"</{sentence}>":
            inside = False
        elif bare == glue:
            after_glue = True
            continue
        elif marks and is_tag(bare):
            pass
        elif "\t" not in line:
            continue
        elif inside:
            word += 1
            yield par, sent, word, pos, after_glue, line
        after_glue = False


def in_blocks(found: DataFrame, key: list[str], shown: Callable[[list[tuple]], tuple], schema: str, sentence: str = "s", glue: str = "<g/>") -> DataFrame:
    """key and what `shown` makes of the list of a block's tokens (par, sent, word, pos, glued, line), as columns of `schema`; one row per
    block.  Lines are read where the block is, and no rows move."""
    types = StructType.fromDDL(schema)
    own = StructType([found.select(*key).schema[k] for k in key] + types.fields)
    kinds = to_arrow_schema(types)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), BLOCKS_AT_ONCE):
                part = batch.slice(a, BLOCKS_AT_ONCE)
                made = [shown(list(_tokens_in(body or "", sentence, glue))) for body in part.column("body").to_pylist()]
                yield pa.RecordBatch.from_arrays([*[part.column(k) for k in key], *[pa.array(c, f.type) for c, f in zip(zip(*made), kinds)]], names=[*key, *kinds.names])

    return found.select(*key, "body").mapInArrow(run, own)


def feature_columns(found: DataFrame, key: list[str], width: int, sentence: str = "s", glue: str = "<g/>") -> DataFrame:
    """key, runs: the tokens' features, `FEATURE_RUN` tokens at a time, as `width` texts each: the first of all their features, their
    second and so on, a line to a token.  Features of a kind pack better than whole lines where rows are moved.  A token of more
    or fewer features is an error."""

    def shown(found: list[tuple]) -> tuple:
        features = [x[-1].split("\t") for x in found]
        if any(len(x) != width for x in features):
            raise ValueError(f"a token line without {width} features")
        return ([["\n".join(c) for c in zip(*features[a : a + FEATURE_RUN])] for a in range(0, len(features), FEATURE_RUN)],)

    return in_blocks(found, key, shown, "runs array<array<string>>", sentence, glue)


def feature_lists(runs: Column, width: int) -> Column:
    """Those features again, a list of `width` texts for each token."""
    return F.flatten(F.transform(runs, lambda r: F.transform(F.arrays_zip(*[F.split(F.get(r, F.lit(k)), "\n") for k in range(width)]), lambda x: F.array(*[x[str(k)] for k in range(width)]))))


def sentence_lists(found: DataFrame, key: list[str], sentence: str = "s", glue: str = "<g/>") -> DataFrame:
    """key, sentences: of each sentence with tokens its number sent (from 1) and its tokens."""

    def shown(found: list[tuple]) -> tuple:
        out: dict[int, list[str]] = {}
        for x in found:
            out.setdefault(x[1], []).append(x[-1].partition("\t")[0])
        return ([{"sent": k, "tokens": v} for k, v in out.items()],)

    return in_blocks(found, key, shown, "sentences array<struct<sent: long, tokens: array<string>>>", sentence, glue)


def plain_number(token: Column) -> Column:
    """Digits written in groups lose their inner spaces."""
    return F.when(token.rlike(r"^\d[\d ]*$"), F.replace(token, F.lit(" "), F.lit(""))).otherwise(token)


def sentence_texts(words: DataFrame, key: list[str]) -> DataFrame:
    """key, sent, text: tokens joined by spaces, but for glued ones."""
    piece = F.concat(F.when(F.col("glued") | (F.col("word") == 1), "").otherwise(" "), F.col("token"))
    joined = F.array_sort(F.collect_list(F.struct("word", piece.alias("piece"))))
    return words.groupBy(*key, "sent").agg(F.array_join(F.transform(joined, lambda x: x["piece"]), "").alias("text"))


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def paragraphs(found: DataFrame, key: list[str]) -> DataFrame:
    """key, web_domain, par (from 1), meta of the paragraph, text: paragraphs of prevert blocks that are not blank.
    A block without web_domain is an error."""
    pattern = r"(?s)<p([^<>]*)>(.*?)</p>"
    heads, texts = (F.regexp_extract_all("body", F.lit(pattern), F.lit(k)) for k in (1, 2))
    domain = F.coalesce(F.col("meta")["web_domain"], F.raise_error(F.lit("block without web_domain")).cast("string"))
    split = found.select(*key, domain.alias("web_domain"), F.posexplode(F.arrays_zip(heads.alias("head"), texts.alias("text"))).alias("nth", "p"))
    split = split.where(F.col("p.text").rlike(r"\S")).withColumn("par", F.row_number().over(Window.partitionBy(*key).orderBy("nth")))
    return split.select(*key, "web_domain", "par", attributes(F.col("p.head")).alias("meta"), unescaped(F.col("p.text")).alias("text"))


def text_types(found: DataFrame) -> DataFrame:
    """id and texttype of every block's tag."""
    return found.select(F.col("meta")["id"].alias("id"), F.col("meta")["texttype"].alias("texttype")).where("id is not null")


def covered(types: DataFrame, wanted: DataFrame) -> DataFrame:
    """types: id, texttype; wanted: id.  The type of each wanted id; one that has none is an error."""
    there = types.groupBy("id").agg(F.first("texttype").alias("texttype"), F.lit(True).alias("there"))
    said = F.concat(F.lit("no text type for "), F.col("id"))
    met = wanted.select("id").distinct().join(there, "id", "left")
    return met.where(F.assert_true(F.col("there").isNotNull(), said).isNull()).select("id", "texttype")


TEI_SCHEMA = "_id string, _src string, p array<struct<s: array<string>>>"
TEI_WORDS_SCHEMA = "_id string, _src string, p array<struct<s: array<struct<w: array<string>>>>>"


def tei_text(p: Column, sentence_break: str, of_words: bool) -> Column:
    """The text of a division's paragraphs: words joined by a space, sentences by sentence_break, paragraphs by a blank line."""
    sentences = lambda x: F.transform(x["s"], lambda s: F.array_join(s["w"], " ")) if of_words else x["s"]
    full = F.transform(p, lambda x: F.array_join(F.filter(sentences(x), lambda s: F.trim(s) != ""), sentence_break))
    return F.coalesce(F.array_join(F.filter(full, lambda x: x != ""), "\n\n"), F.lit(""))


def tei_texts(spark: SparkSession, path: str, div: str = "div1", sentence_break: str = "\n", keep_empty: bool = True, of_words: bool = False) -> DataFrame:
    """id, src, text of every `div` of the files: sentences are plain text, or lists of <w> elements if of_words."""
    raw = spark.read.format("xml").option("rowTag", div).schema(TEI_WORDS_SCHEMA if of_words else TEI_SCHEMA).load(path)
    out = raw.select(F.col("_id").alias("id"), F.col("_src").alias("src"), tei_text(F.col("p"), sentence_break, of_words).alias("text"))
    return out if keep_empty else out.where("text <> ''")


def tei_members(members: DataFrame, div: str = "div1", sentence_break: str = "\n", keep_empty: bool = True, of_words: bool = False) -> DataFrame:
    """The same of XML texts (archive, member, content) that archives hold: archive, member, id, src, text."""
    inner = (TEI_WORDS_SCHEMA if of_words else TEI_SCHEMA).replace(" string", ": string").replace("p array", "p: array")
    parsed = members.select("archive", "member", F.from_xml("content", f"`{div}` array<struct<{inner}>>").alias("x"))
    raw = parsed.select("archive", "member", F.explode(f"x.{div}").alias("d")).select("archive", "member", "d.*")
    out = raw.select("archive", "member", F.col("_id").alias("id"), F.col("_src").alias("src"), tei_text(F.col("p"), sentence_break, of_words).alias("text"))
    return out if keep_empty else out.where("text <> ''")


PACKED = "archive string, nth long, at long, member string, kind string, crc long, size long, raw binary"
SHARE = 4 << 20  # bytes of an archive that go to one place


def listed_members(files: DataFrame, ending: str = ".xml", focus: list[str] | None = None) -> DataFrame:
    """files: path, content (bytes of .zip and .tar archives).  archive, nth, at (bytes before it), member, kind (stored, deflate,
    bzip2), crc (null if not known), size, raw (the member's bytes as they lie in the archive).  A zip's directory and a plain tar's
    headers say where each member lies, so none is unpacked here; a compressed tar is one stream and is unpacked as it is read."""
    wanted = set(focus) if focus is not None else None
    kinds = {zipfile.ZIP_STORED: "stored", zipfile.ZIP_DEFLATED: "deflate", zipfile.ZIP_BZIP2: "bzip2"}

    def chosen(name: str) -> bool:
        return name.endswith(ending) and (wanted is None or name.rpartition("/")[2] in wanted)

    def in_zip(raw: bytes) -> Iterator[tuple]:
        with zipfile.ZipFile(io.BytesIO(raw)) as z:
            for m in z.infolist():
                if chosen(m.filename):
                    if m.flag_bits & 1 or m.compress_type not in kinds:
                        raise ValueError(f"member {m.filename} is encrypted or of a kind that is not read")
                    name, extra = struct.unpack_from("<HH", raw, m.header_offset + 26)  # lengths in the member's own header
                    at = m.header_offset + 30 + name + extra
                    yield at, m.filename, kinds[m.compress_type], m.CRC, m.file_size, raw[at : at + m.compress_size]

    def in_tar(raw: bytes) -> Iterator[tuple]:
        with tarfile.open(fileobj=io.BytesIO(raw), mode="r:*") as t:
            for m in t:
                if m.isfile() and chosen(m.name):
                    yield m.offset_data, m.name, "stored", None, m.size, t.extractfile(m).read()

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, raw in zip(*[batch.column(c).to_pylist() for c in ("path", "content")]):
                for nth, m in enumerate((in_zip if name.endswith(".zip") else in_tar)(raw)):
                    yield pa.RecordBatch.from_pylist([dict(zip(names, (name, nth, *m)))], schema=schema)

    schema = pa.schema([("archive", pa.string()), ("nth", pa.int64()), ("at", pa.int64()), ("member", pa.string()), ("kind", pa.string()), ("crc", pa.int64()), ("size", pa.int64()), ("raw", pa.binary())])
    names = schema.names
    return files.select("path", "content").mapInArrow(members, PACKED)


def members_of(files: DataFrame, ending: str = ".xml", focus: list[str] | None = None) -> DataFrame:
    """archive, member, content (text) of the files in archives (path, content); `focus` keeps members of these names.  The listing pass
    reads an archive once; its members are then dealt to tasks by ranges of `SHARE` bytes, and unpacked, checked and decoded there,
    so one large archive keeps many tasks busy.  A member whose size or checksum is wrong is an error."""

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, member, kind, crc, size, raw in zip(*[batch.column(c).to_pylist() for c in ("archive", "member", "kind", "crc", "size", "raw")]):
                plain = zlib.decompress(raw, -15) if kind == "deflate" else bz2.decompress(raw) if kind == "bzip2" else raw
                if len(plain) != size or crc is not None and zlib.crc32(plain) != crc:
                    raise ValueError(f"member {member} of {archive} is damaged")
                yield pa.RecordBatch.from_pydict({"archive": [archive], "member": [member], "content": [plain.decode()]})

    places = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # unpacking is work, so small shares are not put together
    dealt = listed_members(files, ending, focus).withColumn("share", F.floor(F.col("at") / SHARE)).repartition(places, "archive", "share")
    return dealt.drop("share").mapInArrow(unpacked, "archive string, member string, content string")


def archive_members(spark: SparkSession, path: str, ending: str = ".xml", focus: list[str] | None = None) -> DataFrame:
    """The members of the archives in a folder."""
    return members_of(spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path), ending, focus)


def _folders(spark: SparkSession, root: str) -> str:
    """What to list for all files below a folder: a pattern of the folders two levels down, or the folder itself if files lie above those."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    own = [x for x in fs.listStatus(path(root)) if not x.getPath().getName().startswith(("_", "."))]
    return f"{root}/*/*" if all(x.isDirectory() for x in own) and fs.globStatus(path(f"{root}/*/*")) else root


def json_documents(spark: SparkSession, root: str, schema: str, name: str = "doc*.json") -> DataFrame:
    """Documents kept one to a file below <collection>/<file>/<group>/<id>/ (or such folders written name=value): schema, and id and name from the path.  Rows are in
    no order; their numeric path_id gives it.  One job lists all, a task to a group or more: Spark would start a job for each group and a
    task for each document's folder."""
    threshold = "spark.sql.sources.parallelPartitionDiscovery.threshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "0")  # folders are listed as soon as the frame is made
    try:
        raw = spark.read.schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", name).option("multiLine", "true").json(_folders(spark, root))
    finally:
        spark.conf.set(threshold, before)
    place = F.col("_metadata.file_path")
    return raw.select("*", F.regexp_extract(place, r"/(?:[^/=]+=)?(\d+)/[^/]+$", 1).try_cast("long").alias("path_id"), F.regexp_extract(place, r"([^/]+)$", 1).alias("path_name"))


def index_rows(spark: SparkSession, path: str, schema: str, separator: str = "|||", header: bool = False) -> DataFrame:
    return spark.read.schema(schema).option("sep", separator).option("header", header).option("quote", "").csv(path)


def log_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Blocks of an error log: file, nth, err_type, err_nr, judgement, text_id (the last one named before), lines.
    A block's head `type::n [judgement]` stands between two separator lines.  What a split needs of others (the text named
    last, the lines after its last head, heads before it) comes from one row per split."""
    head, named, noise = r"^\s*([^:\n]+)::(\d+)\s*(\S*)\s*$", r"(?s)\A.*\(!\) \w+ in text with id (\d+)", r"^\s*(INFO:|\(!\) \w+ in text with id |>\s*')"
    inside, so_far = Window.partitionBy("file", "split").orderBy("at"), lambda w: w.rowsBetween(Window.unboundedPreceding, 0)
    rows = _records(spark, path, f"\n{LOG_SEPARATOR}\n").withColumn("named", F.when(F.col("value").rlike(named), F.regexp_extract("value", named, 1)))
    rows = rows.withColumn("is_head", F.col("value").rlike(head).cast("long"))
    splits = rows.groupBy("file", "split").agg(F.max_by("named", F.when(F.col("named").isNotNull(), F.col("at"))).alias("named"), F.min_by("value", "at").alias("first"), F.sum("is_head").alias("heads"))
    over = Window.partitionBy("file").orderBy("split")
    before = over.rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("file", "split", F.last("named", ignorenulls=True).over(before).alias("named_before"), F.lead("first").over(over).alias("first_after"), F.coalesce(F.sum("heads").over(before), F.lit(0)).alias("heads_before"))
    rows = rows.withColumn("own", F.last("named", ignorenulls=True).over(so_far(inside))).withColumn("next", F.lead("value").over(inside)).withColumn("own_nth", F.sum("is_head").over(so_far(inside)))
    rows = rows.where("is_head = 1").join(splits, ["file", "split"])
    kept = F.filter(F.split(F.coalesce("next", "first_after", F.lit("")), "\n"), lambda x: (F.trim(x) != "") & ~x.rlike(noise))
    return rows.select("file", (F.col("heads_before") + F.col("own_nth")).alias("nth"), F.regexp_extract("value", head, 1).alias("err_type"), F.regexp_extract("value", head, 2).cast("long").alias("err_nr"), F.regexp_extract("value", head, 3).alias("judgement"), F.coalesce("own", "named_before").cast("long").alias("text_id"), kept.alias("lines"))


def multiword_tokens(tokens: DataFrame) -> DataFrame:
    """Tokens with inner spaces that are no numbers, with how often they occur."""
    return tokens.where(F.col("token").contains(" ") & ~F.col("token").rlike(r"^\d[\d ]*$")).groupBy("token").agg(F.count("*").alias("n"))


def write_lines(rows: DataFrame, folder: str, order: list[str], by: str | None = None) -> None:
    """Write the text in `value` in the given order, one folder per value of `by`.  A hot category takes several files."""
    keys = ([by] if by else []) + order
    dealt = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select(*([by] if by else []), "value")
    (dealt.write.partitionBy(by) if by else dealt.write).text(folder)


def write_blocks(rows: DataFrame, folder: str, value: Column, order: list[str], by: str) -> None:
    """Write a text made of each row (`value`), one folder per value of `by`, in packed files that are each in the given order.  Rows are
    sorted and marked up by the tasks that read them, and don't move; a task writes a file per value of `by` that it has."""
    rows.sortWithinPartitions(by, *order).select(by, value.alias("value")).write.partitionBy(by).option("compression", "gzip").text(folder)


def padded_features(line: Column, width: int) -> Column:
    """A line's features, cut or filled with empty ones to `width`."""
    items = F.split(line, "\t")
    return F.slice(F.concat(items, F.array_repeat(F.lit(""), width)), 1, width)


def syntax_line(line: Column, own: list[Column], head: list[Column], width: int = 13) -> Column:
    """A token line with its own syntax and its head's (empty for the root): `width` features and both lists."""
    more = [F.coalesce(c.cast("string"), F.lit("")) for c in own + head]
    return F.replace(F.array_join(F.concat(padded_features(line, width), F.array(*more)), "\t"), F.lit("\n"), F.lit(" "))
