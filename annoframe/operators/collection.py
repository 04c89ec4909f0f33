"""Collections: base, metadata and hash tables, row selection, statuses, ids, splits."""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Source names whose year suffix is dropped.
YEARED_SOURCES = ("Balanced Corpus", "Reference Corpus", "Literature Contemporary", "Literature Old", "Academic", "Feeds", "Wikipedia")
GROUP_ROWS = 30_000


def texts(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").alias("text_id"), "text", "lang", "source")


def normalize_src(src: Column) -> Column:
    out = src
    for name in YEARED_SOURCES:
        out = F.when(src.startswith(name), name).otherwise(out)
    return out


def doc_group(doc_id: Column) -> Column:
    return F.floor(doc_id / GROUP_ROWS)


def metadata(t: DataFrame) -> DataFrame:
    return t.select("text_id", F.create_map(F.lit("src"), F.col("source"), F.lit("lang"), F.col("lang"), F.lit("id"), F.col("text_id").cast("string")).alias("meta"))


def metadata_table(meta: DataFrame, keys: list[str], rename: dict[str, str]) -> DataFrame:
    """One text column per key, under its new name."""
    return meta.select("text_id", *[F.col("meta")[k].alias(rename.get(k, k)) for k in keys])


#: Names that metadata fields may not have.
RESERVED = ("id", "text_id", "initial_id", "initial_src")


def metadata_names(fields: list[str], reserved: tuple = RESERVED, keep_id: bool = True, rename_src: bool = True, merge_numbered: bool = True) -> dict[str, str]:
    """Column name of each metadata field: id becomes initial_id (or goes), src initial_src; a numbered field goes if the
    name without its number is a field too; other fields must not have reserved names."""
    out = {}
    for field in fields:
        bare = field.rstrip("0123456789")
        if field == "id":
            if keep_id:
                out[field] = "initial_id"
        elif field == "src":
            out[field] = "initial_src" if rename_src else field
        elif field in reserved:
            raise ValueError(f"metadata field has a reserved name: {field}")
        elif not (merge_numbered and bare and bare != field and bare in fields):
            out[field] = field
    return out


def discovered_metadata(meta: DataFrame, most: int = 5_000, **rules) -> DataFrame:
    """meta: text_id, meta (map).  One text column per field that occurs, in order of name.  More than `most` fields are an
    error, as a table needs them as columns."""
    found = meta.select(F.explode(F.map_keys("meta")).alias("field")).distinct().orderBy("field").limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"more than {most} metadata fields")
    return metadata_table(meta, list(names := metadata_names([r.field for r in found], **rules)), names)


def field_registry(meta: DataFrame, by: str, earlier: DataFrame | None = None) -> DataFrame:
    """meta: by, text_id, meta.  Per category its fields (those that begin with _ are internal and left out) in the order in
    which they are first seen: by, field, nth (from 1), first_text, n.  earlier: by, field, nth of a list made before, whose
    fields come first; first_text is null for fields that only it has."""
    each = meta.select(by, "text_id", F.posexplode(F.map_keys("meta")).alias("pos", "field")).where(~F.col("field").startswith("_"))
    found = each.groupBy(by, "field").agg(F.min(F.struct("text_id", "pos")).alias("first"), F.count("*").alias("n"))
    before = F.lit(None).cast("int")
    if earlier is not None:
        found = found.join(earlier.select(by, "field", F.col("nth").alias("old")), [by, "field"], "full")
        before = F.col("old")
    order = Window.partitionBy(by).orderBy(before.asc_nulls_last(), "first", "field")  # fields of a category
    return found.select(by, "field", F.row_number().over(order).alias("nth"), F.col("first.text_id").alias("first_text"), F.coalesce("n", F.lit(0)).alias("n"))


def field_commonness(registry: DataFrame, by: str) -> DataFrame:
    """In how many categories each field occurs, and in what share of them, in per cent."""
    total = registry.agg(F.count_distinct(by).alias("total"))
    n = registry.groupBy("field").agg(F.count_distinct(by).alias("n")).crossJoin(F.broadcast(total))  # one row
    return n.select("field", "n", F.round(F.col("n") / F.col("total") * 100, 4).alias("pct"))


def block(rows: DataFrame, key: str, divisor: int, remainder: int) -> DataFrame:
    if not 0 <= remainder < divisor:
        raise ValueError("remainder must be below divisor")
    return rows.where(F.pmod(F.col(key), F.lit(divisor)) == remainder)


def chosen(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return rows.join(keys.select(key), key, "left_semi")


def unknown_keys(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return keys.join(rows.select(key), key, "left_anti").select(key)


def without_layer(rows: DataFrame, layer: DataFrame) -> DataFrame:
    return rows.join(layer.select("text_id"), "text_id", "left_anti")


def insert_status(rows: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """text_id and a flag per table: whether the text has a row there; `complete` if it has in all."""
    out = rows.select("text_id")
    for name, table in tables.items():
        out = out.join(table.select("text_id").distinct().withColumn(name, F.lit(True)), "text_id", "left")
    flags = [F.coalesce(F.col(n), F.lit(False)) for n in tables]
    complete = flags[0]
    for f in flags[1:]:
        complete = complete & f
    return out.select("text_id", *[f.alias(n) for f, n in zip(flags, tables)], complete.alias("complete"))


def first_and_last(rows: DataFrame, by: str, key: str, n: int) -> DataFrame:
    """The first and the last n rows of each category: adds nth and from_end (both from 1).  Each end is limited before rows
    are gathered, so no task sees a whole category."""
    total = rows.groupBy(by).agg(F.count("*").alias("total"))

    def end(order, own: str, other: str) -> DataFrame:
        few = rows.withColumn(own, F.row_number().over(Window.partitionBy(by).orderBy(order))).where(F.col(own) <= n)
        return few.join(total, by).withColumn(other, F.col("total") - F.col(own) + 1)

    first, last = end(F.col(key), "nth", "from_end"), end(F.desc(key), "from_end", "nth").where(F.col("nth") > n)
    columns = [*rows.columns, "nth", "from_end"]
    return first.select(*columns).union(last.select(*columns))


def numbered(rows: DataFrame, by: str, key: str, block: str) -> DataFrame:
    """Adds nth, the place (from 1) of a row in its category in order of the key.  `block`, a column that never falls as the
    key rises, deals a category to tasks: rows are counted by block and numbered inside it."""
    sizes = rows.groupBy(by, block).agg(F.count("*").alias("n"))
    base = sizes.select(F.col(by).alias("b_by"), F.col(block).alias("b_block"), F.coalesce(F.sum("n").over(Window.partitionBy(by).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    inside = F.row_number().over(Window.partitionBy(by, block).orderBy(key))
    met = rows.withColumn("inside", inside).join(base, F.col(by).eqNullSafe(F.col("b_by")) & F.col(block).eqNullSafe(F.col("b_block")))
    return met.select(*rows.columns, (F.col("base") + F.col("inside")).alias("nth"))


def global_ids(rows: DataFrame, file: str, key: str, block: str | None = None) -> DataFrame:
    """Dense ids from 0 over files in order, then keys: counts per file, their running sum, and a number inside the file.
    With `block`, a column that never falls as the key rises, a large file is counted and numbered block by block."""
    cell = [file, block] if block else [file]
    sizes = rows.groupBy(*cell).agg(F.count("*").alias("n"))
    base = sizes.select(*cell, F.coalesce(F.sum("n").over(Window.orderBy(*cell).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    inside = F.row_number().over(Window.partitionBy(*cell).orderBy(key)) - 1
    return rows.withColumn("inside", inside).join(base, cell).withColumn("global_id", F.col("base") + F.col("inside")).drop("inside", "base")


def first_ids(counts: DataFrame, file: str, key: str, block: Column) -> DataFrame:
    """counts: file, key (once each), n.  Adds first_id: the first of the n dense ids that `global_ids` gives a key's rows, so that only
    counts move and the rows themselves are numbered where they are.  `block` never falls as the key rises."""
    cell = [file, "block"]
    rows = counts.withColumn("block", block)
    sizes = rows.groupBy(*cell).agg(F.sum("n").alias("of_block"))  # one row per block
    before = Window.orderBy(*cell).rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select(*cell, F.coalesce(F.sum("of_block").over(before), F.lit(0)).alias("base"))
    inside = F.coalesce(F.sum("n").over(Window.partitionBy(*cell).orderBy(key).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.withColumn("inside", inside).join(base, cell).select(*counts.columns, (F.col("base") + F.col("inside")).alias("first_id"))


def chunk_key(file: Column, doc: Column, par: Column | None = None, sent: Column | None = None) -> Column:
    """file:doc[:par[:sent]], the key of what a row was made from; parts that are null are left out."""
    return F.concat_ws(":", file, *[c.cast("string") for c in (doc, par, sent) if c is not None])


def with_metadata(parts: DataFrame, meta: DataFrame, minimal: list[str] | None = None) -> DataFrame:
    """Parts of documents with their document's metadata (text_id, meta): all of it, or the fields of a minimal list."""
    own = F.col("meta") if minimal is None else F.map_filter("meta", lambda k, _: k.isin(*minimal))
    return parts.join(meta.select("text_id", own.alias("meta")), "text_id", "left")


def append_missing(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """New rows whose key the old table lacks."""
    return new.join(old.select(*key), key, "left_anti")


def duplicate_keys(rows: DataFrame, key: list[str]) -> DataFrame:
    return rows.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def unique(rows: DataFrame, key: list[str]) -> DataFrame:
    """The same rows; reading one whose key is not its own fails."""
    said = F.concat(F.lit("key occurs twice: "), F.concat_ws(", ", *key))
    return rows.withColumn("own_n", F.count("*").over(Window.partitionBy(*key))).where(F.assert_true(F.col("own_n") == 1, said).isNull()).drop("own_n")


def appended(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Continue a table: the new rows whose key it lacks.  A key that is twice among those is an error."""
    return unique(append_missing(old, new, key), key)


def inserted(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Insert all new rows: a key that the table has, or that is twice among the new rows, is an error."""
    there = old.select(*key).distinct().withColumn("there", F.lit(True))
    said = F.concat(F.lit("key is there already: "), F.concat_ws(", ", *key))
    met = unique(new, key).join(there, key, "left")
    return met.where(F.assert_true(F.col("there").isNull(), said).isNull()).select(*new.columns)


def human_size(n: Column) -> Column:
    """Bytes as B, KB or MB with one digit."""
    return F.when(n < 1024, F.format_string("%.1f B", n.cast("double"))).when(n < 1 << 20, F.format_string("%.1f KB", n / 1024)).otherwise(F.format_string("%.1f MB", n / (1 << 20)))


def exact_copies(t: DataFrame, by: str) -> DataFrame:
    """Groups of equal texts within a category, with the least id and whether their languages differ."""
    g = t.groupBy(by, F.md5("text").alias("hash")).agg(F.min("text_id").alias("first_id"), F.count("*").alias("n"), (F.count_distinct("lang") > 1).alias("meta_differs"))
    return g.where("n > 1")


def carried(source: DataFrame, target: DataFrame, layer: DataFrame) -> DataFrame:
    """Spans of source texts for the target texts with the same file and text, first match."""
    key = source.groupBy("source", F.md5("text").alias("hash")).agg(F.min("text_id").alias("from_id"))
    met = target.select("text_id", "source", F.md5("text").alias("hash")).join(key, ["source", "hash"]).select(F.col("text_id").alias("to_id"), "from_id")
    return met.join(layer, met["from_id"] == layer["text_id"]).select(F.col("to_id").alias("text_id"), "from_id", "start", "end", "label")


def _candidates(t: DataFrame, title: str | None) -> tuple[DataFrame, DataFrame]:
    """Texts with their key (file, first 20 characters of the title, first ten of the text; -- for what is null), and the pairs
    of a text with the first of its key."""
    part = lambda c, n: F.coalesce(F.substring(c, 1, n), F.lit("--"))
    key = F.concat_ws("||", F.coalesce("source", F.lit("--")), part(title, 20) if title else F.lit("--"), F.substring("text", 1, 10))
    k = t.where("text is not null").select("text_id", key.alias("key"), "text")
    first = k.groupBy("key").agg(F.min("text_id").alias("first_id"))
    return k, k.join(first, "key").where("text_id > first_id")


def _graded(rows: DataFrame) -> DataFrame:
    out = rows.select("text_id", "first_id", "ratio").where("ratio >= 0.1")
    return out.withColumn("class", F.when(F.col("ratio") == 1, "exact").when(F.col("ratio") < 0.7, "far").otherwise("near"))


def near_copies(t: DataFrame, title: str | None = None) -> DataFrame:
    """Texts that share file, start of title and first ten characters with an earlier text, the first of the key: shared lines
    over all lines of the two wherever they stand, near from 0.7, far from 0.1, exact at 1.  A cheap bound of `near_copies_in_order`."""
    k, met = _candidates(t, title)
    pairs = met.select("text_id", "first_id")
    lines = k.select("text_id", F.explode(F.split("text", "\n")).alias("line")).groupBy("text_id", "line").agg(F.count("*").alias("n"))
    sizes = lines.groupBy("text_id").agg(F.sum("n").alias("size"))
    a = pairs.join(lines, "text_id").select("text_id", "first_id", "line", F.col("n").alias("n_a"))
    b = lines.select(F.col("text_id").alias("first_id"), "line", F.col("n").alias("n_b"))
    shared = a.join(b, ["first_id", "line"]).groupBy("text_id", "first_id").agg(F.sum(F.least("n_a", "n_b")).alias("shared"))
    s = shared.join(sizes, "text_id").join(sizes.select(F.col("text_id").alias("first_id"), F.col("size").alias("first_size")), "first_id")
    return _graded(s.withColumn("ratio", F.round(F.col("shared") / (F.col("size") + F.col("first_size") - F.col("shared")), 2)))


def lines_in_order(a: str, b: str) -> tuple[int, int]:
    """Lines of two texts that a line diff leaves as they are, and those and all that it removes or adds.  A moved line is one
    removed and one added; lines keep their ends, so a last line without one differs from one with it."""
    x, y = a.splitlines(keepends=True), b.splitlines(keepends=True)
    equal = sum(m.size for m in SequenceMatcher(None, x, y, autojunk=False).get_matching_blocks())
    return equal, len(x) + len(y) - equal


def near_copies_in_order(t: DataFrame, title: str | None = None) -> DataFrame:
    """The same pairs by a line diff that keeps the order of lines: equal lines over equal and differing ones.  Pairs meet in a
    join by the first text, whose copies Spark splits among tasks, and are compared in Arrow batches.  Two empty texts are exact."""
    k, met = _candidates(t, title)
    pairs = met.select("text_id", "first_id", "text").join(k.select(F.col("text_id").alias("first_id"), F.col("text").alias("first_text")), "first_id")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ratios = []
            for own, first in zip(batch.column("text").to_pylist(), batch.column("first_text").to_pylist()):
                equal, total = lines_in_order(first, own)
                ratios.append(round(equal / total, 2) if total else 1.0)
            yield pa.RecordBatch.from_arrays([batch.column("text_id"), batch.column("first_id"), pa.array(ratios, pa.float64())], names=["text_id", "first_id", "ratio"])

    return _graded(pairs.select("text_id", "first_id", "text", "first_text").mapInArrow(compared, "text_id long, first_id long, ratio double"))


def carried_by_place(pairs: DataFrame, source_words: DataFrame, target_words: DataFrame, attributes: list[str]) -> DataFrame:
    """Attributes of source words for target words in the same place.  pairs: text_id, from_id (a text and the one that it takes
    from); words: text_id, word_id, start, end (and the attributes).  Texts of unequal numbers of words are an error."""
    n = lambda w, name: w.groupBy("text_id").agg(F.count("*").alias(name))
    counts = pairs.join(n(target_words, "n_own"), "text_id", "left").join(n(source_words, "n_from").withColumnRenamed("text_id", "from_id"), "from_id", "left")
    said = F.concat(F.lit("texts differ in words: "), F.concat_ws(", ", "text_id", "from_id"))
    even = counts.where(F.assert_true(F.coalesce("n_own", F.lit(0)) == F.coalesce("n_from", F.lit(0)), said).isNull()).select("text_id", "from_id")
    given = source_words.select(F.col("text_id").alias("from_id"), "word_id", *attributes)
    return target_words.select("text_id", "word_id", "start", "end").join(even, "text_id").join(given, ["from_id", "word_id"]).select("text_id", "word_id", "start", "end", *attributes)
