"""Joins and shapes of whole records: facts, tasks, rewritten and split documents, matches by shared words, clause classes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Brackets, quotes, and words that a clause may start with.
OPENING, CLOSING = ("(", "["), (")", "]")
START_QUOTES, END_QUOTES = ('"', "'", "«", "“", "”", "ˮ", "̋", "„"), ('"', "'", "»", "“", "”", "ˮ", "̋", "„")
AND_WORDS, BUT_WORDS = ("ja", "ning", "ega", "või"), ("aga", "kuigi")
LINK_WORDS = ("et", "kui", "millal", "kus", "kuhu", "kust", "sest", "kuid", "nagu", "ehkki", "siis", "kuni", "otsekui", "justkui", "kuna", "kuidas", "kas")
LINK_LEMMAS = ("mis", "kes", "milline", "see", "missugune")

MAPPED = 1_000  # rules for facts from one layer, a list made by hand, at most


def facts(layer: DataFrame, name: str, mapping: DataFrame) -> DataFrame:
    """mapping: facts_layer, fact_attr and value_attr (columns of the layer or null), fact_name, value, fact_type.  text_id and
    its facts (start, end, fact_name, value, fact_type): the fact's name is the mapping's or else the attribute's value, its
    value the attribute's or else the mapping's.  More than `MAPPED` rules for a layer are an error."""
    attributes = [c for c in layer.columns if c not in ("text_id", "start", "end")]
    values = F.create_map(*[x for c in attributes for x in (F.lit(c), F.col(c).cast("string"))])
    own = mapping.where(F.col("facts_layer") == name).select("fact_attr", "fact_name", "value_attr", "value", "fact_type").limit(MAPPED + 1).collect()
    if len(own) > MAPPED:
        raise ValueError(f"more than {MAPPED} facts are mapped from layer {name}")
    rules = F.array(*[F.struct(*[F.lit(r[c]).cast("string").alias(c) for c in r.__fields__]) for r in own]) if own else F.array().cast("array<struct<fact_attr:string,fact_name:string,value_attr:string,value:string,fact_type:string>>")
    met = layer.select("text_id", "start", "end", values.alias("a"), F.explode(rules).alias("m")).select("text_id", "start", "end", "a", "m.*")
    told = F.struct("start", "end", F.coalesce("fact_name", F.try_element_at("a", F.col("fact_attr"))).alias("fact_name"), F.coalesce(F.try_element_at("a", F.col("value_attr")), "value").alias("value"), F.col("fact_type").alias("fact_type"))
    return met.select("text_id", told.alias("f")).where("f.fact_name is not null").groupBy("text_id").agg(F.array_sort(F.collect_list("f")).alias("facts"))


def exported(texts: DataFrame, found: DataFrame) -> DataFrame:
    """One JSON text per document: its text, metadata and facts."""
    met = texts.join(found, "text_id", "left")
    return met.select("text_id", F.to_json(F.struct(*[c for c in texts.columns if c != "text_id"], F.coalesce("facts", F.array().cast(found.schema["facts"].dataType)).alias("facts"))).alias("json"))


def tasks(a: DataFrame, b: DataFrame) -> DataFrame:
    """One annotation task per text, with the spans of both versions in order."""
    sides = a.select("text_id", F.lit("a").alias("side"), "start", "end", "label").union(b.select("text_id", F.lit("b").alias("side"), "start", "end", "label"))
    return sides.groupBy("text_id").agg(F.array_sort(F.collect_list(F.struct("start", "end", "side", "label"))).alias("spans"))


def listed_tasks(lists: DataFrame) -> DataFrame:
    """The same tasks of layers that are lists already: text_id, a, b (start, end, label).  No rows move."""
    of = lambda c: F.transform(c, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), F.lit(c).alias("side"), x["label"].alias("label")))
    return lists.select("text_id", F.sort_array(F.concat(of("a"), of("b"))).alias("spans")).where(F.size("spans") > 0)


def write_tasks(rows: DataFrame, folder: str, a_file: int = 1_000, packed: bool = False) -> None:
    """Tasks as JSON, one to a line, at most so many in a file, which is packed if asked."""
    rows.write.option("maxRecordsPerFile", a_file).option("compression", "gzip" if packed else "none").json(folder)


def read_tasks(spark: SparkSession, folder: str) -> DataFrame:
    """Tasks that were written, with the spans that annotators left in them."""
    return spark.read.schema("text_id long, spans array<struct<start:long,end:long,side:string,label:string>>").json(folder)


def split_parts(texts: DataFrame, cuts: DataFrame) -> DataFrame:
    """cuts: text_id, chunk (from 0), start, end.  Parts of texts with more than one: number, file name, text; `_split_document`
    says that a part is one of several."""
    n = cuts.withColumn("n", F.count("*").over(Window.partitionBy("text_id")))
    part = F.col("chunk") + 1
    met = n.join(texts.select("text_id", "text"), "text_id")
    piece = F.substr("text", (F.col("start") + 1).cast("int"), (F.col("end") - F.col("start")).cast("int"))
    return met.select("text_id", F.when(F.col("n") > 1, part).alias("part"), F.when(F.col("n") > 1, F.format_string("doc_%02d.json", part)).otherwise("doc.json").alias("file"), piece.alias("text"), (F.col("n") > 1).alias("_split_document"))


def whole_documents(parts: DataFrame) -> DataFrame:
    """The same rows; reading a part of a split document fails."""
    said = F.concat(F.lit("split document: "), F.col("text_id").cast("string"))
    return parts.where(F.assert_true(~F.col("_split_document"), said).isNull())


def add_layers(tables: dict[str, DataFrame], new: dict[str, DataFrame], only: list[str], update: bool = False) -> dict[str, DataFrame]:
    """Add the listed layers to a collection's tables.  A listed layer that is not given is an error; one that exists is
    kept if `update`, else an error."""
    missing = [n for n in only if n not in new]
    if missing:
        raise ValueError(f"layers not given: {missing}")
    present = [n for n in only if n in tables]
    if present and not update:
        raise ValueError(f"layers exist: {present}")
    return tables | {n: new[n] for n in only if n not in tables}


def morphosyntax(morph: DataFrame, syntax: DataFrame) -> DataFrame:
    """Words of two layers at the same spans; a word that one side lacks is an error."""
    met = morph.join(syntax, ["text_id", "start", "end"], "full")
    ok = F.col("lemma").isNotNull() & F.col("deprel").isNotNull()
    return met.withColumn("deprel", F.when(ok, F.col("deprel")).otherwise(F.raise_error(F.lit("layers differ")).cast("string")))


def clean_metadata(meta: Column, text_id: Column, words: Column, sentences: Column, dropped: str) -> Column:
    """Without the keys that match a pattern; __id, __words and __sentences added."""
    added = F.create_map(F.lit("__id"), text_id.cast("string"), F.lit("__words"), words.cast("string"), F.lit("__sentences"), sentences.cast("string"))
    return F.map_concat(F.map_filter(meta, lambda k, _: ~k.rlike(dropped)), added)


def clause_class(kind: Column, n: Column, has_verb: Column, first: Column, first_lemma: Column, last_lemma: Column) -> Column:
    """kind|verb[|parenthesised][|quoted][|start] of a clause from its first and last words."""
    some, few = n > 0, n > 1
    bracket = F.when(few & first_lemma.isin(*OPENING) & last_lemma.isin(*CLOSING), "|parenthesised").otherwise("")
    quote = F.when(few & first_lemma.isin(*START_QUOTES) & last_lemma.isin(*END_QUOTES), "|quoted").otherwise("")
    word, lemma = F.lower(first), F.lower(first_lemma)
    title = first.rlike(r"^[^\p{L}]*\p{Lu}[^\p{Lu}]*$")
    link = F.when(word.isin(*AND_WORDS), "|ja-ning-ega-või").when(word.isin(*BUT_WORDS), "|aga-kuigi").when(word.isin(*LINK_WORDS), F.concat(F.lit("|"), word)).when(F.replace(lemma, F.lit("mis_sugune"), F.lit("missugune")).isin(*LINK_LEMMAS), F.concat(F.lit("|"), lemma)).otherwise("")
    return F.concat(kind, F.when(has_verb, "|has_verb").otherwise("|no_verb"), bracket, quote, F.when(some & ~title, link).otherwise(""))


def best_overlap(a: DataFrame, b: DataFrame) -> DataFrame:
    """a: a_id, words; b: b_id, words (arrays of distinct words).  For each b, the a that shares most words with it, if any
    and all but two of the smaller set; the least a_id of equals.

    Whatever three words of the smaller set are taken, one of them must be shared, so the three rarest of each set meet the
    sets that are at least as large.  A word's sets are told apart by size before any pair is made."""
    wa, wb = (x.select(i, F.size("words").alias("n"), F.explode("words").alias("word")) for x, i in ((a, "a_id"), (b, "b_id")))
    rarity = wa.select("word").union(wb.select("word")).groupBy("word").agg(F.count("*").alias("freq"))

    def rarest(x: DataFrame, i: str) -> DataFrame:
        nth = F.row_number().over(Window.partitionBy(i).orderBy("freq", "word"))
        return x.join(rarity, "word").withColumn("nth", nth).where("nth <= 3").select(i, F.col("n").alias("least"), "word")

    larger = F.col("n") >= F.col("least")
    by_a = rarest(wa, "a_id").join(wb, "word").where(larger).select("a_id", "b_id")
    by_b = wa.join(rarest(wb, "b_id"), "word").where(larger).select("a_id", "b_id")
    found = by_a.union(by_b).distinct()
    met = found.join(a.select("a_id", F.col("words").alias("w_a")), "a_id").join(b.select("b_id", F.col("words").alias("w_b")), "b_id")
    met = met.withColumn("common", F.size(F.array_intersect("w_a", "w_b")).cast("long"))
    met = met.where((F.col("common") > 0) & (F.col("common") + 2 >= F.least(F.size("w_a"), F.size("w_b"))))
    return met.groupBy("b_id").agg(F.max("common").alias("common"), F.min_by("a_id", F.struct(-F.col("common"), "a_id")).alias("a_id"))


def error_counts(errors: DataFrame) -> DataFrame:
    """errors: text_id, err_type.  How often each type occurs, and the sum over all."""
    n = errors.groupBy("err_type").agg(F.count("*").alias("n"))
    return n.withColumn("total", F.sum("n").over(Window.partitionBy()))  # one row per type


def with_wanted_errors(errors: DataFrame, prefixes: list[str]) -> DataFrame:
    """The texts that have an error of a type that begins with one of the prefixes."""
    wanted = F.lit(False)
    for p in prefixes:
        wanted = wanted | F.col("err_type").startswith(p)
    return errors.where(wanted).select("text_id").distinct()


def field_changes(met: DataFrame, fields: list[str]) -> DataFrame:
    """met: one row per word with the columns a_<field> and b_<field>.  One row: words, how many differ in each field and in
    head or relation, and the share of each in per cent."""
    differs = {f: ~F.col(f"a_{f}").eqNullSafe(F.col(f"b_{f}")) for f in fields}
    differs["head_or_deprel"] = differs["head"] | differs["deprel"]
    counts = met.agg(F.count("*").alias("words"), *[F.count_if(c).alias(f"d_{f}") for f, c in differs.items()])
    return counts.select("*", *[F.round(F.col(f"d_{f}") * 100 / F.col("words"), 4).alias(f"pct_{f}") for f in differs])


def control_sentences(clauses: DataFrame, errors: DataFrame, lemmas: list[str]) -> DataFrame:
    """clauses: text_id, sent_id, clause, embedded, n_words, second_lemma; errors: text_id, sent_id.  Sentences without
    errors where, at or after an embedded clause, one of three or more words has such a second lemma."""
    so_far = Window.partitionBy("text_id", "sent_id").orderBy("clause").rowsBetween(Window.unboundedPreceding, 0)
    hit = clauses.withColumn("seen", F.max("embedded").over(so_far)).where(F.col("seen") & (F.col("n_words") > 2) & F.col("second_lemma").isin(*lemmas))
    return hit.select("text_id", "sent_id").distinct().join(errors.select("text_id", "sent_id"), ["text_id", "sent_id"], "left_anti")


def mutual_gaps(a: DataFrame, b: DataFrame, key: list[str]) -> DataFrame:
    """Keys that one side only has, and which side that is."""
    x, y = a.select(*key).distinct(), b.select(*key).distinct()
    return x.join(y, key, "left_anti").withColumn("only_in", F.lit("a")).union(y.join(x, key, "left_anti").withColumn("only_in", F.lit("b")))


def without_all_o(tags: DataFrame, by: list[str]) -> DataFrame:
    """Rows of the groups that have some tag other than O."""
    some = tags.where("tag <> 'O'").select(*by).distinct()
    return tags.join(some, by, "left_semi")
