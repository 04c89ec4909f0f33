"""Queries over the given tables, one or more per operator, each with the SQL that checks it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from annoframe.operators import collection as C
from annoframe.operators import diff as D
from annoframe.operators import layers as L
from annoframe.operators import sample as P
from annoframe.plans.base import LAYERS_SQL, SENTENCES_SQL, STOK_SQL, query, sentences, table, texts, with_sentences, with_words, words
from annoframe.sources import markup as M
from annoframe.sources.store import new_folder

T = "WITH t AS (SELECT doc_id AS text_id, text, lang, source FROM documents) "


# --- layers -------------------------------------------------------------------------------------------------------

@query(with_words(' SELECT text_id, word_id, start, "end", token FROM words'))
def word_layer(spark: SparkSession, d: str) -> DataFrame:
    return words(spark, d)


@query(with_sentences(' SELECT text_id, sent_id, start, "end", sentence FROM sentences'))
def sentence_layer(spark, d):
    return sentences(spark, d)


@query(with_sentences(""" , n AS (SELECT text_id, count(*) AS words FROM words GROUP BY 1), m AS (SELECT text_id, count(*) AS sents FROM sentences GROUP BY 1)
SELECT source, count(*) AS docs, CAST(sum(length(text)) AS BIGINT) AS chars, CAST(sum(coalesce(words, 0)) AS BIGINT) AS words, CAST(sum(coalesce(sents, 0)) AS BIGINT) AS sentences
FROM t LEFT JOIN n USING (text_id) LEFT JOIN m USING (text_id) GROUP BY source"""))
def word_count_index(spark, d):
    """Documents, characters, words and sentences per source, counted inside each text."""
    n = lambda pattern: F.regexp_count("text", F.lit(pattern))
    return texts(spark, d).groupBy("source").agg(F.count("*").alias("docs"), F.sum(F.length("text")).alias("chars"), F.sum(n("[^ \n]+")).alias("words"), F.sum(n("[^.!?\n]+[.!?]*")).alias("sentences"))


@query(with_words(f""" SELECT text_id, list_aggregate(list_sort(list(printf('%010d:%s', start, label))), 'string_agg', ' ') AS spans FROM la GROUP BY text_id""", LAYERS_SQL))
def nested_layer(spark, d):
    n = L.nested(L.labelled(words(spark, d)))
    return n.select("text_id", F.array_join(F.transform("spans", lambda s: F.format_string("%010d:%s", s["start"], s["label"])), " ").alias("spans"))


@query(with_words(' SELECT text_id, row_number() OVER (PARTITION BY text_id ORDER BY start) - 1 AS span_id, start, "end", label FROM la', LAYERS_SQL))
def exported_layer(spark, d):
    return L.flat(L.nested(L.labelled(words(spark, d))))




@query("WITH RECURSIVE " + with_sentences("""
, n AS (SELECT text_id, sent_id, start, "end" FROM sentences),
r AS (SELECT text_id, sent_id, start AS open, "end" AS stop, "end" - start >= 500 AS closed FROM n WHERE sent_id = 1
  UNION ALL SELECT n.text_id, n.sent_id, CASE WHEN r.closed THEN n.start ELSE r.open END, n."end", n."end" - CASE WHEN r.closed THEN n.start ELSE r.open END >= 500 FROM r JOIN n ON n.text_id = r.text_id AND n.sent_id = r.sent_id + 1),
c AS (SELECT text_id, open, max(stop) AS stop FROM r GROUP BY text_id, open)
SELECT text_id, row_number() OVER (PARTITION BY text_id ORDER BY open) - 1 AS chunk, open AS start, stop AS "end", coalesce(lead(open) OVER (PARTITION BY text_id ORDER BY open) - stop, -1) AS gap FROM c""")[5:])
def greedy_sections(spark, d):
    """Sections, with the length of what separates each from the next."""
    gap = F.coalesce(F.col("separator.end") - F.col("separator.start"), F.lit(-1))
    return L.greedy_cut(sentences(spark, d), 500).withColumn("gap", gap).drop("separator")


@query("WITH RECURSIVE " + with_sentences("""
, r AS (SELECT text_id, sent_id, 0 AS chunk, "end" - start AS total FROM sentences WHERE sent_id = 1
  UNION ALL SELECT n.text_id, n.sent_id, CASE WHEN r.total >= 500 THEN r.chunk + 1 ELSE r.chunk END, CASE WHEN r.total >= 500 THEN 0 ELSE r.total END + n."end" - n.start FROM r JOIN sentences n ON n.text_id = r.text_id AND n.sent_id = r.sent_id + 1)
SELECT text_id, chunk, count(*) AS n_sentences FROM r GROUP BY 1, 2""")[5:])
def summed_sections(spark, d):
    return L.summed_cut(sentences(spark, d), 500)


@query(with_sentences(' SELECT l.text_id, s.start AS s_start, l.start - s.start AS start, l."end" - s.start AS "end", label FROM la l JOIN sentences s ON l.text_id = s.text_id AND l.start >= s.start AND l."end" <= s."end"', LAYERS_SQL))
def section_spans(spark, d):
    return L.within(L.labelled(words(spark, d)), sentences(spark, d))


#: Sections of 100 characters, whatever stands at their edges.
TRIMMED_SQL = """, c AS (SELECT text_id, unnest(range(0, CAST(length(text) AS BIGINT), 100)) AS s FROM t), b AS (SELECT *, unnest(range(start // 100, ("end" - 1) // 100 + 1)) * 100 AS s FROM la)
SELECT b.text_id, c.s AS s_start, greatest(start, c.s) - c.s AS start, least("end", c.s + 100) - c.s AS "end", label FROM b JOIN c USING (text_id, s)"""


@query(with_words(TRIMMED_SQL, LAYERS_SQL))
def trimmed_section_spans(spark, d):
    """Spans of fixed sections; those that reach over an edge are cut there."""
    n = F.length("text").cast("long")
    s = texts(spark, d).where("length(text) > 0").select("text_id", n.alias("n"), F.explode(F.sequence(F.lit(0).cast("long"), n - 1, F.lit(100).cast("long"))).alias("start"))
    s = s.select("text_id", "start", F.least(F.col("start") + 100, F.col("n")).alias("end"))
    return L.within(L.labelled(words(spark, d)), s, trim_overlapping=True)


@query(with_words(" SELECT source, count(*) AS n FROM (SELECT text_id, count(*) AS n FROM words GROUP BY 1) JOIN t USING (text_id) WHERE n > 1000 GROUP BY source"))
def long_texts(spark, d):
    n = words(spark, d).groupBy("text_id").agg(F.count("*").alias("n")).where("n > 1000")
    return n.join(texts(spark, d), "text_id").groupBy("source").agg(F.count("*").alias("n"))


@query(with_sentences(" SELECT text_id, sent_id, count(*) AS n FROM stok GROUP BY ALL HAVING count(*) > 60", STOK_SQL))
def long_sentences(spark, d):
    """Sentences of more than 60 words."""
    n = F.size(F.filter(F.split(F.trim("sentence"), " +"), lambda x: x != "")).cast("long")
    return sentences(spark, d).select("text_id", "sent_id", n.alias("n")).where("n > 60")


TREE_SQL = ", tree AS (SELECT text_id, 1 AS sent_id, word_id AS id, CASE WHEN word_id % 7 = 1 THEN 0 WHEN word_id % 3 = 0 THEN word_id - 2 ELSE word_id - 1 END AS head, token FROM words) "


def tree(spark, d, by_text=False):
    head = F.when(F.col("word_id") % 7 == 1, 0).when(F.col("word_id") % 3 == 0, F.col("word_id") - 2).otherwise(F.col("word_id") - 1)
    return words(spark, d, by_text).select("text_id", F.lit(1).alias("sent_id"), F.col("word_id").alias("id"), head.alias("head"), "token")


@query(with_words(TREE_SQL + """, k AS (SELECT text_id, sent_id, head AS id, count(*) AS n, min(id) AS f FROM tree GROUP BY ALL)
SELECT a.text_id, a.sent_id, a.id, a.head, a.token, p.token AS parent, coalesce(k.n, 0) AS n_children, coalesce(k.f, 0) AS first_child FROM tree a LEFT JOIN tree p ON p.text_id = a.text_id AND p.sent_id = a.sent_id AND p.id = a.head LEFT JOIN k ON k.text_id = a.text_id AND k.sent_id = a.sent_id AND k.id = a.id"""))
def dependency_parents(spark, d):
    return L.parents(tree(spark, d, by_text=True)).withColumn("first_child", F.coalesce("first_child", F.lit(0)))


@query(with_words(TREE_SQL + " SELECT text_id, id, (id - 1) // 100 AS chunk, (id - 1) % 100 + 1 AS local FROM tree"))
def long_sentence_chunks(spark, d):
    return L.chunked_ids(tree(spark, d), 100).select("text_id", "id", "chunk", "local")


@query(with_words(TREE_SQL + " SELECT text_id, id, CASE WHEN head = 0 OR (head - 1) // 100 <> (id - 1) // 100 THEN 0 ELSE head END AS head FROM tree"))
def long_sentence_merge(spark, d):
    c = L.chunked_ids(tree(spark, d), 100)
    local = F.when((F.col("head") == 0) | (F.expr("(head - 1) div 100") != F.col("chunk")), 0).otherwise(F.pmod(F.col("head") - 1, F.lit(100)) + 1)
    return L.merged_ids(c.withColumn("local_head", local).drop("head", "id"), 100).select("text_id", "id", "head")


@query(with_words(" SELECT text_id, word_id, CASE WHEN contains(lower(token), 'w') THEN translate(token, 'wW', 'vV') END AS normalized FROM words"))
def modern_words(spark, d):
    return words(spark, d).select("text_id", "word_id", L.modern_spelling(F.col("token")).alias("normalized"))


@query(T + "SELECT text_id, md5(translate(text, 'еиò', 'eio')) AS safe FROM t")
def model_safe_texts(spark, d):
    return texts(spark, d).select("text_id", F.md5(L.model_safe(F.col("text"))).alias("safe"))


@query(with_words(""" SELECT w.text_id, start, replace(substr(text, greatest(start - 40, 0) + 1, least("end" + 40, length(text)) - greatest(start - 40, 0)), chr(10), '\\n') AS context FROM words w JOIN t USING (text_id)""".replace("\\\\n", "\\n")))
def context_snippets(spark, d):
    return L.snippets(words(spark, d, by_text=True).select("text_id", "start", "end"), texts(spark, d), 40).drop("end")


TAGS_SQL = """, tags AS (SELECT *, CASE WHEN kind = 0 THEN 'O' WHEN word_id % 5 = 2 THEN 'B-k' || kind ELSE 'I-k' || kind END AS tag FROM (SELECT *, length(token) % 3 AS kind FROM words)),
g AS (SELECT *, CASE WHEN tag <> 'O' THEN 'k' || kind END AS k, lag(CASE WHEN tag <> 'O' THEN 'k' || kind END) OVER (PARTITION BY text_id ORDER BY word_id) AS l FROM tags),
e AS (SELECT *, sum(CASE WHEN k IS NOT NULL AND (tag LIKE 'B-%' OR l IS NULL OR l <> k) THEN 1 ELSE 0 END) OVER (PARTITION BY text_id ORDER BY word_id) AS entity FROM g)
"""


@query(with_words(TAGS_SQL + ' SELECT text_id, CAST(entity AS BIGINT) AS entity, k AS kind, min(start) AS start, max("end") AS "end", count(*) AS n_words FROM e WHERE k IS NOT NULL GROUP BY 1, 2, 3'))
def decoded_entities(spark, d):
    kind = F.length("token") % 3
    tag = F.when(kind == 0, "O").when(F.col("word_id") % 5 == 2, F.concat(F.lit("B-k"), kind)).otherwise(F.concat(F.lit("I-k"), kind))
    return L.bio_entities(words(spark, d).withColumn("tag", tag))


@query(with_words(""", h AS (SELECT text_id, start, "end", label FROM la UNION ALL SELECT text_id, "end" AS start, "end" + 1, label FROM la),
i AS (SELECT *, CASE WHEN lag("end") OVER o = start THEN 0 ELSE 1 END AS new FROM h WINDOW o AS (PARTITION BY text_id, label ORDER BY start, "end")),
j AS (SELECT *, sum(new) OVER (PARTITION BY text_id, label ORDER BY start, "end" ROWS UNBOUNDED PRECEDING) AS island FROM i)
SELECT text_id, label, min(start) AS start, max("end") AS "end", count(*) AS n FROM j GROUP BY text_id, label, island""", LAYERS_SQL))
def touching_spans(spark, d):
    a = L.labelled(words(spark, d))
    return L.joined_neighbours(a.union(a.select("text_id", F.col("end").alias("start"), F.col("end") + 1, "label")))


HASH_SQL = """ SELECT text_id, row_number() OVER (PARTITION BY text_id ORDER BY sent_id) - 1 AS sentence_id, sha256('[' || coalesce((SELECT string_agg(CASE WHEN contains(x, '''') AND NOT contains(x, '"') THEN '"' || replace(x, '\\', '\\\\') || '"' ELSE '''' || replace(replace(x, '\\', '\\\\'), '''', '\\''') || '''' END, ', ' ORDER BY i) FROM (SELECT unnest(string_split(trim(sentence), ' ')) AS x, generate_subscripts(string_split(trim(sentence), ' '), 1) AS i)), '') || ']') AS sha256 FROM sentences"""


@query(with_sentences(HASH_SQL))
def sentence_fingerprints(spark, d):
    s = sentences(spark, d).withColumn("w", F.split(F.trim("sentence"), " "))
    return s.select("text_id", (F.col("sent_id") - 1).cast("long").alias("sentence_id"), L.fingerprint(F.col("w")).alias("sha256"))


@query(with_sentences(", h AS (SELECT md5(sentence) AS h, text_id FROM sentences) SELECT h, count(*) AS n, min(text_id) AS first_text FROM h GROUP BY h HAVING count(*) > 1"))
def repeated_sentences(spark, d):
    return sentences(spark, d).groupBy(F.md5("sentence").alias("h")).agg(F.count("*").alias("n"), F.min("text_id").alias("first_text")).where("n > 1")


@query("WITH h AS (" + with_sentences(HASH_SQL) + ") SELECT sha256, row_number() OVER (PARTITION BY sha256 ORDER BY text_id, sentence_id) AS nth, text_id, sentence_id FROM h")
def fingerprint_map(spark, d):
    """The sentences that share a fingerprint."""
    return L.fingerprint_map(sentence_fingerprints(spark, d))


PARTS_SQL = """, l AS (SELECT text_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM t),
m AS (SELECT *, CAST(coalesce(sum(length(line) + 1) OVER (PARTITION BY text_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM l),
p AS (SELECT text_id, row_number() OVER (PARTITION BY text_id ORDER BY pos) AS para_nr, start, start + length(line) AS "end" FROM m WHERE line <> ''),
n AS (SELECT text_id, row_number() OVER (PARTITION BY source ORDER BY text_id) AS doc_nr FROM t)
SELECT coalesce(source, '') || ':' || doc_nr || ':' || para_nr || ':' || sent_id AS key, s.text_id, s.start - p.start AS sent_start, s."end" - p.start AS sent_end, p.start AS para_start, md5(sentence) AS md5
FROM sentences s JOIN p ON p.text_id = s.text_id AND s.start >= p.start AND s."end" <= p."end" JOIN n ON n.text_id = s.text_id JOIN t ON t.text_id = s.text_id"""


@query(with_sentences(PARTS_SQL))
def document_parts(spark, d):
    """Sentences as texts of their own, with the numbers of their document in its file, paragraph and sentence."""
    t = texts(spark, d)
    parts = L.fragments(t)
    numbers = C.numbered(t.select("text_id", "source", F.expr("text_id div 1000").alias("block")), "source", "text_id", "block").select("text_id", F.col("nth").alias("doc_nr"), F.coalesce("source", F.lit("")).alias("file"))
    met = parts.join(numbers, "text_id")
    key = C.chunk_key(F.col("file"), F.col("doc_nr"), F.col("para_nr"), F.col("sent_nr"))
    return met.select(key.alias("key"), "text_id", "sent_start", "sent_end", "para_start", F.md5("text").alias("md5"))


@query(with_sentences(""", l AS (SELECT text_id, source, lang, count(*) AS n FROM sentences JOIN t USING (text_id) GROUP BY ALL)
SELECT text_id, n, 'minimal' AS kind, CASE WHEN source IS NULL THEN '' ELSE 'src' END AS fields FROM l UNION ALL SELECT text_id, n, 'complete', 'id' || CASE WHEN lang IS NULL THEN '' ELSE ',lang' END || CASE WHEN source IS NULL THEN '' ELSE ',src' END FROM l"""))
def fragment_metadata(spark, d):
    """Fragments of documents with minimal and with complete metadata: how many, and which fields they have."""
    t = texts(spark, d)
    meta = C.metadata(t).select("text_id", F.map_filter("meta", lambda _, v: v.isNotNull()).alias("meta"))
    parts = L.fragments(t).select("text_id", "sent_nr")
    each = lambda kind, minimal: C.with_metadata(parts, meta, minimal).groupBy("text_id").agg(F.count("*").alias("n"), F.first(F.array_join(F.array_sort(F.map_keys("meta")), ",")).alias("fields")).select("text_id", "n", F.lit(kind).alias("kind"), "fields")
    return each("minimal", ["src"]).union(each("complete", None))


@query(with_words(" SELECT text_id, word_id, '_' AS lemma, CASE WHEN length(token) % 2 = 0 THEN 'S' ELSE 'V' END AS pos, '_' AS form FROM words"))
def pos_only_words(spark, d):
    """Words as an annotator sees them that may read parts of speech only."""
    layer = words(spark, d).select("text_id", "word_id", F.lower("token").alias("lemma"), F.when(F.length("token") % 2 == 0, "S").otherwise("V").alias("pos"), F.col("token").alias("form"))
    return L.only_fields(layer, ["lemma", "pos", "form"], ["pos"])


@query("SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS para_nr, CAST(coalesce(sum(length(text) + 2) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM conversations")
def numbered_fragments(spark, d):
    w = Window.partitionBy("conv_id").orderBy("turn")
    start = F.coalesce(F.sum(F.length("text") + 2).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long")
    return table(spark, d, "conversations").select("conv_id", "turn", F.row_number().over(w).alias("para_nr"), start.alias("start"))


@query(r"""WITH g AS (SELECT page_id, unnest(regexp_extract_all(html, '<[a-zA-Z](?:"[^"]*"|[^"<>])*>')) AS tag, generate_subscripts(regexp_extract_all(html, '<[a-zA-Z](?:"[^"]*"|[^"<>])*>'), 1) AS nth FROM pages),
k AS (SELECT page_id, nth, unnest(regexp_extract_all(tag, '([^\s="<>/]+)="([^"]*)"', 1)) AS key, unnest(regexp_extract_all(tag, '([^\s="<>/]+)="([^"]*)"', 2)) AS value, generate_subscripts(regexp_extract_all(tag, '([^\s="<>/]+)="([^"]*)"', 1), 1) AS i FROM g)
SELECT page_id, nth, key, max_by(value, i) AS value FROM k GROUP BY 1, 2, 3""")
def tag_attributes(spark, d):
    """Attributes of every tag of every page; of one that repeats the last."""
    tags = F.regexp_extract_all("html", F.lit(r'<[a-zA-Z](?:"[^"]*"|[^"<>])*>'), F.lit(0))
    found = table(spark, d, "pages").select("page_id", F.posexplode(tags).alias("nth", "tag"))
    return found.select("page_id", (F.col("nth") + 1).cast("long").alias("nth"), F.explode(M.attributes(F.col("tag"))).alias("key", "value"))


TAG_SQL = """SELECT doc_id AS text_id, CASE doc_id % 5 WHEN 0 THEN 'd' || doc_id WHEN 1 THEN 'doaj<' || doc_id || '>' WHEN 2 THEN 'isbn' || doc_id WHEN 3 THEN 'http://x.ee/' || doc_id || '?a<b(doc@line:' || (doc_id + 7) || ')' ELSE '(doc@line:' || (doc_id + 7) || ')' END AS id FROM documents"""


@query(TAG_SQL)
def tag_ids(spark, d):
    """The id of a document's tag, or what stands for it."""
    k, n = F.col("text_id") % 5, F.col("text_id").cast("string")
    own = F.when(k == 0, F.concat(F.lit(' id="d'), n, F.lit('"'))).when(k == 1, F.concat(F.lit(' doaj_id="doaj<'), n, F.lit('>" ISBN="1"'))).when(k == 2, F.concat(F.lit(' ISBN="isbn'), n, F.lit('"')))
    own = own.when(k == 3, F.concat(F.lit(' url="http://x.ee/'), n, F.lit('?a<b" src="Feeds 2014–2021"'))).otherwise(F.concat(F.lit(' url="http://x.ee/'), n, F.lit('" src="Web"')))
    tag = F.concat(F.lit("<doc"), own, F.lit(">"))
    return texts(spark, d).select("text_id", M.document_id(M.attributes(tag), F.col("text_id") + 7).alias("id"))


# --- collections --------------------------------------------------------------------------------------------------

@query(T + "SELECT text_id, floor(text_id / 30000)::BIGINT AS doc_group FROM t")
def path_layout(spark, d):
    return texts(spark, d).select("text_id", C.doc_group(F.col("text_id")).alias("doc_group"))


@query(T + "SELECT count(*) AS n, count(DISTINCT text_id) AS n_ids, count(*) FILTER (WHERE source = 'src1') AS in_chunk FROM t")
def unique_ids(spark, d):
    return C.unique(texts(spark, d), ["text_id"]).agg(F.count("*").alias("n"), F.count_distinct("text_id").alias("n_ids"), F.count_if(F.col("source") == "src1").alias("in_chunk"))


@query(T + "SELECT source, row_number() OVER (PARTITION BY source ORDER BY text_id) AS nth, text_id FROM t")
def document_id_index(spark, d):
    """The ids of each file in order, one row each."""
    return C.numbered(texts(spark, d).select("source", "text_id", F.expr("text_id div 1000").alias("block")), "source", "text_id", "block").drop("block")


@query(T + "SELECT source, count(*) AS n, CAST(sum(text_id) AS BIGINT) AS ids FROM t WHERE text_id % 4 = 3 GROUP BY source")
def block_filter(spark, d):
    return C.block(texts(spark, d), "text_id", 4, 3).groupBy("source").agg(F.count("*").alias("n"), F.sum("text_id").alias("ids"))


@query("SELECT doc_id AS text_id, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def chosen_keys(spark, d):
    keys = table(spark, d, "labels").where("toxic = 1").select(F.col("doc_id").alias("text_id"))
    return C.chosen(texts(spark, d), keys, "text_id").select("text_id", "source")


@query("SELECT doc_id + 500 AS text_id FROM labels WHERE doc_id + 500 NOT IN (SELECT doc_id FROM documents)")
def unknown_keys(spark, d):
    return C.unknown_keys(texts(spark, d), table(spark, d, "labels").select((F.col("doc_id") + 500).alias("text_id")), "text_id")


@query("SELECT doc_id AS text_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def missing_layer(spark, d):
    return C.without_layer(texts(spark, d), table(spark, d, "labels").select(F.col("doc_id").alias("text_id"))).select("text_id")


@query("SELECT d.doc_id AS text_id, coalesce(l.q, false) AS quality, coalesce(l.x, false) AS toxic, coalesce(l.q, false) AND coalesce(l.x, false) AS complete FROM documents d LEFT JOIN (SELECT doc_id, bool_or(quality = 1) AS q, bool_or(toxic = 1) AS x FROM labels GROUP BY 1) l USING (doc_id)")
def insert_status(spark, d):
    lab = table(spark, d, "labels").withColumnRenamed("doc_id", "text_id")
    return C.insert_status(texts(spark, d), {"quality": lab.where("quality = 1"), "toxic": lab.where("toxic = 1")})


@query(T + ", r AS (SELECT source, text_id, row_number() OVER (PARTITION BY source ORDER BY text_id) AS nth, row_number() OVER (PARTITION BY source ORDER BY text_id DESC) AS from_end FROM t) SELECT * FROM r WHERE nth <= 3 OR from_end <= 3")
def first_and_last_texts(spark, d):
    return C.first_and_last(texts(spark, d).select("source", "text_id"), "source", "text_id", 3)


@query(T + "SELECT text_id, md5(text) AS text, source AS src FROM t")
def base_table(spark, d):
    return texts(spark, d).select("text_id", F.md5("text").alias("text"), C.normalize_src(F.col("source")).alias("src"))


@query(T + "SELECT text_id, source AS initial_src, lang, CAST(text_id AS VARCHAR) AS initial_id FROM t")
def metadata_table(spark, d):
    return C.metadata_table(C.metadata(texts(spark, d)), ["src", "lang", "id"], {"src": "initial_src", "id": "initial_id"})


FIELDS_SQL = T + """, f AS (SELECT source, text_id, unnest(['src', '_made', 'lang', 'id2', 'id']) AS field, unnest([source, 'x', lang, CASE WHEN text_id % 3 = 0 THEN 'y' END, 'z']) AS v, unnest([1, 2, 3, 4, 5]) AS pos FROM t),
g AS (SELECT source, field, min((text_id, pos)) AS first, min(text_id) AS first_text, count(*) AS n FROM f WHERE v IS NOT NULL AND field <> '_made' GROUP BY 1, 2),
r AS (SELECT source, field, row_number() OVER (PARTITION BY source ORDER BY first, field) AS nth, first_text, n FROM g) """


def _fields(spark, d):
    """text_id, source and metadata of every text, with an internal field and a numbered one."""
    t = texts(spark, d)
    meta = F.create_map(F.lit("src"), "source", F.lit("_made"), F.lit("x"), F.lit("lang"), "lang", F.lit("id2"), F.when(F.col("text_id") % 3 == 0, "y"), F.lit("id"), F.lit("z"))
    return t.select("text_id", "source", F.map_filter(meta, lambda _, v: v.isNotNull()).alias("meta"))


@query(FIELDS_SQL + "SELECT * FROM r")
def field_registry(spark, d):
    """Metadata fields of each source in the order in which they are first seen."""
    return C.field_registry(_fields(spark, d), "source")


@query(FIELDS_SQL + "SELECT field, count(DISTINCT source) AS n, round(count(DISTINCT source) * 100 / (SELECT count(DISTINCT source) FROM r), 4) AS pct FROM r GROUP BY 1")
def metadata_commonness(spark, d):
    """In how many sources each metadata field occurs."""
    return C.field_commonness(C.field_registry(_fields(spark, d), "source"), "source")


@query(T + "SELECT text_id, CASE WHEN source IS NOT NULL THEN 'x' END AS _made_, 'z' AS initial_id, lang, source AS initial_src FROM t")
def discovered_metadata(spark, d):
    """A metadata table whose columns are the fields that occur; the numbered field goes with its namesake."""
    found = C.discovered_metadata(_fields(spark, d).select("text_id", "meta"))
    return found.select("text_id", F.when(F.col("initial_src").isNotNull(), F.col("_made")).alias("_made_"), "initial_id", "lang", "initial_src")


@query(with_words(" SELECT label, count(*) AS n, count(DISTINCT text_id) AS texts FROM la WHERE label <> 'other' GROUP BY label", LAYERS_SQL))
def sparse_layer(spark, d):
    return L.labelled(words(spark, d)).where("label <> 'other'").groupBy("label").agg(F.count("*").alias("n"), F.count_distinct("text_id").alias("texts"))


@query(with_words(" SELECT (SELECT count(*) FROM la WHERE label = 'digit') AS spans, (SELECT count(*) FROM t) - (SELECT count(DISTINCT text_id) FROM la WHERE label = 'digit') AS skipped", LAYERS_SQL))
def skipped_texts(spark, d):
    """Spans of a layer that few texts have, and how many texts are not stored with it."""
    kept, skipped = L.sparse(L.labelled(words(spark, d)).where("label = 'digit'"), texts(spark, d))
    return kept.agg(F.count("*").alias("spans")).crossJoin(F.broadcast(skipped))  # one row each


@query(with_words(""" SELECT 'new_words' AS layer, CAST(NULL AS VARCHAR) AS parent, CAST(NULL AS VARCHAR) AS enveloping, count(*) AS n FROM words
UNION ALL SELECT 'shapes', 'new_words', NULL, count(*) FROM la UNION ALL SELECT 'clauses', NULL, 'new_words', count(*) FROM sentences""", SENTENCES_SQL, LAYERS_SQL))
def written_layers(spark, d):
    """Layers written as tables under new names, read back with the structure that links them."""
    w = words(spark, d)
    tables = {"words": w, "shapes": L.labelled(w), "sentences": sentences(spark, d)}
    links = spark.createDataFrame([("words", None, None), ("shapes", "words", None), ("sentences", None, "words")], "layer string, parent string, enveloping string")
    stored, structure = L.write_layers(tables, links, new_folder(spark, "layers"), {"words": "new_words", "sentences": "clauses"})
    counts = [x.agg(F.lit(name).alias("layer"), F.count("*").alias("n")) for name, x in stored.items()]
    return structure.join(counts[0].union(counts[1]).union(counts[2]), "layer").select("layer", "parent", "enveloping", "n")


@query("SELECT doc_id AS text_id, md5(coalesce(text, '')) AS md5, doc_id % 2 = 0 AS late FROM documents")
def inserted_texts(spark, d):
    """Two inserts that share no text; a second one of the same text would fail."""
    t = texts(spark, d).select("text_id", F.md5(F.coalesce("text", F.lit(""))).alias("md5"))
    first = C.inserted(t.where("false"), t.where("text_id % 2 = 1"), ["text_id"])
    later = C.inserted(first, t.where("text_id % 2 = 0"), ["text_id"])
    return first.withColumn("late", F.lit(False)).union(later.withColumn("late", F.lit(True)))


@query("SELECT event_type, count(*) AS n, CAST(coalesce(max(user_id), 0) AS BIGINT) AS user_id FROM events GROUP BY event_type, user_id HAVING count(*) > 1")
def duplicate_keys(spark, d):
    return C.duplicate_keys(table(spark, d, "events"), ["event_type", "user_id"]).select("event_type", "n", "user_id")


@query("SELECT 'chats:' || conv_id || ':' || turn AS key, md5(text) AS md5 FROM conversations WHERE role <> 'user'")
def appended_rows(spark, d):
    """A table continued: turns whose key it lacks."""
    key = C.chunk_key(F.lit("chats"), F.col("conv_id"), F.col("turn"))
    c = table(spark, d, "conversations").select(key.alias("key"), F.md5("text").alias("md5"), "role")
    return C.appended(c.where("role = 'user'"), c.drop("role"), ["key"])


@query(T + "SELECT text_id, source, row_number() OVER (ORDER BY source, text_id) - 1 AS global_id FROM t")
def global_text_ids(spark, d):
    return C.global_ids(texts(spark, d).select("text_id", "source", F.expr("text_id div 1000").alias("block")), "source", "text_id", "block").drop("block")


@query(T + "SELECT text_id, source, (row_number() OVER (PARTITION BY source ORDER BY text_id) - 1) % 4 AS grp FROM t")
def round_robin_subsets(spark, d):
    return P.round_robin(texts(spark, d).select("text_id", "source", F.expr("text_id div 1000").alias("block")), "source", 4, "text_id", "block").drop("block")


@query(T + "SELECT source, md5(text) AS hash, min(text_id) AS first_id, count(*) AS n, count(DISTINCT lang) > 1 AS meta_differs FROM t GROUP BY 1, 2 HAVING count(*) > 1")
def exact_copies_in_file(spark, d):
    return C.exact_copies(texts(spark, d), "source")


@query(with_words(""", k AS (SELECT source, md5(text) AS h, min(text_id) AS from_id FROM t GROUP BY 1, 2)
SELECT t.text_id, from_id, start, "end", label FROM t JOIN k ON k.source = t.source AND k.h = md5(t.text) JOIN la ON la.text_id = from_id WHERE t.text_id <> from_id""", LAYERS_SQL))
def carried_layer(spark, d):
    t = texts(spark, d)
    return C.carried(t, t, L.labelled(words(spark, d))).where("text_id <> from_id")


@query(T + """, k AS (SELECT text_id, concat_ws('||', source, left(text, 10)) AS key, text FROM t WHERE text IS NOT NULL), f AS (SELECT key, min(text_id) AS first_id FROM k GROUP BY key),
p AS (SELECT text_id, first_id FROM k JOIN f USING (key) WHERE text_id > first_id), l AS (SELECT text_id, line, count(*) AS n FROM (SELECT text_id, unnest(string_split(text, chr(10))) AS line FROM k) GROUP BY ALL),
z AS (SELECT text_id, sum(n) AS size FROM l GROUP BY 1), s AS (SELECT p.text_id, p.first_id, sum(least(a.n, b.n)) AS m FROM p JOIN l a ON a.text_id = p.text_id JOIN l b ON b.text_id = p.first_id AND a.line = b.line GROUP BY ALL),
r AS (SELECT s.text_id, first_id, round(m / (x.size + y.size - m), 2) AS ratio FROM s JOIN z x ON x.text_id = s.text_id JOIN z y ON y.text_id = first_id)
SELECT text_id, first_id, ratio, CASE WHEN ratio = 1 THEN 'exact' WHEN ratio < 0.7 THEN 'far' ELSE 'near' END AS class FROM r WHERE ratio >= 0.1""")
def near_copies_in_file(spark, d):
    return C.near_copies(texts(spark, d))


# --- comparison ---------------------------------------------------------------------------------------------------

def both(spark, d):
    w = words(spark, d, by_text=True)
    return L.labelled(w), L.trimmed(w)


@query(with_words(" SELECT text_id, start, \"end\", array_to_string(a, ',') AS a, array_to_string(b, ',') AS b, status FROM diff", LAYERS_SQL))
def span_diff(spark, d):
    return D.span_diff(*both(spark, d)).withColumn("a", F.array_join("a", ",")).withColumn("b", F.array_join("b", ","))


@query(with_words(""" SELECT text_id, start, "end", k AS annotation_status, unnest(v) AS label FROM (
SELECT text_id, start, "end", unnest(['COMMON', 'MISSING', 'EXTRA']) AS k, unnest([list_intersect(a, b), list_filter(a, lambda x: NOT list_contains(b, x)), list_filter(b, lambda x: NOT list_contains(a, x))]) AS v FROM diff WHERE status = 'modified')""", LAYERS_SQL))
def annotation_status(spark, d):
    return D.annotation_status(D.span_diff(*both(spark, d)))


@query(with_words(" SELECT * FROM pairs", LAYERS_SQL))
def conflict_pairs(spark, d):
    return D.conflicts(*both(spark, d))


@query(with_words(""", p AS (SELECT DISTINCT text_id, least(a_start, b_start) AS start, greatest(a_end, b_end) AS "end" FROM pairs),
n AS (SELECT *, CASE WHEN start <= max("end") OVER (PARTITION BY text_id ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS new FROM p),
g AS (SELECT *, sum(new) OVER (PARTITION BY text_id ORDER BY start, "end" ROWS UNBOUNDED PRECEDING) AS grp FROM n)
SELECT text_id, CAST(grp AS BIGINT) AS grp, min(start) AS start, max("end") AS "end", count(*) AS n_pairs FROM g GROUP BY text_id, grp""", LAYERS_SQL))
def conflict_groups(spark, d):
    return D.conflict_groups(D.conflicts(*both(spark, d)))


@query(with_words(""", h AS (SELECT DISTINCT text_id, a_start AS start, a_end AS "end", 'missing' AS status FROM pairs UNION SELECT DISTINCT text_id, b_start, b_end, 'extra' FROM pairs)
SELECT text_id, CASE WHEN a IS NOT NULL THEN start ELSE -1 END AS a_start, CASE WHEN a IS NOT NULL THEN "end" ELSE -1 END AS a_end, a[1] AS a_annt, CASE WHEN b IS NOT NULL THEN start ELSE -1 END AS b_start, CASE WHEN b IS NOT NULL THEN "end" ELSE -1 END AS b_end, b[1] AS b_annt
FROM diff x WHERE status <> 'unchanged' AND NOT EXISTS (SELECT 1 FROM h WHERE h.text_id = x.text_id AND h.start = x.start AND h."end" = x."end" AND h.status = x.status)
UNION ALL SELECT text_id, a_start, a_end, a_label, b_start, b_end, b_label FROM pairs""", LAYERS_SQL))
def diff_records(spark, d):
    a, b = both(spark, d)
    return D.records(D.span_diff(a, b), D.conflicts(a, b)).fillna(-1, ["a_start", "a_end", "b_start", "b_end"])


@query(with_words(""", c AS (SELECT coalesce(source, 'TOTAL') AS category, count(DISTINCT text_id) AS docs, count(*) FILTER (status = 'unchanged') AS unchanged, count(*) FILTER (status = 'modified') AS modified, count(*) FILTER (status = 'missing') AS missing, count(*) FILTER (status = 'extra') AS extra
FROM diff JOIN t USING (text_id) GROUP BY ROLLUP (source))
SELECT *, round(2 * unchanged / (2 * unchanged + 2 * modified + missing + extra), 6) AS equal_share, round(missing / (unchanged + modified + missing), 6) AS only_a, round(extra / (unchanged + modified + extra), 6) AS only_b, round(modified / (unchanged + modified), 6) AS modified_share FROM c""", LAYERS_SQL))
def diff_summary(spark, d):
    return D.summary(D.span_diff(*both(spark, d)), texts(spark, d).select("text_id", F.col("source").alias("category")))


@query(with_sentences(""" SELECT l.text_id, sent_id, count(*) AS n, min_by(label, l.start) AS first_label, max_by(label, l.start) AS last_label FROM la l JOIN sentences s ON s.text_id = l.text_id AND l.start >= s.start AND l."end" <= s."end" GROUP BY 1, 2""", LAYERS_SQL))
def clause_words(spark, d):
    met = L.contained(L.labelled(words(spark, d)), sentences(spark, d).drop("sentence"))
    return met.groupBy("text_id", F.col("s.sent_id").alias("sent_id")).agg(F.count("*").alias("n"), F.min_by("x.label", "x.start").alias("first_label"), F.max_by("x.label", "x.start").alias("last_label"))


# --- statistics ---------------------------------------------------------------------------------------------------

@query(with_sentences(""", w AS (SELECT text_id, count(*) AS words FROM words GROUP BY 1), s AS (SELECT text_id, count(*) AS sentences FROM sentences GROUP BY 1)
SELECT coalesce(source, 'TOTAL') AS source, count(*) AS docs, CAST(sum(coalesce(sentences, 0)) AS BIGINT) AS sentences, CAST(sum(words) AS BIGINT) AS words FROM w JOIN t USING (text_id) LEFT JOIN s USING (text_id) GROUP BY ROLLUP (source)"""))
def corpus_counts(spark, d):
    """Documents that have words, their sentences and words, per source and in all; counted inside each text."""
    n = lambda pattern: F.regexp_count("text", F.lit(pattern))
    r = texts(spark, d).select("source", n("[^ \n]+").alias("w"), n("[^.!?\n]+[.!?]*").alias("s")).where("w > 0")
    r = r.rollup("source").agg(F.count("*").alias("docs"), F.sum("s").alias("sentences"), F.sum("w").alias("words"))
    return r.withColumn("source", F.coalesce("source", F.lit("TOTAL")))


@query(with_sentences(""", w AS (SELECT text_id, count(*) AS words FROM words GROUP BY 1), s AS (SELECT text_id, count(*) AS sentences FROM sentences GROUP BY 1)
SELECT text_id, coalesce(source, '__') AS source, coalesce(lang, '__') AS lang, coalesce(CAST(quality AS VARCHAR), '__') AS quality, CAST(coalesce(length(text), 0) AS BIGINT) AS chars, coalesce(words, 0) AS words, coalesce(sentences, 0) AS sentences
FROM t LEFT JOIN w USING (text_id) LEFT JOIN s USING (text_id) LEFT JOIN (SELECT doc_id AS text_id, min(quality) AS quality FROM labels GROUP BY 1) USING (text_id)"""))
def document_word_index(spark, d):
    """Characters, words and sentences of each document with its metadata; what is missing shows as __."""
    n = lambda pattern: F.coalesce(F.regexp_count("text", F.lit(pattern)), F.lit(0)).cast("long")
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("__")).alias(c)
    quality = table(spark, d, "labels").groupBy(F.col("doc_id").alias("text_id")).agg(F.min("quality").alias("quality"))
    sized = texts(spark, d).select("text_id", "source", "lang", F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("chars"), n("[^ \n]+").alias("words"), n("[^.!?\n]+[.!?]*").alias("sentences"))
    return sized.join(quality, "text_id", "left").select("text_id", shown("source"), shown("lang"), shown("quality"), "chars", "words", "sentences")


@query(T + """, e AS (SELECT unnest(['src', 'lang']) AS k, unnest([source, lang]) AS v FROM t), c AS (SELECT k, v, count(*) AS n FROM e GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY n DESC, v) AS nth, count(*) OVER (PARTITION BY k) AS n_values FROM c)
SELECT k, v, n, nth, n_values FROM r WHERE nth <= 10""")
def metadata_values(spark, d):
    c = texts(spark, d).select(F.explode(F.create_map(F.lit("src"), "source", F.lit("lang"), "lang")).alias("k", "v")).groupBy("k", "v").agg(F.count("*").alias("n"))
    by = Window.partitionBy("k")
    return c.withColumn("nth", F.row_number().over(by.orderBy(F.desc("n"), "v"))).withColumn("n_values", F.count("*").over(by)).where("nth <= 10")


@query("SELECT event_type, count(DISTINCT user_id) AS n, round(count(DISTINCT user_id) / (SELECT count(DISTINCT user_id) FROM events) * 100, 4) AS pct FROM events GROUP BY 1")
def field_commonness(spark, d):
    e = table(spark, d, "events")
    total = e.agg(F.count_distinct("user_id").alias("total"))
    n = e.groupBy("event_type").agg(F.count_distinct("user_id").alias("n")).crossJoin(F.broadcast(total))  # one row
    return n.select("event_type", "n", F.round(F.col("n") / F.col("total") * 100, 4).alias("pct"))


@query(with_words(" SELECT text_id, source, count(*) AS words FROM words JOIN t USING (text_id) GROUP BY ALL ORDER BY words DESC, text_id LIMIT 10"))
def largest_texts(spark, d):
    return texts(spark, d).select("text_id", "source", F.regexp_count("text", F.lit("[^ \n]+")).cast("long").alias("words")).orderBy(F.desc("words"), "text_id").limit(10)


@query(with_words(", n AS (SELECT text_id, count(*) AS words, any_value(length(text)) AS chars FROM words JOIN t USING (text_id) GROUP BY 1) SELECT round(regr_slope(chars, words), 6) AS slope, round(regr_intercept(chars, words), 4) AS intercept FROM n"))
def size_model(spark, d):
    n = texts(spark, d).select(F.regexp_count("text", F.lit("[^ \n]+")).alias("words"), F.length("text").alias("chars")).where("words > 0")
    return n.agg(F.round(F.regr_slope("chars", "words"), 6).alias("slope"), F.round(F.regr_intercept("chars", "words"), 4).alias("intercept"))


SIZE_SQL = """, n AS (SELECT text_id, count(*) AS words, any_value(length(text)) AS chars FROM words JOIN t USING (text_id) GROUP BY 1), f AS (SELECT regr_slope(chars, words) AS a, regr_intercept(chars, words) AS b FROM n),
p AS (SELECT text_id, words, CAST(trunc(a * words + b + 0.0001) AS BIGINT) AS predicted FROM n, f)
SELECT text_id, words, predicted, CASE WHEN predicted < 1024 THEN printf('%.1f B', CAST(predicted AS DOUBLE)) WHEN predicted < 1048576 THEN printf('%.1f KB', predicted / 1024) ELSE printf('%.1f MB', predicted / 1048576) END AS size FROM p ORDER BY words DESC, text_id LIMIT 10"""


@query(with_words(SIZE_SQL))
def predicted_sizes(spark, d):
    """The texts with most words, and the size in characters that the model predicts for them."""
    n = texts(spark, d).select("text_id", F.regexp_count("text", F.lit("[^ \n]+")).cast("long").alias("words"), F.length("text").alias("chars")).where("words > 0")
    fitted = n.agg(F.regr_slope("chars", "words").alias("a"), F.regr_intercept("chars", "words").alias("b"))
    top = n.select("text_id", "words").orderBy(F.desc("words"), "text_id").limit(10).crossJoin(F.broadcast(fitted))  # one row
    p = top.select("text_id", "words", (F.col("a") * F.col("words") + F.col("b") + 0.0001).cast("long").alias("predicted"))
    return p.withColumn("size", C.human_size(F.col("predicted")))


@query(with_words(" SELECT label, count(*) AS n, round(count(*) * 100 / sum(count(*)) OVER (), 4) AS pct FROM la GROUP BY label", LAYERS_SQL))
def type_distribution(spark, d):
    c = L.labelled(words(spark, d)).groupBy("label").agg(F.count("*").alias("n"))
    return c.withColumn("pct", F.round(F.col("n") * 100 / F.sum("n").over(Window.partitionBy()), 4))


@query(with_words(" SELECT count(*) AS docs, count(*) FILTER (n IS NULL) AS empty FROM t LEFT JOIN (SELECT text_id, count(*) AS n FROM la WHERE label = 'digit' GROUP BY 1) USING (text_id)", LAYERS_SQL))
def empty_layer_share(spark, d):
    n = L.labelled(words(spark, d)).where("label = 'digit'").select("text_id").distinct().withColumn("has", F.lit(1))
    return texts(spark, d).join(n, "text_id", "left").agg(F.count("*").alias("docs"), F.count_if(F.col("has").isNull()).alias("empty"))


@query("SELECT event_type, count(*) AS n, CAST(sum(count(*)) OVER () AS BIGINT) AS total FROM events GROUP BY event_type")
def error_type_counts(spark, d):
    c = table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n"))
    return c.withColumn("total", F.sum("n").over(Window.partitionBy()))


SIZES = T + ", z AS (SELECT text_id, source, lang, length(text) AS size FROM t) "


def sizes(spark, d):
    return texts(spark, d).select("text_id", "source", "lang", F.length("text").alias("size"))


@query(SIZES + "SELECT source, CAST(sum(size) AS BIGINT) AS total, round(sum(size) / sum(sum(size)) OVER (), 6) AS share, CAST(floor(sum(size) / sum(sum(size)) OVER () * 100000) AS BIGINT) AS goal FROM z GROUP BY source")
def category_goals(spark, d):
    return P.goals(sizes(spark, d), "source", "size", 100_000)


@query(T + "SELECT text_id, length(text) AS _text_len, left(text, 50) AS _text_start, source FROM t")
def metadata_index(spark, d):
    return texts(spark, d).select("text_id", F.length("text").cast("long").alias("_text_len"), F.substring("text", 1, 50).alias("_text_start"), "source")


@query("SELECT event_type, count(*) AS n, round(count(*) * 100 / sum(count(*)) OVER (), 4) AS pct FROM events WHERE value > 10 GROUP BY 1")
def differences_by_category(spark, d):
    c = table(spark, d, "events").where("value > 10").groupBy("event_type").agg(F.count("*").alias("n"))
    return c.withColumn("pct", F.round(F.col("n") * 100 / F.sum("n").over(Window.partitionBy()), 4))


@query(with_words(""", x AS (SELECT coalesce(source, '') AS category, count(*) AS n FROM diff JOIN t USING (text_id) WHERE status <> 'unchanged' GROUP BY 1) SELECT category, n, round(n * 100 / sum(n) OVER (), 4) AS pct FROM x""", LAYERS_SQL))
def differences_by_source(spark, d):
    """Differing spans of each source, and their share of all."""
    return D.by_category(D.span_diff(*both(spark, d)), texts(spark, d).select("text_id", F.coalesce("source", F.lit("")).alias("category")))


@query(T + "SELECT source, count(*) FILTER (length(text) = 0) AS empty, count(*) FILTER (text IS NULL) AS missing FROM t GROUP BY source")
def empty_texts(spark, d):
    return texts(spark, d).groupBy("source").agg(F.count_if(F.length("text") == 0).alias("empty"), F.count_if(F.col("text").isNull()).alias("missing"))


@query(with_words(""", x AS (SELECT d.text_id, max(CASE WHEN status <> 'unchanged' THEN 1 ELSE 0 END) AS differs FROM diff d GROUP BY 1) SELECT count(*) AS comparable, CAST(sum(differs) AS BIGINT) AS differing FROM x""", LAYERS_SQL))
def differing_texts(spark, d):
    x = D.span_diff(*both(spark, d)).groupBy("text_id").agg(F.max((F.col("status") != "unchanged").cast("long")).alias("differs"))
    return x.agg(F.count("*").alias("comparable"), F.sum("differs").alias("differing"))


# --- samples ------------------------------------------------------------------------------------------------------

@query(SIZES + "SELECT * FROM z ORDER BY md5('1|' || text_id), text_id LIMIT 25")
def sampled_texts(spark, d):
    return P.pick(sizes(spark, d), 25, 1, "text_id")


@query(SIZES + "SELECT * FROM z WHERE size BETWEEN 500 AND 1500 ORDER BY md5('2|' || text_id), text_id LIMIT 25")
def sampled_in_bounds(spark, d):
    return P.pick_bounded(sizes(spark, d), 25, 2, "text_id", "size", 500, 1500)


@query(SIZES + """, g AS (SELECT source, floor(sum(size) / sum(sum(size)) OVER () * 100000) AS goal FROM z GROUP BY source), r AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY md5('3|' || text_id), text_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM z)
SELECT text_id, source, lang, size FROM r JOIN g USING (source) WHERE before < goal""")
def sampled_by_budget(spark, d):
    return P.pick_budget(sizes(spark, d), "source", "size", 100_000, 3, "text_id")


QUOTA_SQL = ", c AS (SELECT {by}, count(*) AS n FROM z GROUP BY 1), q AS (SELECT {by}, n, {k} // count(*) OVER () + CASE WHEN row_number() OVER (ORDER BY {by}) <= {k} % count(*) OVER () THEN 1 ELSE 0 END AS quota FROM c), r AS (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY md5('{seed}|' || text_id), text_id) AS nth FROM z) "


@query(SIZES + QUOTA_SQL.format(by="source", k=47, seed=4) + "SELECT text_id, source, lang, size FROM r JOIN q USING (source) WHERE nth <= quota")
def sampled_evenly(spark, d):
    return P.pick_even(sizes(spark, d), "source", 47, 4, "text_id")


@query(SIZES + QUOTA_SQL.format(by="lang", k=40, seed=5) + """, e AS (SELECT count(*) <= 40 AND 40 % count(*) = 0 AND bool_and(n >= quota) AS even FROM q)
SELECT text_id, source, lang, size FROM r JOIN q USING (lang), e WHERE nth <= quota AND even UNION ALL SELECT text_id, source, lang, size FROM (SELECT * FROM z ORDER BY md5('5|' || text_id), text_id LIMIT 40), e WHERE NOT even""")
def sampled_evenly_or_any(spark, d):
    return P.pick_even_or_any(sizes(spark, d), "lang", 40, 5, "text_id")


@query(SIZES + QUOTA_SQL.format(by="lang", k=500, seed=6) + """, l AS (SELECT sum(greatest(quota - n, 0)) AS lack FROM q),
x AS (SELECT text_id, source, lang, size, row_number() OVER (ORDER BY nth - quota, lang) AS slot FROM r JOIN q USING (lang) WHERE nth > quota)
SELECT text_id, source, lang, size FROM r JOIN q USING (lang) WHERE nth <= quota UNION ALL SELECT text_id, source, lang, size FROM x, l WHERE slot <= lack""")
def sampled_with_overflow(spark, d):
    return P.pick_spread(sizes(spark, d), "lang", 500, 6, "text_id")
