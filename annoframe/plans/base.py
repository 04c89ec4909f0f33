"""Tables of a data folder as collections, and the SQL that the queries' checks share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annoframe.operators import collection, layers

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    """Register a query, with the SQL that checks it if SQL can express it."""
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


WORDS_SQL = """
t AS (SELECT doc_id AS text_id, text, lang, source FROM documents),
w0 AS (SELECT text_id, unnest(string_split_regex(text, '[ \n]')) AS piece, generate_subscripts(string_split_regex(text, '[ \n]'), 1) AS pos FROM t),
w1 AS (SELECT *, CAST(coalesce(sum(length(piece) + 1) OVER (PARTITION BY text_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM w0),
words AS (SELECT text_id, row_number() OVER (PARTITION BY text_id ORDER BY pos) AS word_id, start, start + length(piece) AS "end", piece AS token FROM w1 WHERE piece <> ''),
"""
SENTENCES_SQL = r"""
s0 AS (SELECT text_id, unnest(regexp_extract_all(text, '[^.!?\n]+[.!?]*|[.!?\n]')) AS piece, generate_subscripts(regexp_extract_all(text, '[^.!?\n]+[.!?]*|[.!?\n]'), 1) AS pos FROM t),
s1 AS (SELECT *, CAST(coalesce(sum(length(piece)) OVER (PARTITION BY text_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM s0),
sentences AS (SELECT text_id, row_number() OVER (PARTITION BY text_id ORDER BY pos) AS sent_id, start, start + length(piece) AS "end", piece AS sentence FROM s1 WHERE left(piece, 1) NOT IN ('.', '!', '?', chr(10))),
"""
SHAPE_SQL = "CASE WHEN regexp_matches(token, '^[0-9]') THEN 'digit' WHEN regexp_matches(token, '^[A-Z]') THEN 'cap' ELSE 'other' END"
LAYERS_SQL = f"""
la AS (SELECT text_id, start, "end", {SHAPE_SQL} AS label FROM words),
wb AS (SELECT text_id, start, rtrim(token, '.,!?;:*$%#&|') AS token FROM words),
lb AS (SELECT text_id, start, start + length(token) AS "end", CASE WHEN {SHAPE_SQL} = 'cap' AND length(token) <= 3 THEN 'other' ELSE {SHAPE_SQL} END AS label FROM wb WHERE token <> ''),
da AS (SELECT text_id, start, "end", list_sort(list(DISTINCT label)) AS a FROM la GROUP BY ALL),
db AS (SELECT text_id, start, "end", list_sort(list(DISTINCT label)) AS b FROM lb GROUP BY ALL),
diff AS (SELECT text_id, start, "end", a, b, CASE WHEN b IS NULL THEN 'missing' WHEN a IS NULL THEN 'extra' WHEN a = b THEN 'unchanged' ELSE 'modified' END AS status FROM da FULL JOIN db USING (text_id, start, "end")),
ka AS (SELECT *, unnest(range(start // 32, ("end" - 1) // 32 + 1)) AS k FROM la WHERE start < "end"),
kb AS (SELECT *, unnest(range(start // 32, ("end" - 1) // 32 + 1)) AS k FROM lb WHERE start < "end"),
pairs AS (SELECT DISTINCT ka.text_id, ka.start AS a_start, ka."end" AS a_end, ka.label AS a_label, kb.start AS b_start, kb."end" AS b_end, kb.label AS b_label
  FROM ka JOIN kb ON ka.text_id = kb.text_id AND ka.k = kb.k AND ka.start < kb."end" AND kb.start < ka."end" AND (ka.start <> kb.start OR ka."end" <> kb."end")),
"""


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collection.texts(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(spark: SparkSession, sf_dir: str, by_text: bool = False) -> DataFrame:
    return layers.words(texts(spark, sf_dir), by_text)


def sentences(spark: SparkSession, sf_dir: str, by_text: bool = False) -> DataFrame:
    return layers.sentences(texts(spark, sf_dir), by_text)


def with_words(sql: str, *more: str) -> str:
    return "WITH " + (WORDS_SQL + "".join(more)).rstrip().rstrip(",") + sql


def with_sentences(sql: str, *more: str) -> str:
    return with_words(sql, SENTENCES_SQL, *more)


#: Words of sentences, split at spaces: stok (text_id, sent_id, id from 1, tok).
STOK_SQL = """
stok AS (SELECT text_id, sent_id, unnest(list_filter(string_split_regex(trim(sentence), ' +'), lambda x: x <> '')) AS tok, generate_subscripts(list_filter(string_split_regex(trim(sentence), ' +'), lambda x: x <> ''), 1) AS id FROM sentences),
"""


def sentence_tokens(spark: SparkSession, sf_dir: str, by_text: bool = False) -> DataFrame:
    """text_id, sent_id, id (from 1), tok."""
    parts = F.filter(F.split(F.trim("sentence"), " +"), lambda x: x != "")
    return sentences(spark, sf_dir, by_text).select("text_id", "sent_id", F.posexplode(parts).alias("id", "tok")).withColumn("id", F.col("id") + 1)
