"""Queries with annotators in Python, entities over sub-word tokens, and aligned annotations."""

from __future__ import annotations

from pyspark.sql import functions as F

from annoframe.operators import annotate as A
from annoframe.operators import entities as E
from annoframe.operators import layers as L
from annoframe.plans.base import LAYERS_SQL, SHAPE_SQL, WORDS_SQL, query, texts, with_words, words

#: Entities: the first three letters of words that start with a capital; tokens: words in pieces of three.  A piece ends at every third
#: letter of a word and at its end, so the last one up to a place needs no table of pieces.
ENTITIES_SQL = r"""
ent AS (SELECT text_id, start, start + 3 AS "end", "end" AS w_end, token FROM words WHERE regexp_matches(token, '^[A-Z]') AND length(token) >= 3),
tail AS (SELECT *, CASE WHEN regexp_matches(substr(token, 4, 1), '[\p{L}\p{N}]') THEN "end" + length(regexp_extract(substr(token, 4), '^[^\x{00a0}"'',.:;?!]+')) END AS stop FROM ent),
grown AS (SELECT *, CASE WHEN stop >= w_end THEN w_end WHEN (stop - start) // 3 >= 2 THEN start + 3 * ((stop - start) // 3) END AS new_end FROM tail),
fixed AS (SELECT text_id, start, coalesce(new_end, "end") AS "end", new_end IS NOT NULL AS grown, stop FROM grown),
"""


def _entities(spark, d):
    w = words(spark, d, by_text=True)
    found = w.where("token rlike '^[A-Z]' and length(token) >= 3").select("text_id", "start", (F.col("start") + 3).alias("end"), F.lit("cap").alias("label"))
    return found, E.pieces(w, 3)


@query(with_words(""" , n AS (SELECT text_id, unnest(regexp_extract_all(text, '[0-9]+|[^0-9]+')) AS piece, generate_subscripts(regexp_extract_all(text, '[0-9]+|[^0-9]+'), 1) AS pos FROM t),
m AS (SELECT *, CAST(coalesce(sum(length(piece)) OVER (PARTITION BY text_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM n)
SELECT text_id, start, start + length(piece) AS "end", 'number' AS label FROM m WHERE regexp_matches(piece, '^[0-9]')"""))
def annotated_numbers(spark, d):
    """An annotator in Python over every text."""
    layer, _ = A.good_and_bad(A.annotate(texts(spark, d), A.pattern_annotator("[0-9]+", "number")))
    return layer


def long_ones(text, spans):
    """The second of a chain: drops numbers of one digit, and tells those of a year's length."""
    return [(a, b, "year" if b - a == 4 else label) for a, b, label in spans if b - a > 1]


@query(with_words(""" , n AS (SELECT text_id, unnest(regexp_extract_all(text, '[0-9]+|[^0-9]+')) AS piece, generate_subscripts(regexp_extract_all(text, '[0-9]+|[^0-9]+'), 1) AS pos FROM t),
m AS (SELECT *, CAST(coalesce(sum(length(piece)) OVER (PARTITION BY text_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM n)
SELECT text_id, start, start + length(piece) AS "end", CASE WHEN length(piece) = 4 THEN 'year' ELSE 'number' END AS label FROM m WHERE regexp_matches(piece, '^[0-9]{2}')"""))
def chained_numbers(spark, d):
    """Two annotators in a chain, made once a worker."""
    make = A.chained(A.pattern_annotator("[0-9]+", "number"), lambda: long_ones)
    layer, _ = A.good_and_bad(A.annotate(texts(spark, d), make, model="chained numbers"))
    return layer


@query(with_words(f""", v AS (SELECT text_id, start, "end", {SHAPE_SQL} AS label FROM words UNION ALL SELECT text_id, start, "end", CASE WHEN length(token) <= 3 THEN 'other' ELSE {SHAPE_SQL} END FROM words UNION ALL SELECT text_id, start, "end", CASE WHEN word_id = 1 THEN 'first' ELSE {SHAPE_SQL} END FROM words),
c AS (SELECT text_id, start, "end", label, count(*) AS votes FROM v GROUP BY ALL)
SELECT text_id, start, "end", label, votes FROM (SELECT *, row_number() OVER (PARTITION BY text_id, start, "end" ORDER BY votes DESC, label) AS nth FROM c) WHERE nth = 1"""))
def voted_labels(spark, d):
    """Three annotators vote on each word."""
    w, shape = words(spark, d, by_text=True), L.shape(F.col("token"))
    models = [shape, F.when(F.length("token") <= 3, "other").otherwise(shape), F.when(F.col("word_id") == 1, "first").otherwise(shape)]
    versions = w.select("text_id", "start", "end", F.explode(F.array(*models)).alias("label"))
    return A.voted(versions)


@query(with_words(' SELECT text_id, start, "end", 1 AS n_tokens FROM ent', ENTITIES_SQL))
def entity_tokens(spark, d):
    return E.grouped(*_entities(spark, d)).drop("label")


@query(with_words(' SELECT text_id, start, "end", grown FROM fixed', ENTITIES_SQL))
def expanded_entities(spark, d):
    found, pieces = _entities(spark, d)
    return E.expanded(found, pieces, texts(spark, d)).drop("label")


@query(with_words(' SELECT text_id, start, "end" FROM fixed WHERE grown OR stop IS NULL', ENTITIES_SQL))
def entities_without_infixes(spark, d):
    found, pieces = _entities(spark, d)
    t = texts(spark, d)
    return E.without_infixes(E.expanded(found, pieces, t).drop("grown"), t).drop("label")


@query(with_words(""" SELECT text_id, start, "end", 'B' AS label FROM words WHERE regexp_matches(token, '^[A-Z]') AND length(token) >= 3"""))
def projected_words(spark, d):
    """Sub-word tokens labelled B at a capital, I after it, brought back to the words."""
    capital = words(spark, d).where("token rlike '^[A-Z]' and length(token) >= 3").select("text_id", "start", "end")
    tokens = E.pieces(capital, 3).join(capital.select("text_id", "start", F.lit("B").alias("first")), ["text_id", "start"], "left")
    return E.projected(words(spark, d).select("text_id", "start", "end"), tokens.select("text_id", "start", "end", F.coalesce("first", F.lit("I")).alias("label")))


#: Batches of at most 1750 characters by recursion: where one ends, and where the next begins.
_WHITE = r"[\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_STOP = "CASE WHEN n < 1750 THEN n WHEN length(s) > length(regexp_extract(s, '[^.!?]*$')) THEN a + 2 + length(s) - length(regexp_extract(s, '[^.!?]*$')) ELSE least(a + 1750, n) END"
_CUT = "SELECT *, substr(x, a + 3, greatest(least(a + 1750, n) - a - 2, 0)) AS s FROM"
BATCHES_SQL = f"""WITH RECURSIVE d AS (SELECT doc_id AS text_id, source, coalesce(text, '') AS x, length(coalesce(text, '')) AS n FROM documents),
r AS (SELECT text_id, n, CAST(0 AS BIGINT) AS a, CAST({_STOP} AS BIGINT) AS stop FROM ({_CUT} (SELECT *, CAST(0 AS BIGINT) AS a FROM d))
  UNION ALL SELECT text_id, n, a, CAST({_STOP} AS BIGINT) FROM ({_CUT} (SELECT r.text_id, r.n, x, CASE WHEN stop + length(regexp_extract(substr(x, stop + 1), '^{_WHITE}*')) < r.n THEN stop + length(regexp_extract(substr(x, stop + 1), '^{_WHITE}*')) ELSE stop END AS a FROM r JOIN d ON d.text_id = r.text_id WHERE stop < r.n))),
"""


@query(BATCHES_SQL.rstrip().rstrip(",") + ' SELECT text_id, a AS start, stop AS "end" FROM r')
def character_budget_batches(spark, d):
    """Batches of at most 1750 characters."""
    return A.budget_batches(texts(spark, d), 1750)


OVER_SQL = BATCHES_SQL + WORDS_SQL.strip() + """
b AS (SELECT *, unnest(range(a // 256, greatest(stop - 1, a) // 256 + 1)) AS k FROM r), w AS (SELECT text_id, start, "end" AS e, unnest(range(start // 256, ("end" - 1) // 256 + 1)) AS k FROM words),
m AS (SELECT DISTINCT b.text_id, a, w.start FROM b JOIN w ON w.text_id = b.text_id AND w.k = b.k AND w.start < stop AND a < e),
c AS (SELECT text_id, a, count(*) AS n FROM m GROUP BY 1, 2)
SELECT source, count(*) AS batches, count(*) FILTER (n > 300) AS over_limit, CAST(sum(greatest(n - 300, 0)) AS BIGINT) AS words_lost, round(sum(greatest(n - 300, 0)) * 100 / sum(n), 4) AS pct FROM c JOIN t USING (text_id) GROUP BY source"""


@query(OVER_SQL)
def over_limit_batches(spark, d):
    """Batches with more words than a model takes, by source: batches, words past the limit, share of all words."""
    limit = 300
    batch = A.budget_batches(texts(spark, d), 1750)
    met = E.touching(batch, words(spark, d).select("text_id", "start", "end")).where("a.start < b.end and b.start < a.end")
    n = met.groupBy("text_id", "a.start").agg(F.count("*").alias("n"))
    by = n.join(texts(spark, d).select("text_id", "source"), "text_id").groupBy("source")
    over = F.greatest(F.col("n") - limit, F.lit(0))
    return by.agg(F.count("*").alias("batches"), F.count_if(F.col("n") > limit).alias("over_limit"), F.sum(over).alias("words_lost"), F.round(F.sum(over) * 100 / F.sum("n"), 4).alias("pct"))


@query(with_words(""", m AS (SELECT l.text_id, l.start, l.label AS p, l."end" - l.start AS f, r.label AS q, r."end" - r.start AS g FROM la l JOIN lb r USING (text_id, start)),
k AS (SELECT text_id, start, CAST(p = q AS INT) + CAST(f = g AS INT) AS equal FROM m)
SELECT text_id, start, CASE WHEN equal = 2 THEN 'COMMON' ELSE 'MODIFIED' END AS status, equal FROM k WHERE equal > 0 UNION ALL SELECT text_id, start, 'MISSING', 0 FROM k WHERE equal = 0 UNION ALL SELECT text_id, start, 'EXTRA', 0 FROM k WHERE equal = 0""", LAYERS_SQL))
def aligned_annotations(spark, d):
    """Two versions of each word's annotation, aligned by equal attributes."""
    w = words(spark, d, by_text=True)
    ann = lambda p: F.array(F.create_map(F.lit("pos"), "label", F.lit("form"), (F.col("end") - F.col("start")).cast("string"))).alias(p)
    a, b = L.labelled(w).select("text_id", "start", "end", ann("a")), L.trimmed(w).select("text_id", "start", ann("b"))
    out = A.aligned(a.join(b, ["text_id", "start"]), ["pos", "form"], ["pos"])
    return out.select("text_id", "start", "status", F.size("equal").cast("long").alias("equal"))
