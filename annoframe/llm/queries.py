"""The training-data queries: opN_<name> applies operator N to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import digest_index, languages, maxent, mixing, negatives, packing, quality, repair, secrets, sentencepieces, simhash, transport_stream, wavelet
from .common import documents, stored


def op1_quality_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.resampled(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")).rows
    return rows.select("doc_id", "grams", "log_ratio", "mean_ratio", "log_weight", "gumbel", F.col("key").alias("score"), "kept")


def op2_transport_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transport_stream.features(stored(transport_stream.store(documents(spark, sf_dir)), "media"))


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.mixed_counts(documents(spark, sf_dir))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


OP3_SQL = r"""
WITH d AS (SELECT doc_id, source, substr(md5(coalesce(CAST(doc_id AS VARCHAR), text, '')), 1, 2) AS salt, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS turn FROM d GROUP BY source),
w AS (SELECT *, CASE turn % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w, 2.0::DOUBLE * source_size AS cap, 1.5::DOUBLE * CAST(sum(source_size) OVER () AS BIGINT) AS total FROM s),
l AS (SELECT *, coalesce(sum(cap) OVER b, 0) AS full_, sum(w) OVER () - coalesce(sum(w) OVER b, 0) AS rest FROM w
      WINDOW b AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT *, max(CASE WHEN cap / w >= (total - full_) / rest THEN (total - full_) / rest END) OVER () AS common FROM l),
t AS (SELECT source, source_size, least(cap, coalesce(w * common, cap)) AS target FROM c),
r AS (SELECT d.*, row_number() OVER (PARTITION BY source ORDER BY floor(log2(size + 1.0::DOUBLE) * 64), salt, size, doc_id NULLS LAST) AS n FROM d),
p AS (SELECT r.doc_id, r.size, t.source_size, t.target, CAST(n AS DOUBLE) AS n, CASE WHEN t.source_size = 0 THEN 0.0 ELSE t.target / t.source_size END AS rate, r.source
      FROM r JOIN t ON r.source IS NOT DISTINCT FROM t.source),
x AS (SELECT p.*, k, CAST(CAST('0x' || substr(md5('5|' || k || '|' || coalesce(source, '')), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0::DOUBLE AS o FROM p, range(32) AS z(k)),
y AS (SELECT *, CAST((floor(o + n * rate) - floor(o + (n - 1.0::DOUBLE) * rate)) * size AS BIGINT) AS taken FROM x),
b AS (SELECT source, arg_min(k, (abs(taken - target), k)) AS best FROM (SELECT source, k, CAST(sum(taken) AS BIGINT) AS taken, any_value(target) AS target FROM y GROUP BY source, k) GROUP BY source)
SELECT doc_id, size, source_size, target, taken FROM y JOIN b ON y.source IS NOT DISTINCT FROM b.source AND y.k = b.best
"""


def op4_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.token_table(documents(spark, sf_dir))


def op5_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.near_groups(documents(spark, sf_dir))
    return rows.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op6_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = languages.is_held_out(F.col("doc_id"), 3, 1)
    langs, log_p = languages.fit(docs.where(~held_out))
    return languages.predict(docs, langs, log_p, [F.col("doc_id"), held_out.alias("held_out")])


def op7_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir)).drop("source", "ids")


def op8_maxent_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = languages.is_held_out(F.col("doc_id"), 7, 2)
    return maxent.scored(docs, held_out, [F.col("doc_id"), held_out.alias("held_out")])


def op9_digest_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = digest_index.resolved(documents(spark, sf_dir))
    return rows.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("digest").alias("text_sha256"))


OP9_SQL = """
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS h FROM documents),
g AS (SELECT h, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY h)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, h AS text_sha256 FROM d JOIN g USING (h)
"""

def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(documents(spark, sf_dir))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mined(spark.read.parquet(f"{sf_dir}/embeddings.parquet").withColumn("label", label))


OP11_SQL = """
WITH v AS (SELECT row_number() OVER () AS own, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.own AS a_own, a.vec_id AS anchor_id, b.own AS b_own, b.vec_id AS id, a.label = b.label AS same, CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda x: coalesce(x[1] * x[2], 0))) AS BIGINT) AS score
  FROM v a JOIN v b ON a.own <> b.own AND a.vec_id % 100 = 0),
p AS (SELECT a_own, anchor_id, id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY a_own ORDER BY score DESC, id NULLS LAST) AS nth FROM s WHERE same QUALIFY nth <= 5),
n AS (SELECT p.*, s.id AS negative_id, s.score AS negative_score, row_number() OVER (PARTITION BY p.a_own, nth ORDER BY s.score DESC, s.id NULLS LAST) AS rank
  FROM p JOIN s ON p.a_own = s.a_own AND NOT s.same AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score QUALIFY rank <= 5)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n
"""


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nulls count as one space, null turns come first, a null conv_id is a conversation."""
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    rows = repair.with_all(conversations, repair.digested(repair.repaired(repair.damaged(conversations))))
    return rows.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


# crc32 is a sum over the bytes by a table of 256 numbers.  w walks each conversation row by row; its columns s0 to s3 are the best edits
# so far that end in each state (nothing, system, user, assistant) as (cost, audit, repaired text), infinite where there are none.
OP12_SQL = r"""
WITH RECURSIVE bits AS (SELECT n, 0 AS k, n AS v FROM range(256) t(n) UNION ALL SELECT n, k + 1, CASE WHEN v & 1 = 1 THEN xor(3988292384::BIGINT, v >> 1) ELSE v >> 1 END FROM bits WHERE k < 8),
tab AS (SELECT list(v ORDER BY n) AS t FROM bits WHERE k = 8),
c AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT,
        list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: CAST(ascii(x) AS BIGINT))),
        lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]))) % 20 AS kind FROM conversations, tab),
d AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
        unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy FROM c WHERE kind <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS tail FROM d),
f AS (SELECT *, CASE WHEN tail = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 'd' WHEN right(tail, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
        lag(role[1]) OVER (PARTITION BY conv_id ORDER BY n) || role[1] AS pair FROM o),
g AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
        count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, list((role, text, fault) ORDER BY n) AS r FROM f GROUP BY conv_id),
w AS (SELECT conv_id, r, 0 AS n, (0, '', '')::STRUCT(c INT, a VARCHAR, t VARCHAR) AS s0, (9999999, '', '')::STRUCT(c INT, a VARCHAR, t VARCHAR) AS s1,
        (3, 'I', chr(10) || 'user:')::STRUCT(c INT, a VARCHAR, t VARCHAR) AS s2, (6, 'II', chr(10) || 'user:' || chr(10) || 'assistant:')::STRUCT(c INT, a VARCHAR, t VARCHAR) AS s3 FROM g
      UNION ALL SELECT conv_id, r, n, i0, i1, i2, list_min([i3, (i2.c + 3, i2.a || 'I', i2.t || chr(10) || 'assistant:')]) FROM (
        SELECT conv_id, r, n, b0 AS i0, b1 AS i1, b3 AS i3, list_min([b2, (b0.c + 3, b0.a || 'I', b0.t || chr(10) || 'user:'), (b1.c + 3, b1.a || 'I', b1.t || chr(10) || 'user:'), (b3.c + 3, b3.a || 'I', b3.t || chr(10) || 'user:')]) AS i2 FROM (
          SELECT conv_id, r, n + 1 AS n,
            (s0.c + 4, s0.a || 'D', s0.t)::STRUCT(c INT, a VARCHAR, t VARCHAR) AS b0,
            list_min([(s1.c + 4, s1.a || 'D', s1.t), (s0.c + stay + CASE WHEN role[1] = 's' THEN 0 ELSE 9999999 END, s0.a || 'K', s0.t || own)])::STRUCT(c INT, a VARCHAR, t VARCHAR) AS b1,
            list_min([(s2.c + 4, s2.a || 'D', s2.t)] || flatten([[(x.c + stay + 3, x.a || 'R', x.t || chr(10) || 'user:' || text), (x.c + stay + CASE WHEN role[1] = 'u' THEN 0 ELSE 9999999 END, x.a || 'K', x.t || own)] for x in [s0, s1, s3]]))::STRUCT(c INT, a VARCHAR, t VARCHAR) AS b2,
            list_min([(s3.c + 4, s3.a || 'D', s3.t), (s2.c + stay + 3, s2.a || 'R', s2.t || chr(10) || 'assistant:' || text), (s2.c + stay + CASE WHEN role[1] = 'a' THEN 0 ELSE 9999999 END, s2.a || 'K', s2.t || own)])::STRUCT(c INT, a VARCHAR, t VARCHAR) AS b3
          FROM (SELECT *, r[n + 1][1] AS role, r[n + 1][2] AS text, CASE r[n + 1][3] WHEN '' THEN 0 WHEN 't' THEN 3 ELSE 9999999 END AS stay, chr(10) || r[n + 1][1] || ':' || r[n + 1][2] AS own FROM w WHERE n < len(r))))),
e AS (SELECT conv_id, list_min([s0, s3]) AS best FROM w WHERE n = len(r)),
every AS (SELECT DISTINCT conv_id FROM conversations)
SELECT every.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  CAST(coalesce(best.c, 0) AS BIGINT) AS cost, coalesce(best.a, '') AS audit, sha256(coalesce(substr(best.t, 2), '')) AS repaired_sha256
FROM every LEFT JOIN g ON every.conv_id IS NOT DISTINCT FROM g.conv_id LEFT JOIN e ON every.conv_id IS NOT DISTINCT FROM e.conv_id
"""


def op13_sentencepiece_agenda(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null text counts as empty: no ids, and the hashes of the empty string."""
    rows = sentencepieces.encoded(documents(spark, sf_dir))
    ids = F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256)
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), ids.alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {f.__name__: f for f in (op1_quality_resampling, op2_transport_stream, op3_source_mixing, op4_wavelet_tokens, op5_simhash_groups, op6_language_mixture, op7_mixture_packing, op8_maxent_scores, op9_digest_index, op10_secret_scan, op11_hard_negatives, op12_conversation_repair, op13_sentencepiece_agenda)}
ORACLES = {"op3_source_mixing": OP3_SQL, "op9_digest_index": OP9_SQL, "op11_hard_negatives": OP11_SQL, "op12_conversation_repair": OP12_SQL}
