"""Operator 1, quality classifier: importance resampling with hashed n-gram models and Gumbel top-k.

Two bag-of-n-gram models over hashed tokens and token pairs are counted: one of the target (texts labelled good), one of
all raw texts, whose languages (`lang`, null one of its own) are weighted to the target's shares, so that the ratio tells
good from bad and not one language from another.  A text's log ratio is the sum over its n-grams, its mean ratio that sum
per n-gram.  The raw texts are a mixture of target and other texts, so the ratio of target to raw is bounded: it is the
chance that a text is of the target over the target's share.  That chance is read off the mean ratio by a logistic curve
fitted on the labelled texts, and its logarithm is the text's log weight (0 for texts surely of the target).

Adding Gumbel noise to the log weights and keeping the k largest draws k texts without replacement in proportion to their
weights.  k is `share` of all texts; by default the mean chance over all texts, so that as many are drawn as the target
has.  Texts near the curve's middle stay or go by their draw, in proportion to their weight; no threshold decides.

Bounds: the target model and the curve are fitted on at most `max_labelled` labelled texts, picked by a hash of their id.
The raw model counts all texts.  The models are two vectors of `BUCKETS` numbers, whatever the input.

Edge cases: null or empty text has no n-grams and mean ratio 0; a null id draws its noise by its text; repeated rows have
equal keys and stay or go together (so ties at the limit may keep a few rows more than k); several labels of one id count
as bad if any is; without labels, or with good or bad ones only, every text has log weight 0 and, unless `share` says
otherwise, is kept.  Other columns pass untouched, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, cut, kth_largest, unit_hash, whole_row
from .hashing import WORDS_AND_MARKS, hashed_tokens, mix, slices
from .tokens import forget

BUCKETS = 1 << 14
PAIR = np.uint64(0xD6E8FEB86659FD93)


class Model(NamedTuple):
    ratio: np.ndarray  # log p(target) - log p(raw) of each bucket
    middle: float  # mean ratio at which a text is as likely of the target as not
    slope: float  # of the logistic curve; 0 without one


class Sample(NamedTuple):
    rows: DataFrame  # doc_id, grams, log_ratio, mean_ratio, log_weight, gumbel, key, kept
    limit: float  # the k-th largest key
    k: int
    effective: float  # effective sample size of the weights: their sum squared over the sum of their squares
    model: Model


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all tokens and pairs of neighbours, and the number of the text of each."""
    h, first, _ = hashed_tokens(texts, WORDS_AND_MARKS)
    owner = np.repeat(np.arange(len(texts)), np.diff(first))
    same = owner[1:] == owner[:-1]
    pairs = mix(h[:-1] * PAIR + h[1:])[same]
    mask = np.uint64(BUCKETS - 1)
    return np.concatenate((h & mask, pairs & mask)).astype(np.int64), np.concatenate((owner, owner[1:][same]))


def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a task's buckets by language: of all texts, and of the texts labelled good."""
    forget()
    counts: dict[str | None, np.ndarray] = {}
    for batch in batches:
        good = np.array(batch.column("good").fill_null(0).to_pylist(), bool)
        langs = batch.column("lang").to_pylist()
        for a, b, texts in slices(batch.column("text")):
            bucket, owner = grams(texts)
            for lang in dict.fromkeys(langs[a:b]):
                own = np.array([x == lang for x in langs[a:b]])
                sums = counts.setdefault(lang, np.zeros((2, BUCKETS), np.int64))
                sums[0] += np.bincount(bucket[own[owner]], minlength=BUCKETS)
                sums[1] += np.bincount(bucket[(own & good[a:b])[owner]], minlength=BUCKETS)
    for lang, (raw, target) in counts.items():
        some = np.flatnonzero(raw)
        yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(some), pa.string()), "bucket": pa.array(some, pa.int64()), "raw": pa.array(raw[some], pa.int64()), "target": pa.array(target[some], pa.int64())})


def scorer(ratio: np.ndarray):
    """A function for mapInArrow: the rows (row, id, text) with the text's n-grams and ratios."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, total = np.zeros(len(batch), np.int64), np.zeros(len(batch))
            for a, b, texts in slices(batch.column("text")):
                bucket, owner = grams(texts)
                n[a:b] = np.bincount(owner, minlength=b - a)
                total[a:b] = np.bincount(owner, ratio[bucket], minlength=b - a)
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("id"), pa.array(n), pa.array(total), pa.array(total / np.maximum(n, 1))], names=["row", "id", "grams", "log_ratio", "mean_ratio"])

    return score


def _scored(docs: DataFrame, ratio: np.ndarray, row: Column) -> DataFrame:
    """row, id (a hash that the noise is drawn by), grams, log_ratio, mean_ratio."""
    own = F.xxhash64("doc_id", F.when(F.col("doc_id").isNull(), F.col("text")))
    rows = docs.select(row.alias("row"), own.alias("id"), docs["text"].alias("text"))
    return rows.mapInArrow(scorer(ratio), arrow_schema(rows, "row, id", "grams long, log_ratio double, mean_ratio double"))


def curve(x: np.ndarray, good: np.ndarray, rounds: int = 100) -> tuple[float, float]:
    """Middle and slope of the logistic curve of good over x, by Newton's method.  A weak pull (a normal prior of spread 10
    on the slope per standard deviation) keeps the slope finite where x parts the two perfectly."""
    if not good.any() or good.all() or not x.std():
        return 0.0, 0.0
    z = np.stack((np.ones(len(x)), (x - x.mean()) / x.std()), 1)
    w, pull = np.zeros(2), np.diag([1e-9, 0.01])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -500, 500)))
        move = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + pull, z.T @ (good - p) - pull @ w)
        move *= min(1.0, 2.0 / np.abs(move).max(initial=1e-300))  # short steps, as full ones may overshoot
        w += move
        if np.abs(move).max() < 1e-10:
            break
    if w[1] <= 0:  # the ratio says nothing
        return 0.0, 0.0
    return float(x.mean() - w[0] / w[1] * x.std()), float(w[1] / x.std())


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = 20_000, smooth: float = 1.0) -> Model:
    """labels: doc_id, quality (1 good)."""
    some = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"))
    some = F.broadcast(cut(some.orderBy(F.xxhash64(F.lit(7), "doc_id"), "doc_id").limit(max_labelled)))  # bounded by the parameter
    texts = docs.select("doc_id", "text", "lang")
    counts = texts.join(some, "doc_id", "left").select("text", "lang", "good").mapInArrow(count_grams, "lang string, bucket long, raw long, target long")
    counts = cut(counts.groupBy("lang", "bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")))
    of_lang = counts.groupBy(F.col("lang").alias("l")).agg((F.sum("target") / F.sum("raw")).alias("weight"))
    weighted_raw = counts.join(of_lang, F.col("lang").eqNullSafe(F.col("l"))).groupBy("bucket").agg(F.sum(F.col("raw") * F.col("weight")).alias("raw"), F.sum("target").alias("target"))
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in weighted_raw.collect():  # BUCKETS at most
        raw[r.bucket], target[r.bucket] = r.raw, r.target
    all_raw = counts.agg(F.sum("raw")).first()[0]
    if not target.any():
        return Model(np.zeros(BUCKETS), 0.0, 0.0)
    # one raw occurrence, as it counts after weighting, is added to either side: a bucket too rare for the target is weak evidence
    one = smooth * target.sum() / all_raw
    ratio = np.log(target + one) - np.log(raw + one)
    joined = texts.join(some, "doc_id")
    judged = _scored(joined, ratio, joined["good"])
    # ids may repeat in docs: at most max_labelled rows of the texts are judged
    pairs = judged.select(F.col("row").alias("good"), "mean_ratio", "id").orderBy("id").limit(max_labelled).collect()
    return Model(ratio, *curve(np.array([p.mean_ratio for p in pairs]), np.array([p.good for p in pairs], bool)))


def weighted(docs: DataFrame, model: Model, row: Column, seed: int) -> DataFrame:
    """row, grams, log_ratio, mean_ratio, log_weight, gumbel, key."""
    scored = _scored(docs, model.ratio, row)
    odds = F.lit(model.slope) * (F.col("mean_ratio") - F.lit(model.middle))
    # log(1 / (1 + exp(-odds))) without overflow; without a curve all weights are equal
    log_weight = F.when(odds >= 0, -F.log1p(F.exp(-odds))).otherwise(odds - F.log1p(F.exp(odds))) if model.slope else F.lit(0.0)
    gumbel = -F.log(-F.log(unit_hash(seed, F.col("id"))))
    return scored.withColumn("log_weight", log_weight).withColumn("gumbel", gumbel).drop("id").withColumn("key", F.col("log_weight") + F.col("gumbel"))


def resampled(docs: DataFrame, labels: DataFrame, share: float | None = None, seed: int = 11, max_labelled: int = 20_000) -> Sample:
    """The sample: one row per document, and what it was drawn by."""
    model = fit(docs, labels, max_labelled)
    rows = cut(weighted(docs, model, docs["doc_id"], seed).select(F.col("row").alias("doc_id"), "grams", "log_ratio", "mean_ratio", "log_weight", "gumbel", "key"))
    weight = F.exp("log_weight")
    n, total, squares = rows.agg(F.count("*"), F.coalesce(F.sum(weight), F.lit(0.0)), F.coalesce(F.sum(weight * weight), F.lit(0.0))).first()
    k = round(total if share is None else share * n)
    limit = kth_largest(rows, "key", k)
    return Sample(rows.withColumn("kept", F.col("key") >= F.lit(limit)), limit, k, total * total / squares if squares else 0.0, model)


def keep_good(docs: DataFrame, labels: DataFrame, share: float | None = None, seed: int = 11, max_labelled: int = 20_000) -> DataFrame:
    """The documents of the sample, with all their columns.  The key is computed again beside the whole row, so that no text
    is shuffled."""
    sample = resampled(docs, labels, share, seed, max_labelled)
    return weighted(docs, sample.model, whole_row(docs), seed).where(F.col("key") >= F.lit(sample.limit)).select("row.*")
