"""Importance resampling against plain loops, and the share of draws against the weights."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from annoframe.llm import quality
from annoframe.llm.hashing import BASE, WORDS_AND_MARKS

FULL = (1 << 64) - 1
KIND = "doc_id long, text string, lang string, `my col` string, row string"


def mixed(h):
    h ^= h >> 31
    h = h * 0x7FB5D329728EA185 & FULL
    h ^= h >> 27
    h = h * 0x81DADEF4BC2DD44D & FULL
    return h ^ h >> 33


def brute_grams(text):
    """Buckets of the tokens (runs of letters, digits and bytes over 127, or of other marks) and of neighbours."""
    raw, found, last = (text or "").encode(), [], 0
    for b in raw:
        kind = int(WORDS_AND_MARKS[b])
        if kind and kind != last:
            found.append([])
        if kind:
            found[-1].append(b | 32 if 65 <= b <= 90 else b)
        last = kind
    h = [mixed(sum((b + 1) * pow(BASE, i, 1 << 64) for i, b in enumerate(t)) & FULL) for t in found]
    pairs = [mixed(x * int(quality.PAIR) + y & FULL) for x, y in zip(h, h[1:])]
    return [x % quality.BUCKETS for x in h + pairs]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    prose = lambda stems, n: " ".join(rng.choice(stems) + rng.choice(stems) for _ in range(n))
    en, de = ["the", "ing", "ha", "on", "wh"], ["ung", "sch", "ß", "ver", "ich"]
    out = [(k, prose(en if k % 3 else de, rng.randint(1, 60)), "en" if k % 3 else "de") for k in range(120)]
    out += [(k, "*** %%% ### *** %%% @@ ##", "en") for k in range(130, 150)]
    return out + [(200, None, None), (201, "", "en"), (None, "no id here", "en"), (None, "no id here either", None), (3, "x", "en"), (3, "x", "en")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(*r, "odd name", "clash") for r in rows], KIND).repartition(3)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(k, 1) for k in range(60)] + [(k, 0) for k in range(130, 140)] + [(None, 0), (3, None), (70, 1), (70, 0)], "doc_id long, quality int")


def test_every_column_against_loops(docs, labels, rows):
    sample = quality.resampled(docs, labels)
    good = {k: 1 for k in range(60)} | {k: 0 for k in range(130, 140)} | {70: 0}
    grams = [brute_grams(t) for _, t, _ in rows]
    raw, target = {}, Counter()
    for g, (k, _, lang) in zip(grams, rows):
        raw.setdefault(lang, Counter()).update(g)
        if good.get(k):
            target.update(g)
    of_lang = {}
    for g, (k, _, lang) in zip(grams, rows):
        of_lang[lang] = of_lang.get(lang, 0) + (len(g) if good.get(k) else 0)
    share = {lang: of_lang[lang] / max(1, sum(c.values())) for lang, c in raw.items()}
    one = sum(target.values()) / sum(sum(c.values()) for c in raw.values())
    ratio = [math.log(target[b] + one) - math.log(sum(share[x] * c[b] for x, c in raw.items()) + one) for b in range(quality.BUCKETS)]
    assert np.allclose(sample.model.ratio, ratio)
    total = [sum(ratio[b] for b in g) for g in grams]
    middle, slope = sample.model.middle, sample.model.slope
    assert slope > 0
    want = Counter()
    for (k, _, _), g, s in zip(rows, grams, total):
        mean = s / max(1, len(g))
        want[k, len(g), round(s, 6), round(mean, 6), round(-math.log1p(math.exp(-slope * (mean - middle))), 6)] += 1
    out = sample.rows.collect()
    assert Counter((r.doc_id, r.grams, round(r.log_ratio, 6), round(r.mean_ratio, 6), round(r.log_weight, 6)) for r in out) == want
    assert all(math.isclose(r.key, r.log_weight + r.gumbel) for r in out)
    assert sample.k == round(sum(math.exp(r.log_weight) for r in out))
    limit = sorted((r.key for r in out), reverse=True)[sample.k - 1]
    assert sample.limit == limit and all(r.kept == (r.key >= limit) for r in out)
    w = [math.exp(r.log_weight) for r in out]
    assert math.isclose(sample.effective, sum(w) ** 2 / sum(x * x for x in w))
    nulls = [r.gumbel for r in out if r.doc_id is None]
    assert nulls[0] != nulls[1] and len({r.gumbel for r in out if r.doc_id == 3 and r.grams == 1}) == 1


def test_curve_is_the_likeliest():
    rng = np.random.default_rng(1)
    x = rng.normal(size=4000)
    good = rng.random(4000) < 1 / (1 + np.exp(-3 * (x - 0.4)))
    middle, slope = quality.curve(x, good)
    assert abs(middle - 0.4) < 0.1 and abs(slope - 3) < 0.3
    assert quality.curve(x, np.ones(4000, bool)) == (0.0, 0.0) and quality.curve(np.zeros(0), np.zeros(0, bool)) == (0.0, 0.0)
    assert quality.curve(x, x > 0.4)[1] < math.inf  # parted perfectly


def test_no_threshold_decides_and_draws_follow_weights(spark, docs):
    """Texts of weights 1 and about 1 to 20: of a fifth drawn, nearly all are of the heavy ones, but not the heaviest only."""
    model = quality.Model(np.zeros(quality.BUCKETS), 0.0, 3.0)
    frame = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("a").alias("text"))
    rows = quality.weighted(frame, model, frame["doc_id"], 5).select(F.col("row").alias("doc_id"), "gumbel").withColumn("log_weight", F.when(F.col("doc_id") % 2 == 0, 0.0).otherwise(-3.0))
    keyed = sorted(((r.log_weight + r.gumbel, r.log_weight) for r in rows.collect()), reverse=True)[:4000]
    light = sum(w < 0 for _, w in keyed)
    # drawn one after the other without replacement: light ones are 1 in 1 + e**3 at first, more as the heavy ones go
    assert 0.047 < light / 4000 < 0.075
    sample = quality.resampled(docs, spark.createDataFrame([(k, int(k % 2)) for k in range(120)], "doc_id long, quality int"))
    kept, left = [r.mean_ratio for r in sample.rows.where("kept").collect()], [r.mean_ratio for r in sample.rows.where("not kept").collect()]
    assert min(kept) < max(left)


def test_stage(spark, docs, labels, rows):
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    sample = quality.resampled(docs, labels)
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in sample.rows.where("kept").collect())
    assert not {r.doc_id for r in kept.collect()} & set(range(132, 148))
    assert quality.keep_good(docs.where(F.lit(False)), labels).count() == 0
    assert quality.keep_good(docs, labels.where("false")).count() == len(rows)
    assert abs(quality.resampled(docs, labels, share=0.25).rows.where("kept").count() - len(rows) / 4) <= 2
