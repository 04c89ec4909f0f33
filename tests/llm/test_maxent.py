"""The maximum-entropy model against plain loops over softmaxes."""

import gc
import math
import random
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from annoframe.llm import languages, maxent
from annoframe.llm.hashing import LOWER
from tests.llm.conftest import DE, EN, prose

FULL = (1 << 64) - 1
K1, K2, K3, K4 = map(int, (maxent.K1, maxent.K2, maxent.K3, maxent.K4))


def words(text):
    return (text or "").encode().translate(LOWER).split()


def held(k):
    return zlib.crc32(("null" if k is None else str(k)).encode()) % 7 == 2


def mixed(h):
    h &= FULL
    h ^= h >> 31
    h = h * 0x7FB5D329728EA185 & FULL
    h ^= h >> 27
    h = h * 0x81DADEF4BC2DD44D & FULL
    return h ^ h >> 33


def path(v, t, tail):
    """Digits of a token, and whether it is of the head."""
    at = int(np.searchsorted(v.words, np.uint64(t)))
    if at < len(v.words) and int(v.words[at]) == t:
        return list(divmod(int(v.rank[at]), 32)), True
    return [16 + tail, *[t >> 5 * k & 31 for k in range(v.depth - 1)]], False


def plain_softmax(v, w, level, node, one, two):
    if level == 0:
        rows = [mixed(x) % maxent.ROWS1 + k * maxent.ROWS1 for k, x in enumerate((one * K1, (one * K2 & FULL) + two * K3, two * K4))]
        x = [sum(float(w.first[r, j]) for r in rows) + float(v.prior[0][0, j]) for j in range(32)]
    else:
        own = node * 64 + level
        rows = [mixed((one * K3 & FULL) + own * K1) % maxent.ROWS2, mixed((two * K2 & FULL) + own * K4) % maxent.ROWS2 + maxent.ROWS2]
        x = [sum(float(w.later[r, j]) for r in rows) + float(v.prior[level][node, j]) for j in range(32)]
    total = sum(math.exp(y) for y in x)
    return [math.exp(y) / total for y in x]


def plain_score(v, w, tokens, tails, count, first_nodes):
    out, one, two = 0.0, 1, 1
    for t, tail in zip(tokens, tails):
        digits, head = path(v, t, tail)
        node = 0
        for level, d in enumerate(digits):
            out += math.log10(max(plain_softmax(v, w, level, node, one, two)[d], 1e-30))
            node = d if level == 0 else (node - first_nodes) * 32 + d if level == 1 else node * 32 + d
        if not head:
            out += math.log10(count.get(t, 0) + 1) - float(v.tail[node])
        one, two = t, one
    return out


@pytest.fixture(scope="module")
def many(spark):
    """Enough words for a head and tail, with a rare one each."""
    rng = random.Random(4)
    stems = EN + DE + ["ab", "cd", "ef", "gh", "xy", "zz", "ka", "lo"]
    rows = [(k, " ".join(rng.choice(stems) + rng.choice(stems) + rng.choice(["", "", rng.choice(stems)]) for _ in range(150)) + f" rare{k}") for k in range(60)] + [(60, None), (None, ""), (61, prose(rng, 50, EN))]
    return rows, spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


@pytest.mark.parametrize("depth", [2, 3, 4])
def test_score_against_loops(many, depth, monkeypatch):
    rows, docs = many
    rest = languages.is_held_out(F.col("doc_id"), 7, 2)
    kept = {}
    train, vocabulary = maxent.train, maxent.vocabulary
    monkeypatch.setattr(maxent, "train", lambda *a, **k: kept.setdefault("w", train(*a, **k)))
    monkeypatch.setattr(maxent, "vocabulary", lambda c, n: kept.setdefault("v", vocabulary(c, n, depth)))
    got = {r.doc_id: r for r in maxent.scored(docs, rest, [F.col("doc_id")], common=200).collect()}
    v, w = kept["v"][0], kept["w"]
    assert v.depth == depth and np.abs(w.first).max() > 0.1 and np.abs(w.later).max() > 0.1
    t, tails, first = maxent.tokens([(x or "").encode() for _, x in rows])
    count = Counter(h for k, (doc_id, _) in enumerate(rows) if not held(doc_id) for h in t[first[k] : first[k + 1]].tolist())
    assert len(count) > maxent.HEAD
    for k in (0, 1, 5, 60, 61, 62):
        a, b = first[k], first[k + 1]
        want = plain_score(v, w, t[a:b].tolist(), tails[a:b].tolist(), count, maxent.FREQUENT)
        assert math.isclose(got[rows[k][0]].score, want, rel_tol=1e-4, abs_tol=1e-4)


def test_probabilities_of_all_words_sum_to_one(many):
    rows, docs = many
    counts = maxent.counted(docs)
    v, _, _ = maxent.vocabulary(counts, 1000, 2)
    w = maxent.train(docs.select("text", F.xxhash64("text").alias("key")), v)
    table = counts.table.collect()
    assert len(table) > maxent.HEAD
    # all words after the same two, and an unknown word of each leaf, which stands for all unknown words there
    t = [*(r.h & FULL for r in table), *(leaf % 32 | 1 << 62 for leaf in range(len(v.tail)))]
    tails = [*(r.tail for r in table), *(leaf // 32 for leaf in range(len(v.tail)))]
    c = np.array([*(r.c for r in table), *[0] * len(v.tail)])
    lines = np.array([x for h in t for x in (t[3], t[9], h)], np.uint64)
    lp, outside = maxent.log_chances(v, w, lines, np.array([x for k in tails for x in (tails[3], tails[9], k)]), np.arange(0, len(lines) + 1, 3))
    p = 10 ** (lp[2::3] + np.where(outside[2::3], np.log10(c + 1), 0))
    assert math.isclose(p.sum(), 1, abs_tol=1e-3) and p[: len(table)].sum() > 0.5


def test_counts_and_base_scores(docs, empty, rows):
    rest = languages.is_held_out(F.col("doc_id"), 7, 2)
    out = maxent.scored(docs, rest, [F.col("doc_id"), rest.alias("held_out")], common=20).collect()
    tokens = [(r[0], [*words(r[1]), None]) for r in rows]
    c = Counter(w for k, t in tokens if not held(k) for w in t)
    n = sum(c.values())
    want = Counter((k, held(k), len(t), sum(w in c for w in t), n, round(sum(math.log10((c[w] + 1) / (n + len(c) + 1)) for w in t), 6)) for k, t in tokens)
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out) == want
    assert all(math.isfinite(r.score) and r.score < 0 for r in out)
    assert maxent.scored(empty, rest, [F.col("doc_id")]).count() == 0
    assert maxent.scored(docs, F.lit(True), [F.col("doc_id")]).agg(F.sum("n_known")).first()[0] == 0


def test_scores_do_not_depend_on_how_the_input_is_split(docs):
    rest = languages.is_held_out(F.col("doc_id"), 7, 2)
    every = [sorted((str(r.doc_id), r.n_tokens, r.score) for r in maxent.scored(docs.repartition(n), rest, [F.col("doc_id")]).collect()) for n in (2, 7)]
    assert all(a[:2] == b[:2] and math.isclose(a[2], b[2], rel_tol=1e-5) for a, b in zip(*every))
    assert [maxent.shards_for(n, 3) for n in (0, 10**8, 10**9, 10**15)] == [6, 6, 42, 4096]


def test_leaves_grow_with_the_vocabulary():
    assert [maxent.depth_for(n) for n in (0, 1, 10**4, 10**6, 10**7, 10**8, 10**9, 10**11)] == sorted(maxent.depth_for(n) for n in (0, 1, 10**4, 10**6, 10**7, 10**8, 10**9, 10**11))
    for n in (10**5, 10**6, 10**8, 10**10):
        leaves = maxent.TAILS * maxent.BRANCH ** (maxent.depth_for(n) - 1)
        assert n**0.5 / 6 < leaves < n**0.5 * 6


def test_context_helps_on_held_out_texts(spark):
    """Words that follow each other by rule: the model knows more than their counts."""
    rng = random.Random(1)
    stems = [f"{a}{b}" for a in "bcdfghklmnprst" for b in "aeiou"]
    after = {w: rng.sample(stems, 3) for w in stems}

    def text():
        w, out = rng.choice(stems), []
        for _ in range(200):
            out.append(w)
            w = rng.choice(after[w])
        return " ".join(out)

    docs = spark.createDataFrame([(k, text()) for k in range(300)], "doc_id long, text string").repartition(4)
    rest = languages.is_held_out(F.col("doc_id"), 7, 2)
    r = maxent.scored(docs, rest, [rest.alias("h")]).where("h").agg((F.sum("score") / F.sum("n_tokens")).alias("m"), (F.sum("base_score") / F.sum("n_tokens")).alias("b")).first()
    assert r.m > r.b + 0.7  # of log10(70 / 3) = 1.37 at most


def test_rounds_leave_the_disk(spark, many):
    """What tasks and driver wrote for a round's weights and shuffles is gone after it."""
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    left = lambda: {f for d in (*manager.localDirsString(), spark.sparkContext._temp_dir) for f in Path(d).rglob("*") if f.is_file() and f.stat().st_size > 1 << 16}
    docs = many[1].select("text", F.xxhash64("text").alias("key"))
    v, _, _ = maxent.vocabulary(maxent.counted(docs), 1000, 2)
    gc.disable()  # as long as nothing is collected
    try:
        before = left()
        maxent.train(docs, v)
        assert not left() - before
    finally:
        gc.enable()
