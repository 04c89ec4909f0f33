"""Each training-data operator against a brute-force version on a small, awkward table."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from annoframe.llm import common, languages, simhash
from annoframe.llm.hashing import LOWER, hashed_tokens
from tests.llm.conftest import DE, EN, prose


def words(text):
    return (text or "").encode().translate(LOWER).split()


def test_hashed_tokens_tell_words_apart(rows):
    texts = [(r[1] or "").encode() for r in rows]
    h, first, _ = hashed_tokens(texts)
    seen = {}
    for k, t in enumerate(texts):
        own = h[first[k] : first[k + 1]].tolist()
        assert len(own) == len(words(t.decode()))
        for w, x in zip(words(t.decode()), own):
            assert seen.setdefault(w, x) == x
    assert len(set(seen.values())) == len(seen)


def test_kth_largest(spark):
    values = [random.Random(1).gauss(0, 5) for _ in range(5000)] + [1.25] * 4000
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    for k in (1, 17, 2500, 5200, 9000):
        assert common.kth_largest(frame, "v", k, few=50) == sorted(values, reverse=True)[k - 1]
    assert common.kth_largest(frame, "v", 0) == math.inf and common.kth_largest(frame, "v", 9001) == -math.inf


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 101), (102, 101), (7, 7)]
    got = {r.node: r.root for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(41)} | {100: 100, 101: 100, 102: 100}
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_fingerprint(text):
    w = words(text)
    s = [b" ".join(w[k : k + 4]) for k in range(max(1, len(w) - 3))] if w else []
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def test_simhash(docs, empty, rows):
    fp = [brute_fingerprint(r[1]) if len(words(r[1])) < 5000 else None for r in rows]
    got = simhash.near_groups(docs).collect()
    assert len(got) == len(rows)
    known = {r.fp & (1 << 64) - 1 for r in got}
    part = {f: f for f in known}

    def root(x):
        while part[x] != x:
            x = part[x]
        return x

    for a in known:
        for b in known:
            if (a ^ b).bit_count() <= 4:
                part[root(a)] = root(b)
    least = {}
    for r in got:
        if r.doc_id is not None:
            k = root(r.fp & (1 << 64) - 1)
            least[k] = min(least.get(k, r.doc_id), r.doc_id)
    count = Counter((r.doc_id, r.fp & (1 << 64) - 1) for r in got)
    assert all(count[doc_id, f] for (doc_id, *_), f in zip(rows, fp) if f is not None)
    assert all(r.component_id == least.get(root(r.fp & (1 << 64) - 1)) for r in got)
    kept = simhash.keep_one(docs)
    groups = {root(f) for f in known}
    assert kept.columns == docs.columns and kept.count() == len(groups) > len(least)  # one group has no id at all
    assert {r.doc_id for r in kept.collect()} == {*least.values(), None}
    twice = docs.sparkSession.createDataFrame([(1, "one two three four five"), (1, "a wholly other text of some words"), (1, "one two three four five"), (None, "no id but kept all the same"), (None, "no id but kept all the same")], "doc_id long, text string")
    assert Counter(r.text for r in simhash.keep_one(twice).collect()) == {t: 1 for t in ("one two three four five", "a wholly other text of some words", "no id but kept all the same")}
    assert simhash.near_groups(empty).count() == 0


@pytest.mark.parametrize("plan", [simhash.SHORT, simhash.LONG])
def test_links_join_all_that_are_near(spark, plan):
    rng = random.Random(2)
    base = [rng.getrandbits(64) for _ in range(12)]
    values = set(base) | {b ^ sum({1 << rng.randrange(64) for _ in range(rng.randint(1, 5))}) for b in base for _ in range(8)}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    near = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 4}
    got = {(r.a, r.b) for r in simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"), 4, plan).collect()}
    assert got <= near
    assert parts(got, signed) == parts(near, signed)


def parts(pairs, nodes):
    root = {x: x for x in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        root[find(a)] = find(b)
    least = {}
    for x in nodes:
        least[find(x)] = min(least.get(find(x), x), x)
    return {x: least[find(x)] for x in nodes}


def test_a_dense_family_costs_few_links(spark):
    """All pairs of 800 fingerprints within 4 bits of each other would be 319,600 links; each of the 45 probes makes one at most."""
    values = list({1 << a | 1 << b for a in range(41) for b in range(41)})[:800]
    got = simhash.links(spark.createDataFrame([(v,) for v in values], "fp long"), 4).collect()
    assert len(values) == 800 and len(got) < 45 * len(values) and len(set(parts({(r.a, r.b) for r in got}, values).values())) == 1


def test_long_segments_give_the_same_groups(docs):
    of = lambda plan: sorted(map(str, simhash.near_groups(docs, plan=plan).collect()))
    assert of(simhash.SHORT) == of(simhash.LONG)
    assert simhash.cost(simhash.SHORT, 10**6) < simhash.cost(simhash.LONG, 10**6) and simhash.cost(simhash.SHORT, 10**10) > simhash.cost(simhash.LONG, 10**10)


def test_language(docs, empty, rows):
    langs, log_p = languages.fit(docs)
    assert langs == ["de", "en"]
    got = languages.predict(docs, langs, log_p, [F.col("doc_id")]).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for doc_id, text, lang, _ in rows[:120]:
        assert by[doc_id].lang_pred == lang and 0 <= by[doc_id].score <= 1
    assert all(by[k].lang_pred == "und" and by[k].score == 0 for k in (200, 201, 202, 204))
    rng = random.Random(9)
    both = docs.sparkSession.createDataFrame([(1, prose(rng, 70, EN) + " " + prose(rng, 30, DE))], "doc_id long, text string")
    mixed = languages.predict(both, langs, log_p, [F.col("doc_id")]).first()
    assert mixed.lang_pred == "en" and re.match(r"en:0\.[67]\d*,de:0\.[23]", mixed.languages)
    assert languages.fit(empty)[0] == [] and languages.predict(docs, [], log_p[:, :0], [F.col("doc_id")]).where("lang_pred <> 'und'").count() == 0
