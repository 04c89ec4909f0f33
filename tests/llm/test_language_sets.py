"""Language sets of texts in more than three languages."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from annoframe.llm import languages

STEMS = {"en": ["the", "ing", "wh"], "de": ["ung", "sch", "ver"], "fi": ["kko", "ää", "yy"], "pl": ["rz", "cz", "wsk"], "fr": ["eau", "oi", "que"]}


def prose(rng, lang, n):
    return " ".join(rng.choice(STEMS[lang]) + rng.choice(STEMS[lang]) for _ in range(n))


@pytest.mark.parametrize("n_langs", [1, 2, 3, 4, 5])
def test_all_languages_of_a_text_are_found(spark, n_langs):
    rng = random.Random(5)
    kind = "doc_id long, text string, lang string"
    train = spark.createDataFrame([(k, prose(rng, lang, 200), lang) for k, lang in enumerate(sorted(STEMS) * 5)], kind)
    langs, log_p = languages.fit(train)
    mixed = [(k, " ".join(prose(rng, x, 60) for x in sorted(STEMS)[:n_langs]), None) for k in range(4)]
    for r in languages.predict(spark.createDataFrame(mixed, kind), langs, log_p, [F.col("doc_id")]).collect():
        got = dict(x.split(":") for x in r.languages.split(","))
        assert sorted(got) == sorted(STEMS)[:n_langs]
        assert all(abs(float(v) - 1 / n_langs) < 0.05 for v in got.values())


def plain_scores(text, log_p):
    out = []
    for w in text.lower().split():
        raw = b" " + w.encode() + b" "
        grams = [((raw[k - 1] * 0x9E3779B1 + raw[k] * 0x85EBCA77 + raw[k + 1] * 0xC2B2AE3D) % (1 << 32)) >> 17 for k in range(1, len(raw) - 1)]
        each = [sum(float(log_p[g, lang]) for g in grams) for lang in range(log_p.shape[1])]
        out.append([max(x - max(each), -30) for x in each])
    return out


def plain_em(scores, langs):
    pi = {x: 1 / len(langs) for x in langs}
    for _ in range(500):
        now = dict.fromkeys(langs, 0.0)
        for s in scores:
            share = {x: pi[x] * math.exp(s[x]) for x in langs}
            for x in langs:
                now[x] += share[x] / sum(share.values()) / len(scores)
        moved = max(abs(now[x] - pi[x]) for x in langs)
        pi = now
        if moved <= 1e-3:
            break
    return pi, sum(math.log(max(1e-37, sum(pi[x] * math.exp(s[x]) for x in langs))) for s in scores)


def plain_choice(scores, n_langs, penalty=2.0):
    def value(langs):
        pi, v = plain_em(scores, langs) if len(langs) > 1 else ({langs[0]: 1.0}, sum(s[langs[0]] for s in scores))
        return v - penalty * (len(langs) - 1) * math.log(len(scores)), pi

    best = max((value([x]) + ([x],) for x in range(n_langs)), key=lambda t: t[0])
    while len(best[2]) < n_langs:
        more = max((value(best[2] + [x]) + (best[2] + [x],) for x in range(n_langs) if x not in best[2]), key=lambda t: t[0])
        if more[0] <= best[0]:
            break
        best = more
    while len(best[2]) > 1:
        less = max((value([y for y in best[2] if y != x]) + ([y for y in best[2] if y != x],) for x in best[2]), key=lambda t: t[0])
        if less[0] <= best[0]:
            break
        best = less
    return best[1]


def test_em_and_choice_against_loops(spark):
    rng = random.Random(8)
    train = spark.createDataFrame([(k, prose(rng, lang, 60), lang) for k, lang in enumerate(sorted(STEMS) * 3)], "doc_id long, text string, lang string")
    langs, log_p = languages.fit(train)
    texts = [" ".join(prose(rng, x, rng.randint(2, 25)) for x in rng.sample(langs, rng.randint(1, 4))) for _ in range(25)]
    chosen, full = languages.infer([t.encode() for t in texts], log_p)
    for t, c, f in zip(texts, chosen, full):
        scores = plain_scores(t, log_p)
        pi, _ = plain_em(scores, list(range(len(langs))))
        assert all(abs(f[x] - pi[x]) < 0.01 for x in pi)
        want = plain_choice(scores, len(langs))
        assert {x for x in range(len(langs)) if c[x] > 0} == set(want) and all(abs(c[x] - v) < 0.01 for x, v in want.items())


def test_long_text_is_read_in_parts():
    rng = np.random.default_rng(3)
    log_p = rng.normal(size=(languages.BUCKETS, 3)).astype(np.float32)
    text = b" ".join(rng.choice([b"abc", b"defgh", b"i", b"jklmnopq"], 200_000))
    whole, _ = languages.word_scores([text, b""], log_p)
    parts, first = languages.word_scores([text], log_p)
    assert len(text) > languages.BLOCK // 2 and np.allclose(whole, parts) and first.tolist() == [0, 200_000]
