"""Each query without SQL, by its name, over whole tables of the smallest folder, against plain loops on what its contract says."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from tokenizers import Tokenizer

from annoframe.llm import queries
from annoframe.llm.tokens import tokenizer_path

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    return {r.doc_id: r.text or "" for r in rows}, {r.doc_id: r.lang for r in rows}


@pytest.fixture(scope="module")
def answer(spark):
    def of(name):
        rows = queries.QUERIES[name](spark, FOLDER).collect()
        return rows

    return of


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def library(name, texts):
    t = Tokenizer.from_file(tokenizer_path(name))
    return [x.ids for x in t.encode_batch(texts, add_special_tokens=False)]


def crc_part(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def test_op1(texts, answer):
    rows = answer("op1_quality_resampling")
    assert sorted(r.doc_id for r in rows) == sorted(texts[0])
    limit = min(r.score for r in rows if r.kept)
    assert all(r.kept == (r.score >= limit) and math.isclose(r.score, r.log_weight + r.gumbel) for r in rows)
    assert sum(r.kept for r in rows) == round(sum(math.exp(r.log_weight) for r in rows))


def test_op2(texts, answer):
    rows = answer("op2_transport_stream")
    assert len(rows) == len(texts[0])
    for r in rows:
        raw = texts[0][r.doc_id].encode()
        payload = raw + b"\xff" * (-len(raw) % 576 or (576 if not raw else 0))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
        assert r.media_bytes > len(payload) and r.media_bytes % 188 == 0 and r.feature


def test_op4(texts, answer):
    at, want = 0, set()
    order = sorted(texts[0])
    for k, ids in zip(order, library("byte_bpe_50k.json", [texts[0][k] for k in order])):
        ids = [*ids, 0]
        want.add((k, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert {(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in answer("op4_wavelet_tokens")} == want


def test_op5(texts, answer):
    fp = {}
    for k, text in texts[0].items():
        words = WORD.findall(lower(text))
        shingles = [" ".join(words[a : a + 4]) for a in range(max(1, len(words) - 3))] if words else []
        h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        fp[k] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    root = {k: k for k in fp}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in fp:
        for b in fp:
            if a < b and (fp[a] ^ fp[b]).bit_count() <= 4:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in answer("op5_simhash_groups")} == {(k, f"{f:016x}", find(k)) for k, f in fp.items()}


def test_op6(texts, answer):
    rows = answer("op6_language_mixture")
    assert sorted(r.doc_id for r in rows) == sorted(texts[0])
    learned = {texts[1][k] for k in texts[0] if crc_part(k, 3) != 1} - {None}
    for r in rows:
        assert r.held_out == (crc_part(r.doc_id, 3) == 1) and 0 <= r.score <= 1
        assert r.lang_pred == "und" if not any(c.isalpha() for c in texts[0][r.doc_id]) else r.lang_pred in learned
    held = [r for r in rows if r.held_out and texts[1][r.doc_id] and r.lang_pred != "und"]
    assert sum(r.lang_pred == texts[1][r.doc_id] for r in held) > 0.95 * len(held)


def test_op7(texts, answer):
    pieces, order = answer("op7_mixture_packing"), sorted(texts[0])
    of, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        of[p.doc_id].append(p)
        sequences[p.sequence_id].append(p)
    for k, ids in zip(order, library("word_bpe_49k.json", [texts[0][k] for k in order])):
        ids, at = [*ids, 2], 0
        for p in sorted(of.pop(k), key=lambda p: p.start):
            assert (p.start, p.doc_tokens, p.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids[at : at + p.length], "<u4").tobytes()))
            at += p.length
        assert at == len(ids)
    assert not of
    for k, own in sequences.items():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == 4096 or k == max(sequences)


def test_op8(texts, answer):
    tokens = {k: [*WORD.findall(lower(t)), None] for k, t in texts[0].items()}
    c = Counter(w for k, t in tokens.items() if crc_part(k, 7) != 2 for w in t)
    n, v = sum(c.values()), len(c)
    rows = answer("op8_maxent_scores")
    assert len(rows) == len(tokens)
    for r in rows:
        t = tokens[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (crc_part(r.doc_id, 7) == 2, len(t), sum(w in c for w in t), n)
        assert math.isclose(r.base_score, sum(math.log10((c[w] + 1) / (n + 1 * (v + 1))) for w in t), rel_tol=1e-9)
        assert math.isfinite(r.score) and r.score < 0


def test_op10(texts, answer):
    kinds = ("assign", "access", "hex")
    for r in answer("op10_secret_scan"):
        t, spans = texts[0][r.doc_id], []
        spans += [(m.start(), 0, m.end()) for m in re.finditer(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t) if len(m[2]) >= 12]
        spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
        spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16]
        told = ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in sorted(spans))
        n = Counter(k for _, k, _ in spans)
        assert (r.n_assign, r.n_access, r.n_hex, r.base_sha256) == (n[0], n[1], n[2], hashlib.sha256(told.encode()).hexdigest())
        assert set(told.split(",")) <= set(r.spans.split(","))
