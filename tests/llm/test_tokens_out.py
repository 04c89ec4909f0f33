"""Token files and packing against the tokenizers library and a plain round-robin."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from annoframe.llm import packing, wavelet
from annoframe.llm.tokens import memo, tokenizer_path


def library(name, texts):
    """Ids as a fresh tokenizer gives them."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path(name))
    return [t.encode(x or "", add_special_tokens=False).ids for x in texts]


@pytest.mark.parametrize(("name", "space"), [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_chunk_memo_gives_the_librarys_ids(name, space):
    rng, m = random.Random(5), memo(tokenizer_path(name), space)
    parts = ["a", "The", ".", "''", "'s", " ", "  ", "\n", "\n\n", "\t", " ", "　", "é", "ß", "İ", "é", "Σ", "12", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "<", "\x00", "日本", "👍🏽"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(3000)]
    assert [np.frombuffer(x, "<u4").tolist() for x in m.encode(texts)] == library(name, texts)


def test_select_and_count():
    rng = np.random.default_rng(1)
    for n in (0, 1, 700, 600_000):
        ids = rng.integers(0, 40, n)
        w = wavelet.WaveletMatrix(wavelet.encode(ids, np.array([0, n])))
        assert (w.decode() == ids).all()
        for i in range(0, n, max(1, n // 5)):
            assert w.access(i) == ids[i] and w.count(int(ids[i]), 0, i) == (ids[:i] == ids[i]).sum()
        for value in set(ids[:3].tolist()):
            places = np.flatnonzero(ids == value)
            assert all(w.occurrence(value, k) == places[k] for k in range(0, len(places), max(1, len(places) // 4))) and w.occurrence(value, len(places)) is None


def test_wavelet_tokens(spark, docs, empty, rows):
    hashes = {r.text: r.h for r in spark.createDataFrame([(t,) for t in {r[1] for r in rows}], "text string").select("text", F.xxhash64("text").alias("h")).collect()}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, hashes[r[1]]))
    at, want = 0, []
    for (doc_id, *_), ids in zip(order, library("byte_bpe_50k.json", [r[1] for r in order])):
        raw = np.array([*ids, 0], "<u4").tobytes()
        want.append((doc_id, at, len(raw) // 4, zlib.crc32(raw)))
        at += len(raw) // 4
    for kw in ({}, {"shard_ids": 500}, {"shard_ids": 1}):
        assert Counter(tuple(r) for r in wavelet.token_table(docs, **kw).collect()) == Counter(want)
    assert wavelet.token_table(empty).count() == 0


def plain_round_robin(queues, quanta):
    """queues: lists of (name, length) in order of turn.  Names in the order that they go out."""
    owed, out, n = [0.0] * len(queues), [], 0
    taken, queues = [0] * len(queues), [list(q) for q in queues]
    while any(queues):
        n += 1
        for k, queue in enumerate(queues):
            owed[k] = n * quanta[k] - taken[k]  # the deficit and a quantum
            while queue and queue[0][1] <= owed[k] + 1e-6:
                name, length = queue.pop(0)
                out.append((name, length))
                taken[k] += length
                owed[k] -= length
    return out


@pytest.mark.parametrize("piece", [24, None])
@pytest.mark.parametrize("targets", [None, {"s0": 1, "s1": 5, "s2": 2.5, "s3": 1e-3, None: 2}])
def test_packing_is_deficit_round_robin(docs, rows, targets, piece):
    window = 64
    got = packing.pack(docs, targets, window=window, piece=piece).collect()
    counts = Counter()
    for p in got:
        counts[p.source] += p.length
    weights = {s: (targets or counts)[s] for s in counts}
    quantum = {s: window * w / sum(weights.values()) for s, w in weights.items()}
    ends = Counter()  # where a queue's rounds end, for cuts that follow them

    def starts(source, n):
        if piece:
            return list(range(0, n, piece))
        step, first = quantum[source] * math.ceil(packing.LEAST / quantum[source]), ends[source]
        ends[source] += n
        return [0] + [a - first for m in range(int(first / step), int((first + n) / step) + 2) if 0 < (a := math.floor(m * step)) - first < n]

    # a queue's order is that of its documents' first tokens in the sequences; its documents and lengths are the library's
    queues, found = defaultdict(list), Counter()
    for p in sorted(got, key=lambda p: (p.sequence_id, p.offset)):
        if p.start == 0:
            own = starts(p.source, p.doc_tokens)
            queues[p.source] += [((p.doc_id, p.doc_tokens, a), b - a) for a, b in zip(own, [*own[1:], p.doc_tokens])]
            found[p.doc_id, p.doc_tokens, p.source] += 1
    assert found == Counter((r[0], len(x) + 1, r[3]) for r, x in zip(rows, library("word_bpe_49k.json", [r[1] for r in rows])))
    order = sorted(queues, key=lambda s: (s is None, s or ""))
    size = {s: sum(n for _, n in queues[s]) for s in order}
    weight = {s: (targets or size)[s] for s in order}
    plan = plain_round_robin([queues[s] for s in order], [window * weight[s] / sum(weight.values()) for s in order])
    at, want = 0, Counter()
    for (doc_id, n, start), length in plan:
        done = 0
        while done < length:
            sequence, offset = divmod(at, window)
            take = min(length - done, window - offset)
            want[doc_id, n, start + done, take, sequence, offset] += 1
            done += take
            at += take
    assert Counter((p.doc_id, p.doc_tokens, p.start, p.length, p.sequence_id, p.offset) for p in got) == want


@pytest.mark.parametrize(("window", "piece"), [(64, 24), (4096, 1024), (100, 4000), (64, None), (4096, None)])
def test_packing_loses_nothing(docs, empty, rows, window, piece):
    whole = Counter((r[0], r[3], np.array([*x, 2], "<u4").tobytes()) for r, x in zip(rows, library("word_bpe_49k.json", [r[1] for r in rows])))
    pieces = packing.pack(docs, window=window, piece=piece).collect()
    sequences, texts = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert zlib.crc32(p.ids) == p.ids_crc32 and len(p.ids) == 4 * p.length > 0
        sequences[p.sequence_id].append(p)
        texts[p.doc_id, p.source, p.doc_tokens].append(p)
    total = sum(len(i) // 4 * n for (_, _, i), n in whole.items())
    assert sum(p.length for p in pieces) == total and len(sequences) == math.ceil(total / window)
    for k, own in sequences.items():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == min(window, total - k * window)
    for (doc_id, source, n), own in texts.items():
        if sum(p.length for p in own) == n:
            assert whole[doc_id, source, b"".join(p.ids for p in sorted(own, key=lambda p: p.start))] == 1
    assert packing.pack(empty).count() == 0


def test_windows_of_many_sources_hold_their_targets(spark):
    """As the query packs: 20 sources, one of a third of all tokens and one of few."""
    rng = random.Random(8)
    sources = [f"s{k}" for k in range(18)] + ["hot"] * 10
    rows = [(k, " ".join(rng.choice("abcdefgh") for _ in range(rng.choice([3, 30, 300, 2000]))), rng.choice(sources)) for k in range(600)] + [(600, "a b c " * 15, "few")]
    pieces = packing.pack(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)).collect()
    share, of = Counter(), defaultdict(Counter)
    for p in pieces:
        share[p.source] += p.length
        of[p.sequence_id][p.source] += p.length
    total, last = sum(share.values()), max(of)
    off = sorted(sum(abs(own[s] / 4096 - share[s] / total) for s in share) / 2 for k, own in of.items() if k < last)
    assert len(share) == 20 and len(off) > 20 and off[len(off) // 2] < 0.02 and off[-2] < 0.1
    assert len(pieces) < len(rows) + 2 * 20 * (last + 1)


def test_windows_hold_target_shares_and_short_documents_stay_whole(spark):
    rng = random.Random(2)
    rows = [(k, " ".join(rng.choice("abcdefgh") for _ in range(rng.randint(5, 60))), rng.choice(["x", "x", "x", "y", "z"])) for k in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    pieces = packing.pack(docs, window=1024, piece=64).collect()
    total, share, of = sum(p.length for p in pieces), Counter(), defaultdict(Counter)
    for p in pieces:
        share[p.source] += p.length
        of[p.sequence_id][p.source] += p.length
    for k, own in of.items():
        if k < len(of) - 1:
            for s in share:
                assert abs(own[s] - 1024 * share[s] / total) <= 3 * 64  # a deficit of each source, and its own at either end
    assert len(pieces) <= len(rows) + len(of)  # cut at ends of sequences only
    with pytest.raises(Exception, match="no positive target"):
        packing.pack(docs, {"x": 1, "y": 0}).count()
