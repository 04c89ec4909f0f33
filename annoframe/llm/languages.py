"""Operator 6, language ID: multilingual mixture inference by expectation-maximisation.

Each language has a model of hashed byte trigrams, counted over all labelled training texts.  A document is a bag of
words drawn from a mixture of languages; a word's likelihood under a language is the product over its trigrams (with a
space on either side).  EM, run to a tolerance, estimates the document's language proportions.  The language set is
selected by penalised likelihood (log-likelihood less penalty * log(words) per further language): it starts as the best
single language and takes in the language that raises it most, up to all languages, then drops languages as long as
that raises it.  The document's language is the one with the largest proportion in that set, ties by code.

Sets are tried by adding or dropping one language at a time, so one that only two additions at once would improve is not
found.  The models are as large as the number of languages times `BUCKETS`, whatever the input; a text takes memory for its
words times the languages.

Edge cases: null text or text without a letter is `und` with score 0 and no languages; without training texts every text
is `und`; rows with null lang train nothing; a null id counts as the text ``null`` when rows are dealt to the held-out
part; repeated rows train and are predicted each.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema
from .hashing import BLOCK, LOWER, SPACES, segments, slices

BUCKETS = 1 << 15
UNKNOWN = "und"
_SPACE = np.array([b in SPACES for b in range(256)])


def trigrams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of one block of texts: trigram buckets in order, where each word's trigrams begin, where each text's words begin.
    A word has a trigram around each of its bytes, with the space or byte on either side."""
    joined = b" " + b" ".join(texts) + b" "
    raw = np.frombuffer(joined.translate(LOWER), np.uint8)
    space = _SPACE[raw]
    raw = np.where(space, np.uint8(32), raw)
    inner = ~space[1:-1]
    x = raw.astype(np.uint32)
    code = (x[:-2] * np.uint32(0x9E3779B1) + x[1:-1] * np.uint32(0x85EBCA77) + x[2:] * np.uint32(0xC2B2AE3D)) >> np.uint32(17)
    begins = inner & space[:-2]
    words = np.flatnonzero(begins)
    gram_at = np.cumsum(inner) - inner
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    first = np.concatenate(([0], np.cumsum(sizes + 1)))
    return code[inner].astype(np.int64), gram_at[words], np.searchsorted(words, first)


def text_blocks(texts: list[bytes]) -> Iterator[tuple[list[int], list[bytes]]]:
    """Blocks of whole texts, about BLOCK // 4 bytes each; a longer text is alone in its block."""
    owners, parts, total = [], [], 0
    for k, t in enumerate(texts):
        if parts and total + len(t) > BLOCK // 4:
            yield owners, parts
            owners, parts, total = [], [], 0
        owners.append(k)
        parts.append(t)
        total += len(t) + 1
    if parts:
        yield owners, parts


def is_held_out(doc_id, mod: int, rest: int):
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("null"))), F.lit(mod)) == rest


def count_languages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for at, end, texts in slices(batch.column("text")):
            for lang in sorted(set(langs[at:end])):
                own = [p for t, x in zip(texts, langs[at:end]) if x == lang for p in segments(t, BLOCK // 4)]
                sums = counts.setdefault(lang, np.zeros(BUCKETS, np.int64))
                for _, parts in text_blocks(own):
                    sums += np.bincount(trigrams(parts)[0], minlength=BUCKETS)
    for lang, sums in sorted(counts.items()):
        some = np.flatnonzero(sums)
        yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(some), pa.string()), "bucket": pa.array(some, pa.int64()), "n": pa.array(sums[some], pa.int64())})


def fit(train: DataFrame, smooth: float = 0.5) -> tuple[list[str], np.ndarray]:
    """Languages in order of their code, and log-probabilities (bucket, language)."""
    counts = train.where("lang is not null and text is not null").select("text", "lang").mapInArrow(count_languages, "lang string, bucket long, n long")
    rows = counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()  # languages x BUCKETS at most
    langs = sorted(set(rows.column("lang").to_pylist()))
    sums = np.zeros((BUCKETS, len(langs)))
    place = {lang: k for k, lang in enumerate(langs)}
    sums[rows.column("bucket").to_numpy(), np.array([place[x] for x in rows.column("lang").to_pylist()], np.int64)] = rows.column("n").to_numpy()
    return langs, (np.log(sums + smooth) - np.log(sums.sum(0) + smooth * BUCKETS)).astype(np.float32)


def mixture(p: np.ndarray, n: np.ndarray, tolerance: float = 1e-3, rounds: int = 500) -> tuple[np.ndarray, np.ndarray]:
    """EM over documents at once, each until no proportion moves by more than the tolerance.  p: (words, languages)
    likelihoods, each row divided by its largest; n: each document's words (at least one).  Proportions (documents,
    languages); log-likelihoods less the rows' scale."""
    pi = np.full((len(n), p.shape[1]), 1 / p.shape[1], np.float32)
    todo, words, m = np.arange(len(n)), p, n
    for _ in range(rounds):
        share = words * np.repeat(pi[todo], m, axis=0)
        share /= share.sum(1, keepdims=True)
        now = (np.add.reduceat(share, np.cumsum(m) - m, axis=0) / m[:, None]).astype(np.float32)
        moves = np.abs(now - pi[todo]).max(1) > tolerance
        pi[todo] = now
        if not moves.any():
            break
        if not moves.all():
            todo, words, m = todo[moves], words[np.repeat(moves, m)], m[moves]
    first = np.cumsum(n) - n
    mixed = np.maximum((p * np.repeat(pi, n, axis=0)).sum(1, dtype=np.float32), np.float32(1e-37))
    return pi, np.add.reduceat(np.log(mixed).astype(np.float64), first)


def word_scores(texts: list[bytes], log_p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, languages): log-likelihood of each word less that of its best language, and where each text's words begin.
    A word's evidence is bounded, so that one long word doesn't decide a text."""

    def of(part: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        gram, word_first, doc_first = trigrams(part)
        score = np.add.reduceat(log_p[gram], word_first, axis=0) if len(word_first) else np.zeros((0, log_p.shape[1]), np.float32)
        return np.maximum(score - score.max(1, keepdims=True), np.float32(-30)), doc_first

    if len(texts) > 1 or len(texts[0]) <= BLOCK // 2:
        return of(texts)
    parts = [of([s])[0] for s in segments(texts[0], BLOCK // 4)]  # a long text's letters are never laid out at once
    return np.concatenate(parts), np.array([0, sum(map(len, parts))])


def infer(texts: list[bytes], log_p: np.ndarray, penalty: float = 2.0) -> tuple[np.ndarray, np.ndarray]:
    """(documents, languages): proportions within the selected set; proportions under the full mixture.
    Documents without words have zeros."""
    score, doc_first = word_scores(texts, log_p)
    n_all = np.diff(doc_first)
    some = np.flatnonzero(n_all)
    n_langs = log_p.shape[1]
    chosen, full = np.zeros((len(texts), n_langs)), np.zeros((len(texts), n_langs))
    if not len(some):
        return chosen, full
    n = n_all[some]
    first = np.cumsum(n) - n
    p = np.exp(score)
    pi, all_value = mixture(p, n)
    single = np.add.reduceat(score, first, axis=0)
    best_lang = single.argmax(1)
    best, picked = single[np.arange(len(n)), best_lang].astype(np.float64), np.zeros_like(pi)
    picked[np.arange(len(n)), best_lang] = 1

    def fitted(docs: np.ndarray, sets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Proportions and penalised likelihood of documents under sets (documents, size) of languages."""
        m = n[docs]
        inside = np.concatenate([np.arange(first[k], first[k] + n[k]) for k in docs])
        own, value = mixture(np.take_along_axis(p[inside], np.repeat(sets, m, axis=0), axis=1), m)
        return own, value - penalty * (sets.shape[1] - 1) * np.log(m)

    def better(docs: np.ndarray, tries: list[np.ndarray]) -> np.ndarray:
        """Takes each document's best set of those tried, if better than its own; whether it was."""
        before = best[docs].copy()
        for sets in tries:
            own, value = fitted(docs, sets)
            up = value > best[docs]
            best[docs[up]] = value[up]
            picked[docs[up]] = 0
            picked[docs[up][:, None], sets[up]] = np.maximum(own[up], np.float32(1e-9))
        return best[docs] > before

    # no set has a greater likelihood than all languages, so that most texts of one language are settled here
    todo, size = np.flatnonzero(all_value - penalty * np.log(n) > best), 1
    while len(todo) and size < n_langs:
        order = np.argsort(picked[todo] == 0, axis=1, kind="stable")  # own languages first
        won = better(todo, [np.concatenate((order[:, :size], order[:, k : k + 1]), axis=1) for k in range(size, n_langs)])
        todo, size = todo[won], size + 1
    sizes = (picked > 0).sum(1)
    for size in range(n_langs, 1, -1):
        todo = np.flatnonzero(sizes == size)
        if len(todo):
            order = np.argsort(picked[todo] == 0, axis=1, kind="stable")[:, :size]
            better(todo, [np.delete(order, k, axis=1) for k in range(size)])
            sizes = (picked > 0).sum(1)
    chosen[some], full[some] = picked, pi
    return chosen, full


def predict(docs: DataFrame, langs: list[str], log_p: np.ndarray, keep: list, penalty: float = 2.0) -> DataFrame:
    """The `keep` columns of each row with lang_pred, score (its proportion under the full mixture) and languages (the selected set with proportions)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = len(batch)
            lang, score, mixed = [UNKNOWN] * size, np.zeros(size), [""] * size
            letters = np.array(batch.column("letters").fill_null(False).to_pylist(), bool)
            for at, _, texts in slices(batch.column("text")) if langs else ():
                for owners, parts in text_blocks(texts):
                    chosen, full = infer(parts, log_p, penalty)
                    top = chosen.argmax(1)
                    for k, owner in enumerate(owners):
                        row = at + owner
                        if letters[row] and chosen[k].any():
                            lang[row] = langs[top[k]]
                            score[row] = min(1.0, max(0.0, float(full[k, top[k]])))
                            mixed[row] = ",".join(f"{langs[j]}:{chosen[k, j]:.3f}" for j in np.argsort(-chosen[k], kind="stable") if chosen[k, j] >= 0.0005)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(lang, pa.string()), pa.array(score), pa.array(mixed, pa.string())], names=["row", "lang_pred", "score", "languages"])

    rows = docs.select(F.struct(*keep).alias("row"), F.col("text"), F.col("text").rlike(r"\p{L}").alias("letters"))
    return rows.mapInArrow(run, arrow_schema(rows, "row", "lang_pred string, score double, languages string")).select("row.*", "lang_pred", "score", "languages")
