"""Operator 8, LM scoring: a hashed maximum-entropy model with class-factored softmax.

Every word has a path of digits from 0 to `BRANCH` - 1, and its probability is the product of one softmax for each digit,
given the digits before it and the history.  The `FREQUENT` first values of the first digit hold the most frequent training
words, `BRANCH` each, which two digits name.  All other words, unknown ones too, share the other values, by their last two
bytes, and then go by digits of their hash to about as many leaf classes as the square root of the vocabulary (`depth`
digits, which grows with it); in its leaf a word has its add-one share of the leaf's training tokens.  So every class of
words is modelled in its context, and leaves hold few frequent words each.

The first softmax has hashed features of the word before, of the two before together, and of the one before the last alone (a
skip feature); later ones have the word before and the skip feature, each together with the digits so far.  Every softmax
starts from the training shares.

Training: rounds over disjoint folds of the training texts, so that all take part once.  In a round each shard of a fold
makes AdaGrad steps on its texts from the same weights; the changes of each weight row that a shard touched are averaged by
how often, in one aggregation, and added on the driver.  A text's fold, shard and place in it follow from a hash of the row, and
the number of shards from the number of training tokens (`shards_for`), so weights and scores are the same on any cluster
and however the input is split.  A round's weights and shuffles leave the disks with it.  What is exchanged grows with rounds, shards and weight rows (`WEIGHT_ROWS` x `BRANCH` floats at
most).  Scoring runs in sparse batches: only weight rows of
features that occur.

Counts of all training words are kept as a table of hashes.  Scoring looks the `common` most frequent ones up inside tasks;
all other words of a text are joined with the table, so nothing that grows with the corpus is sent to tasks or the driver but
one number per leaf.  Words are told apart by 64-bit hashes; with a billion distinct words the odds that any given one
shares its hash are below 1 in 10**10.

Edge cases: null or empty text is the end token alone; without training texts all counts are 0 and the model is uniform
over its leaves; repeated rows train and are scored each; a null id counts as the text ``null`` when rows are dealt to
the held-out part.  Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_schema, shuffles_dropped, stored
from .hashing import hashed_tokens, mix, slices

BRANCH, FREQUENT = 32, 16
BITS = 5  # of a digit
HEAD = FREQUENT * BRANCH  # words with a path of their own
TAILS = BRANCH - FREQUENT
ROWS1, ROWS2 = 1 << 14, 1 << 15  # weight rows of each feature of the first digit, and of later ones; 16-bit numbers sort fast
WEIGHT_ROWS = 3 * ROWS1 + 2 * ROWS2
END = np.uint64(0)
BEFORE = np.uint64(1)  # stands before the first word
K1, K2, K3, K4 = (np.uint64(k) for k in (0xA24BAED4963EE407, 0x9FB21C651E98DF25, 0xC13FA9A902A6328F, 0xD1B54A32D192ED03))
BATCH = 1 << 14
SHARD, FEWEST, MOST = 8_000_000, 6, 4096  # training tokens of a shard in a round; shards in a round, at least and at most


class Vocabulary(NamedTuple):
    words: np.ndarray  # hashes of the words of the head, sorted
    rank: np.ndarray  # of each: place by frequency
    prior: list[np.ndarray]  # of each digit: (nodes, BRANCH) log share of the digit's values
    tail: np.ndarray  # log10 of the denominator of each leaf

    @property
    def depth(self) -> int:
        return len(self.prior)


class Weights(NamedTuple):
    first: np.ndarray  # (3 * ROWS1, BRANCH)
    later: np.ndarray  # (2 * ROWS2, BRANCH)


class Step(NamedTuple):
    """One digit of some tokens."""

    which: np.ndarray | slice  # the tokens that have it
    node: np.ndarray  # of each: number of the digits before it
    digit: np.ndarray


def tail_class(tail: np.ndarray) -> np.ndarray:
    return ((tail.astype(np.uint32) * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.int64) % TAILS


def depth_for(n_words: int) -> int:
    """Digits that give about the square root of n leaves (the nearest power), two at least."""
    return max(2, 1 + round((math.log2(max(1, n_words)) / 2 - math.log2(TAILS)) / BITS))


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words with an end after each text; tail classes; where texts begin (one more than texts)."""
    h, first, tail = hashed_tokens(texts)
    h = np.where(h == END, np.uint64(2), h)
    return np.insert(h, first[1:], END), np.insert(tail_class(tail), first[1:], 0), first + np.arange(len(first))


def histories(t: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words one and two places before each."""
    one = np.concatenate(([BEFORE], t[:-1]))[: len(t)]
    one[first[:-1]] = BEFORE
    two = np.concatenate(([BEFORE], one[:-1]))[: len(t)]
    two[first[:-1]] = BEFORE
    return one, two


def features(one: np.ndarray, two: np.ndarray) -> list[np.ndarray]:
    """Weight rows of the first digit's features, each counted from its own first row."""
    return [(mix(x) & np.uint64(ROWS1 - 1)).astype(np.uint16) for x in (one * K1, one * K2 + two * K3, two * K4)]


def later_features(one: np.ndarray, two: np.ndarray, level: int, node: np.ndarray) -> list[np.ndarray]:
    """The same of a later digit; level: which digit, from 1."""
    own = node.astype(np.uint64) * np.uint64(64) + np.uint64(level)
    return [(mix(x) & np.uint64(ROWS2 - 1)).astype(np.uint16) for x in (one * K3 + own * K1, two * K2 + own * K4)]


def digits(v: Vocabulary, t: np.ndarray, tails: np.ndarray) -> tuple[list[Step], np.ndarray, np.ndarray]:
    """The steps of all tokens' paths; which tokens are not of the head; the leaf of each of those."""
    at = np.minimum(np.searchsorted(v.words, t), len(v.words) - 1)
    head = v.words[at] == t
    rank = v.rank[at]
    digit = lambda k, x: (x >> np.uint64(BITS * k)).astype(np.int64) & (BRANCH - 1)
    first = np.where(head, rank // BRANCH, FREQUENT + tails)
    second = np.where(head, rank % BRANCH, digit(0, t))
    every = slice(None)
    steps = [Step(every, np.zeros(len(t), np.int64), first), Step(every, first, second)]
    rest = np.flatnonzero(~head)
    leaf = tails[rest] * BRANCH + second[rest]
    for k in range(1, v.depth - 1):
        steps.append(Step(rest, leaf, digit(k, t[rest])))
        leaf = leaf * BRANCH + steps[-1].digit
    return steps, rest, leaf


def softmax(x: np.ndarray) -> np.ndarray:
    x -= x.max(1, keepdims=True)
    np.exp(x, out=x)
    x /= x.sum(1, keepdims=True)
    return x


def chances(tables: list[np.ndarray], rows: list[np.ndarray], prior: np.ndarray, node: np.ndarray) -> np.ndarray:
    x = tables[0][rows[0]]
    for table, f in zip(tables[1:], rows[1:]):
        x += table[f]
    x += prior[node] if len(prior) > 1 else prior
    return softmax(x)


def parts(x: np.ndarray, level: int) -> list[np.ndarray]:
    """The rows of each feature of a digit, of an array with a row for each weight row."""
    size = ROWS2 if level else ROWS1
    return [x[k : k + size] for k in range(0, len(x), size)]


def rows_of(level: int, one: np.ndarray, two: np.ndarray, node: np.ndarray) -> list[np.ndarray]:
    return later_features(one, two, level, node) if level else features(one, two)


def update(table: np.ndarray, squares: np.ndarray, touched: np.ndarray, f: np.ndarray, grad: np.ndarray, rate: float) -> None:
    """One AdaGrad step for the rows of one feature; a row's numbers share one sum of squares."""
    order = np.argsort(f, kind="stable")
    now = f[order]
    first = np.flatnonzero(np.concatenate(([True], now[1:] != now[:-1])))
    n = np.diff(np.append(first, len(f)))
    sums = grad[order[first]]
    more = np.flatnonzero(n > 1)
    if len(more):  # summing rows met once would only copy them
        sums[more] = np.add.reduceat(grad[order[np.repeat(n > 1, n)]], np.cumsum(n[more]) - n[more], axis=0)
    rows = now[first]
    squares[rows] += np.einsum("ij,ij->i", sums, sums)
    sums *= (rate / np.sqrt(squares[rows]))[:, None]
    table[rows] -= sums
    touched[rows] += n


def no_weights() -> Weights:
    return Weights(np.zeros((3 * ROWS1, BRANCH), np.float32), np.zeros((2 * ROWS2, BRANCH), np.float32))


def trainer(model: Broadcast, rate: float, damping: float):
    """model: the classes and the weights to start from, None for zeros."""

    def one_shard(columns: Iterator[pa.Array]) -> Iterator[pa.RecordBatch]:
        v, start = model.value
        start = start or no_weights()
        w = Weights(start.first.copy(), start.later.copy())
        squares = [np.full(len(x), damping, np.float32) for x in w]  # rows that are rarely met move little
        touched = [np.zeros(len(x), np.int64) for x in w]
        for column in columns:
            for _, _, texts in slices(column, size=1 << 20):
                t, tails, first = tokens(texts)
                one, two = histories(t, first)
                for a in range(0, len(t), BATCH):
                    s = slice(a, a + BATCH)
                    o, u = one[s], two[s]
                    for level, (which, node, digit) in enumerate(digits(v, t[s], tails[s])[0]):
                        if not len(digit):
                            continue
                        k, rows = min(level, 1), rows_of(level, o[which], u[which], node)
                        p = chances(parts(w[k], level), rows, v.prior[level], node)
                        p[np.arange(len(digit)), digit] -= 1
                        for f, *tables in zip(rows, *(parts(x[k], level) for x in (w, squares, touched))):
                            update(*tables, f, p, rate)
        for k in range(2):
            rows = np.flatnonzero(touched[k])
            n = touched[k][rows]
            change = (w[k][rows] - start[k][rows]) * n[:, None]
            names = ["layer", "row", "n", *[f"w{j}" for j in range(BRANCH)]]
            yield pa.RecordBatch.from_arrays([pa.array([k] * len(rows), pa.int32()), pa.array(rows, pa.int64()), pa.array(n), *[pa.array(np.ascontiguousarray(change[:, j], np.float32)) for j in range(BRANCH)]], names=names)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows in order of shard; each shard by itself."""

        def runs() -> Iterator[tuple[int, pa.Array]]:
            for batch in batches:
                shard = batch.column("shard").to_numpy()
                ends = [0, *(np.flatnonzero(shard[1:] != shard[:-1]) + 1).tolist(), len(shard)]
                for a, b in zip(ends, ends[1:]):
                    if b > a:
                        yield int(shard[a]), batch.column("text")[a:b]

        for _, own in groupby(runs(), key=lambda x: x[0]):
            yield from one_shard(column for _, column in own)

    return train


CHANGES = "layer int, row long, n long, " + ", ".join(f"w{j} float" for j in range(BRANCH))


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash, tail class and count of the words of each few million tokens."""

    def merged(parts: list) -> pa.RecordBatch:
        t, c = np.concatenate([x[0] for x in parts]), np.concatenate([x[1] for x in parts])
        h, at, n = np.unique(t, return_index=True, return_counts=True)
        return pa.RecordBatch.from_pydict({"h": pa.array(h.view(np.int64)), "tail": pa.array(c[at].astype(np.int16)), "n": pa.array(n.astype(np.int64))})

    parts, size = [], 0
    for batch in batches:
        for _, _, texts in slices(batch.column("text")):
            parts.append(tokens(texts))
            size += len(parts[-1][0])
            if size > 5_000_000:
                yield merged(parts)
                parts, size = [], 0
    if parts:
        yield merged(parts)


class Counts(NamedTuple):
    table: DataFrame  # h, tail, c of every training word
    n: int
    v: int


def counted(train: DataFrame) -> Counts:
    words = train.select("text").mapInArrow(count_words, "h long, tail short, n long")
    with shuffles_dropped(train.sparkSession):
        table = stored(words.groupBy("h").agg(F.first("tail").alias("tail"), F.sum("n").alias("c")), "word-counts")
    n, v = table.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    return Counts(table, n, v)


def vocabulary(counts: Counts, common: int, depth: int | None = None) -> tuple[Vocabulary, np.ndarray, np.ndarray]:
    """The classes; hashes (sorted) and counts of the `common` most frequent words, the end among them."""
    top = counts.table.orderBy(F.desc("c"), "h").select("h", "tail", "c").limit(common).toArrow()
    h, tail, c = (top.column(x).to_numpy().astype(np.int64) for x in ("h", "tail", "c"))
    h = h.view(np.uint64)
    if END not in h:  # a word of its own even if rare
        row = counts.table.where("h = 0").select("c").first()
        h, tail, c = np.insert(h, 0, END), np.insert(tail, 0, 0), np.insert(c, 0, row.c if row else 0)
    head = np.argsort(-c, kind="stable")[:HEAD]
    end = int(np.flatnonzero(h == END)[0])
    if end not in head:
        head[-1] = end
    depth = depth or depth_for(counts.v)
    leaf = F.col("tail").cast("long")
    for k in range(depth - 1):
        leaf = leaf * BRANCH + F.shiftrightunsigned("h", BITS * k).bitwiseAND(F.lit(BRANCH - 1))
    sums = counts.table.groupBy(leaf.alias("leaf")).agg(F.sum("c").alias("n"), F.count("*").alias("v")).toArrow()  # about sqrt(v) rows
    n = np.zeros((2, TAILS * BRANCH ** (depth - 1)))
    for k, x in enumerate(("n", "v")):
        n[k, sums.column("leaf").to_numpy()] = sums.column(x).to_numpy()
    own = tail[head]
    for k in range(depth - 1):
        own = own * BRANCH + ((h[head] >> np.uint64(BITS * k)).astype(np.int64) & (BRANCH - 1))
    there = c[head] > 0
    np.subtract.at(n, (0, own[there]), c[head][there])
    np.subtract.at(n, (1, own[there]), 1)
    mass = n.sum(0) + 1  # of each leaf, with one for unknown words
    of_head = np.zeros(HEAD)
    of_head[: len(head)] = c[head] + 1
    levels, now = [], mass
    for _ in range(depth - 2):
        levels.insert(0, now.reshape(-1, BRANCH))
        now = levels[0].sum(1)
    levels.insert(0, np.concatenate((of_head, now)).reshape(BRANCH, BRANCH))
    levels.insert(0, levels[0].sum(1)[None, :])
    with np.errstate(divide="ignore", invalid="ignore"):
        prior = [np.where(x > 0, np.log(x / x.sum(1, keepdims=True)), -1e4).astype(np.float32) for x in levels]
    order = np.argsort(h[head])
    v = Vocabulary(h[head][order], order, prior, np.log10(mass))
    order = np.argsort(h)
    return v, h[order], c[order]


def shards_for(tokens: int, rounds: int) -> int:
    return min(MOST, max(FEWEST, -(-tokens // (rounds * SHARD))))


@contextmanager
def sent(spark: SparkSession, value: object) -> Iterator[Broadcast]:
    """A value that tasks read, whose copies on the disks of the driver and all executors go at the end."""
    one = spark.sparkContext.broadcast(value)
    try:
        yield one
    finally:
        one.destroy(blocking=True)


def train(docs: DataFrame, v: Vocabulary, rounds: int = 3, shards: int = FEWEST, rate: float = 1.0, damping: float = 10.0) -> Weights:
    """docs: text, key (a hash of the row).  Rows with one key are the same row."""
    w = no_weights()
    dealt = docs.withColumn("shard", F.pmod(F.xxhash64(F.lit(5), "key"), F.lit(shards)).cast("int"))
    for k in range(rounds):
        fold = dealt.where(F.pmod(F.xxhash64(F.lit(3), "key"), F.lit(rounds)) == k)
        fold = fold.repartitionById(shards, "shard").sortWithinPartitions("shard", "key").select("shard", "text")
        means = [(F.sum(f"w{j}") / F.sum("n")).cast("float").alias(f"w{j}") for j in range(BRANCH)]
        with sent(docs.sparkSession, (v, w if k else None)) as model, shuffles_dropped(docs.sparkSession):
            got = fold.mapInArrow(trainer(model, rate, damping), CHANGES).groupBy("layer", "row").agg(*means).toArrow()  # WEIGHT_ROWS at most
        layers, rows = got.column("layer").to_numpy(), got.column("row").to_numpy()
        for layer in range(2):
            own = layers == layer
            for j in range(BRANCH):
                w[layer][rows[own], j] += got.column(f"w{j}").to_numpy()[own]
    return w


def log_chances(v: Vocabulary, w: Weights, t: np.ndarray, tails: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """log10 probability of each token, for words outside the head less the logarithm of their count and one; which those are."""
    one, two = histories(t, first)
    out, outside = np.zeros(len(t)), np.zeros(len(t), bool)
    for a in range(0, len(t), BATCH):
        s = slice(a, a + BATCH)
        o, u = one[s], two[s]
        steps, rest, leaf = digits(v, t[s], tails[s])
        part = out[s]
        for level, (which, node, digit) in enumerate(steps):
            if len(digit):
                p = chances(parts(w[min(level, 1)], level), rows_of(level, o[which], u[which], node), v.prior[level], node)
                part[which] += np.log10(np.maximum(p[np.arange(len(digit)), digit], np.float32(1e-30)))
        part[rest] -= v.tail[leaf]
        outside[a + rest] = True
    return out, outside


def scorer(fitted: Broadcast):
    """A function for mapInArrow over (row, key, text): row, key, tokens, the parts of both scores that need no join, and
    the other words with their numbers.  fitted: classes, weights, the common words (sorted) and their counts."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, w, words, counts = fitted.value
        log_counts = np.log10(counts + 1.0)
        for batch in batches:
            for a, b, texts in slices(batch.column("text"), size=1 << 20):
                t, tails, first = tokens(texts)
                size = b - a
                owner = np.repeat(np.arange(size), np.diff(first))
                model, outside = log_chances(v, w, t, tails, first)
                place = np.minimum(np.searchsorted(words, t), len(words) - 1)
                common = words[place] == t
                base = np.where(common, log_counts[place], 0.0)
                known = common & (counts[place] > 0)
                model += np.where(outside, base, 0.0)
                rare_owner, rare = owner[~common], t[~common].view(np.int64)
                order = np.lexsort((rare, rare_owner))
                rare_owner, rare = rare_owner[order], rare[order]
                new = np.ones(len(rare), bool)
                new[1:] = (rare[1:] != rare[:-1]) | (rare_owner[1:] != rare_owner[:-1])
                begin = np.flatnonzero(new)
                times = np.diff(np.append(begin, len(rare)))
                ends = np.searchsorted(rare_owner[begin], np.arange(size + 1))
                items = pa.StructArray.from_arrays([pa.array(rare[begin], pa.int64()), pa.array(times, pa.int64())], names=["h", "n"])
                total = lambda x: np.bincount(owner, x, minlength=size)  # noqa: E731, B023
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row")[a:b], batch.column("key")[a:b], pa.array(np.diff(first)), pa.array(total(known).astype(np.int64)), pa.array(total(base)), pa.array(total(model)), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), items)],
                    names=["row", "key", "n_tokens", "n_common", "base", "model", "rare"],
                )

    return score


def scored(docs: DataFrame, held_out, keep: list, common: int = 1 << 17, **training) -> DataFrame:
    """The `keep` columns of each row with n_tokens, n_known, train_tokens, base_score, score.
    held_out: a condition; rows that meet it are not learnt from."""
    learn = docs.where(~held_out).select("text", F.xxhash64("text", *keep).alias("key"))
    counts = counted(learn)
    v, words, c = vocabulary(counts, common)
    w = train(learn, v, **({"shards": shards_for(counts.n, training.get("rounds", 3))} | training))
    rows = docs.select(F.struct(*keep).alias("row"), F.monotonically_increasing_id().alias("key"), "text")
    schema = arrow_schema(rows, "row, key", "n_tokens long, n_common long, base double, model double, rare array<struct<h:long,n:long>>")
    with sent(docs.sparkSession, (v, w, words, c)) as model:
        first = stored(rows.mapInArrow(scorer(model), schema), "scored")
    other = first.select("key", F.explode("rare").alias("x")).select("key", "x.h", "x.n")
    met = other.join(counts.table.select("h", "c"), "h")  # words that are not there have count 0 and add nothing
    late = met.groupBy("key").agg(F.sum("n").alias("n_late"), F.sum(F.col("n") * F.log10(F.col("c") + 1.0)).alias("log_late"))
    log_late = F.coalesce("log_late", F.lit(0.0))
    base = F.col("base") + log_late - F.col("n_tokens") * F.log10(F.lit(float(counts.n + counts.v + 1)))
    out = first.drop("rare").join(late, "key", "left")
    return out.select("row.*", "n_tokens", (F.col("n_common") + F.coalesce("n_late", F.lit(0))).alias("n_known"), F.lit(counts.n).cast("long").alias("train_tokens"), base.alias("base_score"), (F.col("model") + log_late).alias("score"))
