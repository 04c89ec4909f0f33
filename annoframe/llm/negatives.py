"""Operator 11, hard-negative mining: largest inner products by coordinate pruning in length buckets.

Rows are sorted by vector length and cut into buckets of at most `BUCKET` rows whose lengths differ by a tenth at most.  A
bucket holds, for each coordinate, its unit vectors' values in order.  An anchor q that needs products of at least t takes
from a bucket with greatest length l only unit vectors within the angle whose cosine is c = t / (|q| l).  Each coordinate x
of such a vector lies within c y - r and c y + r for the anchor's unit coordinate y, where r = sqrt((1 - c^2)(1 - y^2)) (up
to 1 if y >= c, down to -1 if y <= -c).  The sorted lists of the anchor's largest coordinates give those ranges by bisection;
the shortest is taken, and what the others leave of it is verified by exact products.  Where no range rules out much, the
whole bucket is verified at once.  Nothing that reaches t is lost: ranges are widened by more than rounding can hide.

Two searches of all buckets.  First the `POSITIVES` best rows of an anchor's own label; t is the worst of the best seen so far
in a task.  Then, for each positive of score p, the `NEGATIVES` best rows of other labels with scores from 0.8 p to p; t is the
least score that any of the anchor's positives can still take.

Anchors are a stated query set (one row in a hundred).  They and the buckets are packed into table rows of bounded size; each
pair of a pack of anchors and a group of buckets is one cogrouped task, buckets in order of falling length, so neither side
is ever sent to all tasks, and no label, length or vector that is frequent makes a task larger.  Each task returns a few rows for
each anchor, and these meet in a window by anchor (and positive).

Edge cases: rows with a null label, a null vector, or a null or non-finite component take no part; a vector without components has product
0 with all.  Missing components of a shorter vector count as 0.  Null vec_ids are no anchors and come last in ties; rows that repeat a
vec_id are rows of their own, each.  A negative positive score allows no negatives.  Components beyond 2^62 / 256, and scores
beyond 64 bits, are errors.  An anchor without positives, or a positive without fitting negatives, has no rows.
Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, stored

POSITIVES, NEGATIVES = 5, 5
BUCKET, NARROW = 4096, 0.9  # rows of a bucket, and its least length as a share of its greatest
ANCHORS, GROUP = 4096, 16  # anchors of a pack, buckets of a group
FOCUS = 8  # coordinates whose ranges are looked up
MOST = 0.5  # share of a bucket from which it is verified whole
LAST = np.iinfo(np.int64).max  # stands for a null vec_id
PACKED = "number long, lengths binary, rows long, dims int, ids binary, labels binary, vectors binary"


def usable(vectors: DataFrame, anchors_every: int = 100) -> DataFrame:
    """vectors: vec_id, embedding, label.  id, label (number of the class), v (whole numbers), squared (length), anchor of the rows that take part."""
    sound = F.col("label").isNotNull() & F.col("embedding").isNotNull() & F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < math.inf))
    x = lambda c: F.floor(c.cast("double") * 256)
    fits = F.forall("embedding", lambda c: F.abs(c.cast("double")) < float(1 << 54))
    said = F.concat(F.lit("component too large in vector "), F.coalesce(F.col("vec_id").cast("string"), F.lit("null")))
    rows = vectors.where(sound).where(F.assert_true(fits, said).isNull())
    rows = rows.select(F.coalesce(F.col("vec_id").cast("long"), F.lit(LAST)).alias("id"), F.col("label").cast("long").alias("label"), F.transform("embedding", x).alias("v"), F.coalesce(F.col("vec_id") % anchors_every == 0, F.lit(False)).alias("anchor"))
    return rows.withColumn("squared", F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double")))


def packs(rows: DataFrame, most: int, narrow: float) -> DataFrame:
    """Rows in order of falling length, packed: at most `most` of them and of lengths that differ by `narrow` at most."""
    sorted_ = rows.repartitionByRange(F.desc("squared"), F.xxhash64("id")).sortWithinPartitions(F.desc("squared"), F.xxhash64("id"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24  # as partitions are, packs are in order of falling length
        ids, labels, vectors, lengths = [], [], [], []

        def full() -> pa.RecordBatch:
            nonlocal number
            dims = max(map(len, vectors))
            table = np.zeros((len(vectors), dims), np.int64)
            for row, v in zip(table, vectors):
                row[: len(v)] = v
            least = next(t for t in (np.int16, np.int32, np.int64) if not table.size or max(-table.min(), table.max()) <= np.iinfo(t).max)
            number += 1
            out = {"number": [number], "lengths": [np.array(lengths).tobytes()], "rows": [len(ids)], "dims": [dims], "ids": [np.array(ids, np.int64).tobytes()], "labels": [np.array(labels, np.int64).tobytes()], "vectors": [table.astype(least).tobytes()]}
            for x in (ids, labels, vectors, lengths):
                x.clear()
            return pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in PACKS], schema=PACKS)

        for batch in batches:
            flat = batch.column("v").flatten().to_numpy()
            ends = np.cumsum([0, *batch.column("v").value_lengths().to_pylist()])
            for k, (own, label, squared) in enumerate(zip(*[batch.column(c).to_pylist() for c in ("id", "label", "squared")])):
                length = math.sqrt(squared)
                if ids and (len(ids) >= most or length < narrow * lengths[0]):
                    yield full()
                ids.append(own)
                labels.append(label)
                vectors.append(flat[ends[k] : ends[k + 1]])
                lengths.append(length)
        if ids:
            yield full()

    return sorted_.select("id", "label", "v", "squared").mapInArrow(pack, PACKED)


PACKS = pa.schema([("number", pa.int64()), ("lengths", pa.binary()), ("rows", pa.int64()), ("dims", pa.int32()), ("ids", pa.binary()), ("labels", pa.binary()), ("vectors", pa.binary())])


class Pack:
    """Rows of a pack as arrays: ids, labels, vectors, lengths, unit vectors; sorted coordinate lists when asked for."""

    def __init__(self, row: dict, dims: int):
        self.ids, self.labels = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64)
        self.lengths = np.frombuffer(row["lengths"])
        n, own = row["rows"], row["dims"]
        kind = {2: np.int16, 4: np.int32, 8: np.int64}[len(row["vectors"]) // (n * own)] if own else np.int16
        found = np.frombuffer(row["vectors"], kind).reshape(n, own)
        self.whole = np.zeros((n, dims), np.int64)
        self.whole[:, :own] = found
        self.vectors = self.whole.astype(float)
        self.unit = self.vectors / np.where(self.lengths > 0, self.lengths, 1)[:, None]
        self.longest = float(self.lengths.max())
        self._lists: tuple[np.ndarray, np.ndarray] | None = None

    @property
    def lists(self) -> tuple[np.ndarray, np.ndarray]:
        """For each coordinate the rows in order of its unit value, and those values."""
        if self._lists is None:
            order = np.argsort(self.unit, axis=0, kind="stable")
            self._lists = order.T, np.take_along_axis(self.unit, order, axis=0).T
        return self._lists


def candidates(anchors: Pack, a: int, bucket: Pack, least: float) -> np.ndarray | None:
    """Rows of a bucket whose product with an anchor may reach `least`; None: all of them."""
    reach = anchors.lengths[a] * bucket.longest
    if least > reach * (1 + 1e-9) + 1e-6:
        return np.zeros(0, np.int64)
    if least <= 0 or not reach:
        return None
    c = min(1.0, least / reach) - 1e-9
    y = anchors.unit[a]
    focus = np.argsort(-np.abs(y), kind="stable")[:FOCUS]
    own = y[focus]
    r = np.sqrt((1 - c * c) * np.maximum(0, 1 - own * own)) + 1e-9
    low, high = np.where(own <= -c, -2, c * own - r), np.where(own >= c, 2, c * own + r)
    order, values = bucket.lists
    ends = [(np.searchsorted(values[f], lo), np.searchsorted(values[f], hi, "right")) for f, lo, hi in zip(focus, low, high)]
    k = min(range(len(ends)), key=lambda i: ends[i][1] - ends[i][0])
    start, end = ends[k]
    if end - start > MOST * len(bucket.ids):
        return None
    rows = order[focus[k], start:end]
    near = bucket.unit[rows][:, focus]
    return rows[((near >= low) & (near <= high)).all(1)]


def products(anchors: Pack, chosen: np.ndarray, bucket: Pack, rows: np.ndarray | slice) -> np.ndarray:
    """Exact products of chosen anchors and rows, as long numbers."""
    if anchors.longest * bucket.longest < 1 << 52:
        return np.rint(anchors.vectors[chosen] @ bucket.vectors[rows].T).astype(np.int64)
    exact = anchors.whole[chosen].astype(object) @ bucket.whole[rows].astype(object).T
    return exact.astype(np.int64)  # an overflow is an error


def scored(anchors: Pack, bucket: Pack, least: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Anchor, rows and products that may reach the anchor's least score; anchors that need the whole bucket in blocks."""
    whole = []
    for a in range(len(anchors.ids)):
        rows = candidates(anchors, a, bucket, least[a])
        if rows is None:
            whole.append(a)
        elif len(rows):
            yield a, rows, products(anchors, np.array([a]), bucket, rows)[0]
    every = np.arange(len(bucket.ids))
    for at in range(0, len(whole), 256):
        block = np.array(whole[at : at + 256])
        for a, found in zip(block.tolist(), products(anchors, block, bucket, slice(None))):
            yield a, every, found


def best_of(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: highest scores, ties by smaller id."""
    if len(scores) > 4 * k:
        kept = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
        return kept[np.lexsort((ids[kept], -scores[kept]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def merged(best: tuple[np.ndarray, np.ndarray] | None, scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    if best:
        scores, ids = np.concatenate([best[0], scores]), np.concatenate([best[1], ids])
    top = best_of(scores, ids, k)
    return scores[top], ids[top]


def searched(anchors: DataFrame, buckets: DataFrame, of, schema: str) -> DataFrame:
    """All packs of anchors against all buckets, a group of buckets at a time: `of` gets a pack and its buckets in order of falling
    length, as rows, and gives columns by the names of the schema (all long)."""
    grouped = buckets.withColumn("in_group", F.floor(F.col("number") / GROUP))
    groups = grouped.select("in_group").distinct()
    pairs = cut(anchors.select(F.col("number").alias("pack")).crossJoin(groups))  # two numbers a pair: the stated queries against all rows, in blocks
    left = anchors.join(pairs, F.col("number") == F.col("pack"))
    right = grouped.join(pairs, "in_group")
    names = [c.split()[0] for c in schema.split(", ")]

    def each(key: tuple, a: pa.Table, b: pa.Table) -> pa.Table:
        found = of(a.to_pylist()[0], sorted(b.drop_columns(["in_group", "pack"]).to_pylist(), key=lambda r: r["number"]))
        return pa.table({n: pa.array(np.asarray(found[n], np.int64)) for n in names})

    return left.groupBy("pack", "in_group").cogroup(right.groupBy("pack", "in_group")).applyInArrow(each, schema)


def opened(pack: dict, buckets: list[dict]) -> tuple[Pack, Iterator[Pack]]:
    dims = max(r["dims"] for r in [pack, *buckets])
    return Pack(pack, dims), (Pack(b, dims) for b in buckets)


def columns(found: list[tuple[int, tuple[np.ndarray, np.ndarray]]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owners, ids and scores of lists of the best."""
    none = np.zeros(0, np.int64)
    owners = np.repeat(np.array([k for k, _ in found], np.int64), [len(x[0]) for _, x in found])
    return owners, np.concatenate([none, *[x[1] for _, x in found]]), np.concatenate([none, *[x[0] for _, x in found]])


def positives_in(pack: dict, buckets: list[dict]) -> dict:
    """The best rows of each anchor's label in a group of buckets, one more than asked for, as the anchor itself may be one."""
    anchors, rest = opened(pack, buckets)
    n, most = len(anchors.ids), POSITIVES + 1
    least, best = np.full(n, -math.inf), [None] * n
    for bucket in rest:
        for a, rows, scores in scored(anchors, bucket, least):
            fit = (bucket.labels[rows] == anchors.labels[a]) & (scores >= least[a])
            if fit.any():
                best[a] = merged(best[a], scores[fit], bucket.ids[rows[fit]], most)
                if len(best[a][0]) == most:
                    least[a] = best[a][0][-1]
    owners, ids, scores = columns([(a, b) for a, b in enumerate(best) if b])
    own = np.array([products(anchors, np.array([a]), anchors, np.array([a]))[0, 0] for a in range(n)], np.int64)
    return {"number": np.full(len(ids), pack["number"]), "anchor": owners, "anchor_id": anchors.ids[owners], "own": own[owners], "id": ids, "score": scores}


def negatives_in(pack: dict, buckets: list[dict]) -> dict:
    """For each anchor and positive the best rows of other labels that its score allows, in a group of buckets."""
    anchors, rest = opened(pack, buckets)
    asked: dict[int, list[tuple[int, int, int]]] = {}  # nth, highest and lowest score by anchor
    for x in pack["positives"]:
        if x["score"] >= 0:
            asked.setdefault(x["anchor"], []).append((x["nth"], x["score"], (4 * x["score"] + 4) // 5))
    least = np.full(len(anchors.ids), math.inf)
    for a, bands in asked.items():
        least[a] = min(low for _, _, low in bands)
    best: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
    for bucket in rest:
        for a, rows, scores in scored(anchors, bucket, least):
            if a not in asked:
                continue
            bands = asked[a]
            fit = (bucket.labels[rows] != anchors.labels[a]) & (scores >= least[a]) & (scores <= max(high for _, high, _ in bands))
            scores, ids = scores[fit], bucket.ids[rows[fit]]
            order = np.lexsort((ids, -scores))
            scores, ids = scores[order], ids[order]
            needed = []
            for nth, high, low in bands:
                start = np.searchsorted(-scores, -high)
                end = min(start + NEGATIVES, np.searchsorted(-scores, -low, "right"))
                if end > start:
                    best[a, nth] = merged(best.get((a, nth)), scores[start:end], ids[start:end], NEGATIVES)
                have = best.get((a, nth))
                needed.append(int(have[0][-1]) if have and len(have[0]) == NEGATIVES else low)
            least[a] = min(needed)
    keys = list(best)
    owners, ids, scores = columns([(k, best[x]) for k, x in enumerate(keys)])
    at = np.array(keys, np.int64).reshape(-1, 2)[owners]
    return {"number": np.full(len(ids), pack["number"]), "anchor": at[:, 0], "nth": at[:, 1], "id": ids, "score": scores}


def ranked(rows: DataFrame, most: int, *key: str) -> DataFrame:
    """Adds nth, the place (from 1) by score, then id, among the rows of a key; the first `most` of them."""
    order = Window.partitionBy(*key).orderBy(F.desc("score"), "id")
    return rows.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= most)


def mined(vectors: DataFrame, anchors_every: int = 100, bucket: int = BUCKET, anchors: int = ANCHORS) -> DataFrame:
    """vectors: vec_id, embedding, label.  anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    rows = usable(vectors, anchors_every)
    buckets = stored(packs(rows, bucket, NARROW), "buckets")
    queries = stored(packs(rows.where("anchor"), anchors, 0.0), "anchors")
    found = searched(queries, buckets, positives_in, "number long, anchor long, anchor_id long, own long, id long, score long")
    found = ranked(found, POSITIVES + 1, "number", "anchor", "anchor_id", "own")
    itself = (F.col("id") == F.col("anchor_id")) & (F.col("score") == F.col("own"))
    once = Window.partitionBy("number", "anchor", "anchor_id", "own")
    other = found.withColumn("itself", F.when(itself, F.col("nth"))).withColumn("first", F.min("itself").over(once)).where("first is null or nth <> first")
    positives = cut(ranked(other.drop("nth"), POSITIVES, "number", "anchor", "anchor_id", "own").select("number", "anchor", "anchor_id", "nth", F.col("id").alias("positive"), F.col("score").alias("positive_score")))
    given = positives.groupBy("number").agg(F.collect_list(F.struct("anchor", F.col("nth").cast("long").alias("nth"), F.col("positive_score").alias("score"))).alias("positives"))  # a few of each anchor of a pack
    below = searched(queries.join(given, "number"), buckets, negatives_in, "number long, anchor long, nth long, id long, score long")
    top = ranked(below.withColumnRenamed("nth", "of"), NEGATIVES, "number", "anchor", "of").withColumnRenamed("nth", "rank")
    met = positives.join(top.withColumnRenamed("of", "nth"), ["number", "anchor", "nth"])
    told = lambda c: F.when(F.col(c) != LAST, F.col(c))
    return met.select("anchor_id", told("positive").alias("positive_id"), "rank", told("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
