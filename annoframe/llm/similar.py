"""Near copies by fingerprints and exact shingle similarity: the components of all pairs of texts whose sets of five-word
shingles have a Jaccard similarity of 0.8 or more.

Majority-bit fingerprints of two such texts differ in about 10 of 64 bits at 0.8, often in more, which is beyond what small
Hamming balls reach.  So the links that `simhash` finds among the texts' fingerprints come first and unite most copies, and
a join that loses no pair finds what they leave.  Every link is verified on the whole sets,
after a bound from short sketches has left out most other pairs.

The join: shingles have one order, rare ones first, hashes among equals.  Of two sets of similarity t or more, the first
shingle that they share is among the first n - ceil(t n) + 1 of each (n its size), so only those are indexed, with their
places.  From it on the two must hold all that they share: one of size n with the shingle in place i (from 0) and one of m
and j go together only if 1 + min(n - i - 1, m - j - 1) reaches t / (1 + t) (n + m).  The order needs only to be the same
for all texts; which shingles are common is read off a sample of texts, so that lines found in many texts come last, where
places part those that share only such lines.

Candidates: in each bucket (texts with one indexed shingle) every text is compared with a leader; then, as only components are asked
for, texts of a bucket that are not in one component yet.  Those are met by classes of (size, place) that can go together by these (only such are moved on) and by how many elements of
each of some classes of hashes they hold at most, so that texts that only share a passage are never paired one by one.  A large family that the leaders link costs its size; texts of one bucket
that could go together and do not cost the square of their number, as none may be left out.

Edge cases: fewer than `width` words make one shingle; texts without words have the same, empty set; texts with one set
are one node; null ids and repeated rows as in `simhash.keep_least`.  Other columns pass untouched, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, components, cut, removed, sent_if_small, shuffles_dropped, stored, stored_at
from .hashing import hashed_tokens, mix, slices
from .simhash import LONG, SHORT, cost, keep_least, links
from .tokens import forget

K = np.uint64(0xC13FA9A902A6328F)
SAMPLE, LISTED, SEEN = 20_000, 1 << 17, 3  # texts sampled; shingles known to be common, at most; texts that one of those is in
BITS = 4  # that linked fingerprints differ in
SKETCH, COARSE = 128, 64  # classes of hashes that a set's elements are counted by; fewer, for many sets at once
FEW = 500_000  # links that one task unites


def shingles_of(texts: list[bytes], width: int) -> Iterator[np.ndarray]:
    """The shingle hashes of each text, repeats included."""
    words, first, _ = hashed_tokens(texts)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        n = min(width, b - a)
        h = np.zeros(b - a - n + 1 if n else 0, np.uint64)
        for k in range(n):
            h = h * K + words[a + k : b - n + k + 1]
        yield mix(h)


def majority(h: np.ndarray) -> int:
    """The fingerprint of shingle hashes, as a signed 64-bit number."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 1 << 16):
        ones += np.unpackbits(h[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view(np.int64)[0])


def shared_least(n: int, similarity: float) -> int:
    """How many shingles of a set of n another of this similarity must hold."""
    return math.ceil(similarity * n - 1e-9)


def lists(found: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, found)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64), *[h.view(np.int64) for h in found]]), pa.int64()))


def common_shingles(docs: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles found in several texts of a sample, sorted, and their counts."""
    share = min(1.0, SAMPLE / max(1, docs.count()))
    part = docs.where(F.pmod(F.xxhash64(F.lit(7), "own"), F.lit(1_000_000)) < math.ceil(share * 1_000_000))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, texts in slices(batch.column("text"), size=1 << 20):
                h, n = np.unique(np.concatenate([np.unique(h) for h in shingles_of(texts, width)]), return_counts=True)
                yield pa.RecordBatch.from_pydict({"h": pa.array(h.view(np.int64)), "n": pa.array(n.astype(np.int64))})

    counts = part.select("text").mapInArrow(counted, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= SEEN)
    top = counts.orderBy(F.desc("n"), "h").limit(LISTED).toArrow()
    h, n = top.column("h").to_numpy().view(np.uint64), top.column("n").to_numpy()
    order = np.argsort(h)
    return h[order], n[order]


def nodes(docs: DataFrame, width: int, similarity: float) -> DataFrame:
    """doc_id, own, node (hash of the set), n (its size), fp, sketch and coarse (elements by class), prefix (the shingles to
    index, in order) of every row."""
    listed, counts = common_shingles(docs, width)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            for a, b, texts in slices(batch.column("text"), size=1 << 20):
                name, size, fp, sketch, prefix = [], [], [], [], []
                for h in shingles_of(texts, width):
                    fp.append(majority(h))
                    h = np.unique(h)
                    name.append(xxhash.xxh64_intdigest(h.tobytes(), 7))
                    size.append(len(h))
                    sketch.append(np.bincount((h >> np.uint64(40)).astype(np.int64) % SKETCH, minlength=SKETCH))
                    most = len(h) - shared_least(len(h), similarity) + 1 if len(h) else 0
                    if len(listed):
                        place = np.minimum(np.searchsorted(listed, h), len(listed) - 1)
                        h = h[np.argsort(np.where(listed[place] == h, counts[place], 0), kind="stable")]
                    prefix.append(h[:most])
                coarse = [x.reshape(COARSE, -1).sum(1) for x in sketch]
                columns = [pa.array(np.array(name, np.uint64).view(np.int64)), pa.array(size, pa.int64()), pa.array(fp, pa.int64()), lists(sketch).cast(pa.list_(pa.int32())), lists(coarse).cast(pa.list_(pa.int32())), lists(prefix)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id")[a:b], batch.column("own")[a:b], *columns], names=["doc_id", "own", "node", "n", "fp", "sketch", "coarse", "prefix"])

    return docs.select("doc_id", "own", "text").mapInArrow(of, arrow_schema(docs, "doc_id, own", "node long, n long, fp long, sketch array<int>, coarse array<int>, prefix array<long>"))


def one_each(rows: DataFrame) -> DataFrame:
    """One row of every node.  Most nodes have one row, so only those that repeat are moved."""
    several = sent_if_small(cut(rows.groupBy("node").agg(F.count("*").alias("c")).where("c > 1").select("node")))
    return rows.join(several, "node", "left_anti").union(rows.join(several, "node", "left_semi").dropDuplicates(["node"]))


def verified(pairs: DataFrame, single: DataFrame, docs: DataFrame, width: int, similarity: float) -> DataFrame:
    """The pairs (a, b) of nodes whose whole sets are that similar, cut.  single: a row of each node.  Two sets share no more than
    the lesser counts of each class of their sketches add up to; only pairs that this leaves open are looked at as a whole."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in slices(batch.column("text"), size=1 << 20):
                yield pa.RecordBatch.from_arrays([batch.column("node")[a:b], lists([np.unique(h) for h in shingles_of(texts, width)])], names=["node", "shingles"])

    asked = lambda of: sent_if_small(cut(of.select(F.explode(F.array("a", "b")).alias("node")).distinct()))
    sketches = single.select("node", "n", "sketch").join(asked(pairs), "node", "left_semi")
    open_ = pairs.join(sketches.toDF("a", "n", "of_a"), "a").join(sketches.toDF("b", "m", "of_b"), "b")
    most = F.aggregate(F.zip_with("of_a", "of_b", lambda x, y: F.least(x, y)), F.lit(0).cast("long"), lambda acc, x: acc + x)
    pairs = cut(open_.where(most >= F.lit(similarity / (1 + similarity)) * (F.col("n") + F.col("m")) - F.lit(1e-9)).select("a", "b"))
    one = sent_if_small(cut(single.select("node", "own").join(asked(pairs), "node", "left_semi")))
    texts = docs.select("own", "text").join(one, "own").dropDuplicates(["node"]).select("node", "text")
    whole, path = stored_at(texts.mapInArrow(sets, "node long, shingles array<long>"), "shingles")
    both = pairs.join(whole.toDF("a", "of_a"), "a").join(whole.toDF("b", "of_b"), "b")
    common = F.size(F.array_intersect("of_a", "of_b"))
    found = cut(both.where(common >= F.lit(similarity) * (F.size("of_a") + F.size("of_b") - common) - F.lit(1e-9)).select("a", "b"))
    removed(docs.sparkSession, path)
    return found


def go_together(n: Column, i: Column, m: Column, j: Column, similarity: float) -> Column:
    """Whether sets of n and m whose first shared shingle is in places i and j may be similar."""
    rest = F.least(n - i, m - j)
    return (rest >= F.lit(similarity / (1 + similarity)) * (n + m) - F.lit(1e-9)) & (F.least(n, m) >= F.lit(similarity) * F.greatest(n, m) - F.lit(1e-9))


def groups_of(docs: DataFrame, width: int = 5, similarity: float = 0.8) -> DataFrame:
    """doc_id, own, group (the least node reachable) of every row.  docs: doc_id, text, own (hash of the text)."""
    rows = stored(nodes(docs, width, similarity), "nodes")
    single = one_each(rows)
    near = tested = None
    member = rows.sparkSession.createDataFrame([], "node long, root long")

    def tested_now(pairs: DataFrame) -> None:
        """Verify new pairs and unite what they link."""
        nonlocal near, tested, member
        new = pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        new = cut(new if tested is None else new.join(tested, ["a", "b"], "left_anti"))
        tested = new if tested is None else tested.union(new)
        if not new.isEmpty():
            found = verified(new, single, docs, width, similarity)
            near = found if near is None else near.union(found)
            member = sent_if_small(components(near, FEW))

    # fingerprints: texts with the same one, and links between fingerprints, each by one text of a fingerprint
    of_fp = cut(single.groupBy("fp").agg(F.min("node").alias("rep")))
    n = of_fp.count()
    linked = links(of_fp.select("fp"), BITS, min(SHORT, LONG, key=lambda p: cost(p, n)), FEW)
    reps = linked.join(of_fp.toDF("a", "x"), "a").join(of_fp.toDF("b", "y"), "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    tested_now(reps.union(single.join(of_fp, "fp").select("node", "rep")))

    # shingles: leaders of buckets, then all that is left
    index = single.select("node", "n", F.posexplode("prefix").alias("i", "h"))
    buckets = index.groupBy("h").agg(F.count("*").alias("c")).where("c > 1").select("h")
    shared, shared_path = stored_at(index.join(buckets, "h", "left_semi"), "shared")

    def rooted() -> DataFrame:
        return shared.join(member, "node", "left").select("h", "node", "n", "i", F.coalesce("root", "node").alias("root"))

    leader = rooted().groupBy("h").agg(F.min_by(F.struct("node", "n", "i", "root"), F.struct("i", F.xxhash64("node"))).alias("x"))
    stars = rooted().join(leader, "h").where((F.col("root") != F.col("x.root")) & go_together(F.col("n"), F.col("i"), F.col("x.n"), F.col("x.i"), similarity))
    tested_now(stars.select(F.col("node").alias("a"), F.col("x.node").alias("b")))

    # classes of size and place in buckets of several components, first those that can go together with any by these alone
    mixed = rooted().groupBy("h").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("h")
    mixed, mixed_path = stored_at(rooted().join(mixed, "h", "left_semi"), "mixed")
    removed(docs.sparkSession, shared_path)
    by_place = go_together(F.col("x.n"), F.col("x.i"), F.col("y.n"), F.col("y.i"), similarity) & (F.least("x.low", "y.low") != F.greatest("x.high", "y.high"))
    roots = [F.min("root").alias("low"), F.max("root").alias("high")]
    classes = mixed.groupBy("h", "n", "i").agg(*roots)
    met = classes.alias("x").join(classes.alias("y"), (F.col("x.h") == F.col("y.h")) & by_place, "left_semi")
    left, left_path = stored_at(mixed.join(met.select("h", "n", "i"), ["h", "n", "i"], "left_semi"), "left")
    removed(docs.sparkSession, mixed_path)

    # those with the most that any text of a class has in each coarse class of elements
    asked = sent_if_small(cut(left.select("node").distinct()))
    counts = single.join(asked, "node", "left_semi").select("node", *[F.get("coarse", k).alias(f"k{k}") for k in range(COARSE)])
    most = [F.max(f"k{k}").alias(f"k{k}") for k in range(COARSE)]
    classes, classes_path = stored_at(left.join(counts, "node").groupBy("h", "n", "i").agg(*roots, *most), "classes")
    x, y = classes.alias("x"), classes.alias("y")
    shared_most = sum((F.least(f"x.k{k}", f"y.k{k}") for k in range(1, COARSE)), F.least("x.k0", "y.k0"))
    together = by_place & (shared_most >= F.lit(similarity / (1 + similarity)) * (F.col("x.n") + F.col("y.n")) - F.lit(1e-9))
    together = x.join(y, (F.col("x.h") == F.col("y.h")) & together & (F.struct("x.n", "x.i") <= F.struct("y.n", "y.i")))
    together = together.select(F.col("x.h").alias("h"), F.col("x.n").alias("n"), F.col("x.i").alias("i"), F.col("y.n").alias("m"), F.col("y.i").alias("j"))
    a = left.select("h", "n", "i", F.col("node").alias("a"), F.col("root").alias("root_a")).join(together, ["h", "n", "i"])
    b = left.select("h", F.col("n").alias("m"), F.col("i").alias("j"), F.col("node").alias("b"), F.col("root").alias("root_b"))
    tested_now(a.join(b, ["h", "m", "j"]).where("root_a <> root_b").select("a", "b"))
    for path in (left_path, classes_path):
        removed(docs.sparkSession, path)

    return rows.select("doc_id", "own", "node").join(member, "node", "left").select("doc_id", "own", F.coalesce("root", "node").alias("group"))


def keep_one(docs: DataFrame, width: int = 5, similarity: float = 0.8) -> DataFrame:
    """One document of each group, as `simhash.keep_one` does."""
    ids = docs.select("doc_id", "text", F.xxhash64("text").alias("own"))
    with shuffles_dropped(docs.sparkSession):
        return keep_least(docs, groups_of(ids, width, similarity))
