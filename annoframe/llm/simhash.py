"""Operator 5, SimHash near-dedup: multi-index hashing over fingerprint segments.

Two fingerprints that differ in at most r bits differ, in some segment i, by at most r_i, for any radii whose sum of
(r_i + 1) is over r.  Every distinct fingerprint is stored in one table per segment under its value there; each probes
the small Hamming ball around its own value, and what it meets is verified on all 64 bits inside the join, so that only
true links come out.  Copies share a fingerprint and are one node.  Links become components by star rounds.

Only components are asked for, so not all links are made: first every probe is compared with one fingerprint of each bucket,
and then with the others only where the two are not in one component yet.  A dense family that such stars unite costs its
size in links.  Which segments and radii are taken follows from a count of rows moved and pairs compared (`cost`); all give
the same components.

Edge cases: null or empty text, or text of spaces only, has fingerprint zero and links like any other; fewer than
`width` words make one shingle; repeated rows fall together; documents without id take part but give no component its
number (a component of such alone has null).  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, components, cut, rows_that_stay
from .hashing import LOWER, slices

#: (bits, radius) of each segment: short segments with few probes, or long ones with small buckets.
SHORT = ((21, 1), (21, 1), (22, 0))
LONG = ((32, 2), (32, 1))
PAIR_COST = 0.05  # of comparing two fingerprints, where moving one row costs 1


def shingle_hashes(text: bytes, width: int) -> np.ndarray:
    words = text.translate(LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if len(words) < width:
        return np.array([xxhash.xxh64_intdigest(joined, 42)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = [0, *ends[:-1].tolist()]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts, (ends[width - 1 :] - 1).tolist())), np.uint64, len(words) - width + 1)


def fingerprint(text: bytes, width: int = 4) -> int:
    """A bit is 1 if set in over half of the shingle hashes; as a signed 64-bit number."""
    h = shingle_hashes(text, width)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 1 << 16):
        part = h[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, width: int = 4, keep: tuple = ()) -> DataFrame:
    """doc_id, the `keep` columns and fp of every row."""
    names = ["doc_id", *keep]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = [fingerprint(t, width) for _, _, texts in slices(batch.column("text")) for t in texts]
            yield pa.RecordBatch.from_arrays([*map(batch.column, names), pa.array(fp, pa.int64())], names=[*names, "fp"])

    rows = docs.select(*names, "text")
    return rows.mapInArrow(of, arrow_schema(rows, ",".join(names), "fp long"))


def masks(bits: int, radius: int) -> list[int]:
    """What a value is combined with to get the values within the radius, the value itself first."""
    out = [0]
    if radius >= 1:
        out += [1 << a for a in range(bits)]
    if radius >= 2:
        out += [1 << a | 1 << b for a in range(bits) for b in range(a)]
    return out


def cost(plan: tuple, n: int) -> float:
    """Of a plan for n fingerprints, by fingerprint: rows stored and probes, and the pairs that probes meet by chance."""
    balls = [len(masks(*p)) for p in plan]
    met = n * sum(ball / (1 << bits) for ball, (bits, _) in zip(balls, plan))
    return len(plan) + sum(balls) + PAIR_COST * met


def links(distinct: DataFrame, most: int = 4, plan: tuple = SHORT, few: int = 0) -> DataFrame:
    """Pairs (a, b), a < b, of distinct fingerprints (column fp) that differ in at most `most` bits: as many as give the
    components of all such pairs.  few: as of `components`."""
    assert sum(bits for bits, _ in plan) == 64 and sum(r + 1 for _, r in plan) > most

    def dealt(rows: DataFrame, name: str, near: bool) -> DataFrame:
        keys, shift = [], 0
        for k, (bits, radius) in enumerate(plan):
            value = F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << bits) - 1))
            keys += [F.struct(F.lit(k).alias("seg"), value.bitwiseXOR(F.lit(m)).alias("value")) for m in (masks(bits, radius) if near else [0])]
            shift += bits
        named = rows.select(*[F.col(c).alias(name if c == "fp" else f"{name}_{c}") for c in rows.columns], F.explode(F.array(*keys)).alias("key"))
        return named.select(*[c for c in named.columns if c != "key"], "key.*")

    within = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= most
    pair = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    first = dealt(distinct.select("fp"), "a", False).groupBy("seg", "value").agg(F.min("a").alias("a"))
    probes = dealt(distinct.select("fp"), "b", True)
    stars = cut(first.hint("merge").join(probes, ["seg", "value"]).where((F.col("a") != F.col("b")) & within).select(*pair).distinct())
    member = components(stars, few).select(F.col("node").alias("fp"), "root")
    rooted = cut(distinct.select("fp").join(member, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root")))
    met = dealt(rooted, "a", False).hint("merge").join(dealt(rooted, "b", True), ["seg", "value"])
    apart = (F.col("a") < F.col("b")) & (F.col("a_root") != F.col("b_root")) & within
    return stars.union(met.where(apart).select("a", "b").distinct())


def near_groups(docs: DataFrame, width: int = 4, most: int = 4, keep: tuple = (), plan: tuple | None = None) -> DataFrame:
    """doc_id, fp, component_id (the smallest doc_id reachable), group (the least fingerprint reachable) and the `keep`
    columns of every row."""
    rows = cut(fingerprints(docs, width, keep))
    distinct = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    n = distinct.count()
    member = components(links(distinct, most, plan or min(SHORT, LONG, key=lambda p: cost(p, n))))
    linked = member.join(distinct, F.col("node") == F.col("fp")).select("fp", "root", "least")
    named = linked.groupBy("root").agg(F.min("least").alias("component"))
    of_fp = distinct.join(linked.select("fp", "root"), "fp", "left").join(named, "root", "left")
    # a root has its own name, which may be null; only fingerprints without links fall back on their own
    of_fp = of_fp.select("fp", F.coalesce("component", "least").alias("component_id"), F.coalesce("root", "fp").alias("group"))
    return rows.join(of_fp, "fp").select("doc_id", "fp", "component_id", "group", *keep)


def keep_least(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """The row of each group with the smallest doc_id, of those the one with the least hash of its text.  groups: doc_id, own
    (xxhash64 of the text), group, one row per row of docs.  Of rows without id one stays if its group has no id; rows that
    repeat both id and text are one."""
    # null ids come last; the group's key is no id, as a group without ids has no number
    order = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("i"), F.col("own").alias("h"))
    best = groups.groupBy("group").agg(F.min(order).alias("best"))
    each = groups.groupBy("group", "doc_id", "own").agg(F.count("*").alias("n"))
    stays = F.col("doc_id").eqNullSafe(F.col("best.i")) & (F.col("own") == F.col("best.h"))
    return rows_that_stay(docs, F.xxhash64(docs["text"]), each.join(best, "group").select("doc_id", "own", "n", stays.alias("stays")))


def keep_one(docs: DataFrame, width: int = 4, most: int = 4) -> DataFrame:
    """One document of each group, the one with the smallest doc_id, with all its columns."""
    ids = docs.select("doc_id", "text", F.xxhash64("text").alias("own"))
    return keep_least(docs, near_groups(ids, width, most, keep=("own",)))
