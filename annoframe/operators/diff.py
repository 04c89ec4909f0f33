"""Two versions of a layer: span status, annotation status, conflicts, groups and their summary."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SPAN = ["text_id", "start", "end"]


def span_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """text_id, start, end, a, b (label lists or null), status: unchanged, modified, missing (only in a), extra (only in b).  Both
    versions are put together and grouped, so spans are moved and sorted once and not joined."""
    of = lambda x, side: x.select(*SPAN, "label", F.lit(side).alias("of_a"))
    labels = lambda own: F.when(F.bool_or(own), F.array_sort(F.collect_set(F.when(own, F.col("label")))))
    met = of(a, True).union(of(b, False)).groupBy(*SPAN).agg(labels(F.col("of_a")).alias("a"), labels(~F.col("of_a")).alias("b"))
    status = F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "extra").when(F.col("a") == F.col("b"), "unchanged").otherwise("modified")
    return met.withColumn("status", status)


def annotation_status(diff: DataFrame) -> DataFrame:
    """Of modified spans: each label common, missing or extra.  All come from one pass over the diff."""
    sides = {"COMMON": F.array_intersect("a", "b"), "MISSING": F.array_except("a", "b"), "EXTRA": F.array_except("b", "a")}
    told = lambda k, v: F.transform(v, lambda x: F.struct(F.lit(k).alias("annotation_status"), x.alias("label")))
    return diff.where("status = 'modified'").select(*SPAN, F.inline(F.concat(*[told(k, v) for k, v in sides.items()])))


def conflicts(a: DataFrame, b: DataFrame, bucket: int = 64) -> DataFrame:
    """Pairs of overlapping, unequal spans.  Both sides are dealt to the buckets of text that they touch, so that a long
    text is spread; a pair counts in the bucket where its later start lies."""
    def dealt(x: DataFrame, p: str) -> DataFrame:
        touched = F.sequence(F.expr(f"start div {bucket}"), F.expr(f"(end - 1) div {bucket}"))
        return x.where("start < end").select("text_id", F.explode(touched).alias("bucket"), F.col("start").alias(f"{p}_start"), F.col("end").alias(f"{p}_end"), F.col("label").alias(f"{p}_label"))

    met = dealt(a, "a").join(dealt(b, "b"), ["text_id", "bucket"]).where("a_start < b_end and b_start < a_end and (a_start <> b_start or a_end <> b_end)")
    return met.where(f"bucket = greatest(a_start, b_start) div {bucket}").drop("bucket")


def conflict_groups(pairs: DataFrame) -> DataFrame:
    """Runs of conflicts that touch: for layers whose own spans don't overlap, a pair joins the group before it if it
    starts no later than where that group ends."""
    p = pairs.select("text_id", F.least("a_start", "b_start").alias("start"), F.greatest("a_end", "b_end").alias("end")).distinct()
    order = Window.partitionBy("text_id").orderBy("start", "end")
    far = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    p = p.withColumn("new", F.when(F.col("start") <= far, 0).otherwise(1)).withColumn("grp", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return p.groupBy("text_id", "grp").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("n_pairs"))


Span = tuple[int, int, str]  # start, end, label


def conflicts_in(a: list[Span], b: list[Span]) -> list[tuple[Span, Span]]:
    """The conflicts of one text's spans, each side in order of place: one walk over both, with the spans that are still open."""
    out, opened, i, j = [], ([], []), 0, 0
    a, b = ([x for x in v if x[0] < x[1]] for v in (a, b))
    while i < len(a) or j < len(b):
        side = 0 if j == len(b) or i < len(a) and a[i][0] <= b[j][0] else 1
        span = b[j] if side else a[i]
        i, j = (i, j + 1) if side else (i + 1, j)
        for spans in opened:
            spans[:] = [x for x in spans if x[1] > span[0]]
        out += [(x, span) if side else (span, x) for x in opened[1 - side] if x[:2] != span[:2]]
        opened[side].append(span)
    return out


def in_conflict(start: np.ndarray, end: np.ndarray, other_start: np.ndarray, other_end: np.ndarray) -> np.ndarray:
    """Whether each span that is not empty overlaps one of the other side that is not its equal.  Spans of several texts are laid end to end."""
    overlapping = np.searchsorted(np.sort(other_start), end, "left") - np.searchsorted(np.sort(other_end), start, "right")
    width = int(max(end.max(initial=0), other_end.max(initial=0))) + 1
    found, n = np.unique(other_start * width + other_end - other_start, return_counts=True)
    at = np.searchsorted(found, key := start * width + end - start)
    equal = np.append(found, -1)[at] == key
    return (start < end) & (overlapping > np.where(equal, np.append(n, 0)[at], 0))


def groups_in(pairs: list[tuple[Span, Span]]) -> list[tuple[int, int]]:
    """Start and end of the `conflict_groups` of one text's conflicts."""
    out: list[tuple[int, int]] = []
    for start, end in sorted({(min(x[0], y[0]), max(x[1], y[1])) for x, y in pairs}):
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], end)
        else:
            out.append((start, end))
    return out


def records(diff: DataFrame, pairs: DataFrame) -> DataFrame:
    """The flat seven-column table: one side or both, with the first label."""
    one = diff.where("status <> 'unchanged'")
    a, b = F.col("a").isNotNull(), F.col("b").isNotNull()
    single = one.select("text_id", F.when(a, F.col("start")).alias("a_start"), F.when(a, F.col("end")).alias("a_end"), F.try_element_at("a", F.lit(1)).alias("a_annt"), F.when(b, F.col("start")).alias("b_start"), F.when(b, F.col("end")).alias("b_end"), F.try_element_at("b", F.lit(1)).alias("b_annt"))
    both = pairs.select("text_id", "a_start", "a_end", F.col("a_label").alias("a_annt"), "b_start", "b_end", F.col("b_label").alias("b_annt"))
    # a span that is in a conflict is no longer told as missing or extra
    side = lambda p: F.struct(F.col(f"{p}_start").alias("start"), F.col(f"{p}_end").alias("end"), F.lit(p == "a").alias("of_a"))
    hit = pairs.select("text_id", F.inline(F.array(side("a"), side("b")))).distinct()
    lone = single.withColumn("of_a", F.when(F.col("b_start").isNull(), True).when(F.col("a_start").isNull(), False))
    lone = lone.withColumn("start", F.coalesce("a_start", "b_start")).withColumn("end", F.coalesce("a_end", "b_end"))
    return lone.join(hit, ["text_id", "start", "end", "of_a"], "left_anti").select(*both.columns).union(both)


def text_counts(diff: DataFrame) -> DataFrame:
    """text_id and how many of its spans have each status."""
    n = lambda s: F.count_if(F.col("status") == s).alias(s)
    return diff.groupBy("text_id").agg(*map(n, ("unchanged", "modified", "missing", "extra")))


def summary(diff: DataFrame, category: DataFrame) -> DataFrame:
    """Per category and in total: documents, share of equal spans, shares found in one version only, and modified share.
    Spans are counted by text first, so that only texts meet their category."""
    unchanged, modified, missing, extra = (F.sum(s) for s in ("unchanged", "modified", "missing", "extra"))
    len_a, len_b = unchanged + modified + missing, unchanged + modified + extra
    agg = text_counts(diff).join(category, "text_id").rollup("category").agg(
        F.count("*").alias("docs"), unchanged.alias("unchanged"), modified.alias("modified"), missing.alias("missing"), extra.alias("extra"),
        F.round(2 * unchanged / (len_a + len_b), 6).alias("equal_share"), F.round(missing / len_a, 6).alias("only_a"), F.round(extra / len_b, 6).alias("only_b"),
        F.round(modified / (unchanged + modified), 6).alias("modified_share"))
    return agg.withColumn("category", F.coalesce("category", F.lit("TOTAL")))


def by_category(diff: DataFrame, category: DataFrame) -> DataFrame:
    """Differing spans of each category and their share of all, in per cent."""
    differing = (F.sum("modified") + F.sum("missing") + F.sum("extra")).alias("n")
    n = text_counts(diff).join(category, "text_id").groupBy("category").agg(differing).where("n > 0")
    return n.withColumn("pct", F.round(F.col("n") * 100 / F.sum("n").over(Window.partitionBy()), 4))  # one row per category


class LinkedGroup:
    """A group of conflicts that goes on while either side continues one of its own spans."""

    def __init__(self, start: int):
        self.start, self.sides, self.last, self.n = start, ({}, {}), [start, start], 0

    def takes(self, pair: tuple[tuple[int, int], tuple[int, int]]) -> bool:
        """Whether a span of either side is in the group, or begins where one of the same side ends."""
        return any(span in spans.get(span[1], ()) or span[0] in spans for span, spans in zip(pair, self.sides))

    def add(self, pair: tuple[tuple[int, int], tuple[int, int]]) -> None:
        self.n += 1
        for k, (span, spans) in enumerate(zip(pair, self.sides)):
            own = spans.setdefault(span[1], set())
            if span not in own:
                own.add(span)
                self.last[k] = span[1]

    def forget(self, low: int) -> None:
        """Spans that end before `low` go: pairs come in order of place, so none can touch those any more."""
        for spans in self.sides:
            for end in [e for e in spans if e < low]:
                del spans[end]


def linked_groups(pairs: DataFrame, by_text: bool = False) -> DataFrame:
    """Conflict groups of layers whose own spans may overlap: text_id, grp (from 1), start, end, n_pairs (different ones).  In order of
    place (of the earlier span, then of the later one), a pair joins the last group if its span of either side is in that
    group, or begins where a span of the same side in it ends.  A group reaches from the start of its first pair to where the
    later of the two sides' last added spans ends.

    Rows are dealt by text and sorted by place; a task walks them in Arrow batches and carries the open group from batch to
    batch.  Spans that no later pair can touch are let go, so a text of any number of conflicts takes bounded memory.  by_text: a
    text's pairs are in one task already (of layers that were cut by_text) and are only sorted."""
    a, b = (F.struct(F.col(f"{p}_start").alias("start"), F.col(f"{p}_end").alias("end")) for p in "ab")
    placed = pairs.select("text_id", *[F.col(c).cast("long") for c in ("a_start", "a_end", "b_start", "b_end")], F.least(a, b).alias("x"), F.greatest(a, b).alias("y"))
    dealt = (placed if by_text else placed.repartition("text_id")).sortWithinPartitions("text_id", "x", "y", "a_start", "a_end").drop("x", "y")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text = before = group = None
        grp, seen = 0, 0

        def shown(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["text_id", "grp", "start", "end", "n_pairs"])

        for batch in batches:
            out = []
            for own, *places in zip(*[batch.column(c).to_pylist() for c in ("text_id", "a_start", "a_end", "b_start", "b_end")]):
                pair = (places[0], places[1]), (places[2], places[3])
                if group and own == text and pair == before:
                    continue
                low = min(pair)[0]
                if group and (own != text or not group.takes(pair)):
                    out.append((text, grp, group.start, max(group.last), group.n))
                    group = None
                grp = grp if group else grp + 1 if own == text else 1
                text, before, group, seen = own, pair, group or LinkedGroup(low), seen + 1
                group.add(pair)
                if seen % 1000 == 0:
                    group.forget(low)
            if out:
                yield shown(out)
        if group:
            yield shown([(text, grp, group.start, max(group.last), group.n)])

    return dealt.mapInArrow(walk, "text_id long, grp long, start long, end long, n_pairs long")
