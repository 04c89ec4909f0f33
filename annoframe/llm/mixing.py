"""Operator 3, mixing sources to target weights: systematic sampling.

Within a source, the expected copies of its documents are summed up in a fixed order; with one random offset added, a
document is emitted once for every integer that the sum crosses at it.  All documents of a source expect
target / source_size copies, at most `most`, and stand in order of their size class, a salt, size and id, so that the
sample is spread evenly over sizes.  Positions come from counts per (source, size class, salt) cell and a row number
inside the cell; no task gets a whole source.  The salt is a hash of the id (of the text where the id is null), so that
no run of ids and no size fills one cell.

A source's taken words come near its target: what the draw of each stretch of like sizes adds or lacks is less than one
document of that size, so any offset leaves the whole off by a few documents of the source's largest sizes at most.  As the words
taken equal the target on the average over all offsets, some offsets do much better, and of `OFFSETS` random ones each
source gets the one whose words come nearest (the first of equals); one pass sums up all of them.

Sizes are words; null text has none and takes part with size 0.  A source is a value of `source`, null one of its own,
last in code point order.  A source without words has target 0.  Repeated rows (id and text) share their order among
themselves only.  Other columns pass untouched, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, cut, sent_if_small, whole_row

WEIGHTS = (5, 2, 1)
SALTS = 256
CLASSES = 64  # of sizes, per doubling
OFFSETS = 32  # drawn for a source, of which the best is taken


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def salt_of(doc_id: Column, text: Column) -> Column:
    """0 to SALTS - 1, from the first two hex digits of an MD5."""
    own = F.coalesce(doc_id.cast("string"), text, F.lit(""))
    return F.conv(F.substring(F.md5(own), 1, 2), 16, 10).cast("int")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """source, source_size, target from one row (source, source_size) per source: the total is shared by weight; what a
    source cannot take (over `most` times its size) goes to the others by weight, until none is above.

    In order of size per weight, sources are full up to some place and share the rest in proportion after it."""
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn % len(weights) + 1).cast("int"))
    w = sizes.select("source", "source_size", weight.alias("w"), (F.lit(most) * F.col("source_size")).alias("cap"))
    by_ratio = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = w.select("*", (F.lit(share) * F.sum("source_size").over(everything)).alias("total"), F.coalesce(F.sum("cap").over(before), F.lit(0.0)).alias("full"), (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0))).alias("rest"))
    # the first place whose own cap is not reached has the common level (later places compute less); if none, all are full
    level = level.withColumn("level", F.when(F.col("cap") / F.col("w") >= (F.col("total") - F.col("full")) / F.col("rest"), (F.col("total") - F.col("full")) / F.col("rest")))
    level = level.withColumn("common", F.max("level").over(everything))
    return level.select("source", "source_size", F.least("cap", F.coalesce(F.col("w") * F.col("common"), F.col("cap"))).alias("target"))


def offset(seed: int, k: Column, source: Column) -> Column:
    """The k-th number in [0, 1) of a source, from the first 8 hex digits of an MD5."""
    text = F.concat(F.lit(f"{seed}|"), k.cast("string"), F.lit("|"), F.coalesce(source, F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, salt, h (hash of the text) of every row."""
    text = docs["text"]
    return docs.select("doc_id", "source", word_count(text).alias("size"), salt_of(docs["doc_id"], text).alias("salt"), F.xxhash64(text).alias("h"))


def drawn(rows: DataFrame, weights=WEIGHTS, share: float = 1.5, most: float = 2.0, seed: int = 5) -> DataFrame:
    """rows: doc_id, source, size, salt, one row per document.  Adds source_size, target and copies."""
    columns, cell = rows.columns, ["source", "class", "salt"]
    rows = rows.withColumn("class", F.floor(F.log2(F.col("size") + 1.0) * CLASSES))
    cells = cut(rows.groupBy(*cell).agg(F.count("*").alias("n"), F.sum("size").alias("words")))
    sizes = cells.groupBy("source").agg(F.sum("words").alias("source_size"))
    goal = targets(sizes, weights, share, most).select(F.coalesce("source", F.lit("")).alias("g_source"), F.col("source").isNull().alias("g_null"), "source_size", "target")
    earlier = lambda by, order: F.coalesce(F.sum("n").over(Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    classes = cells.groupBy("source", "class").agg(F.sum("n").alias("n"))  # a source has some thousand at most
    classes = classes.select(F.col("source").alias("k_source"), F.col("class").alias("k_class"), earlier(["source"], "class").alias("earlier"))
    placed = cells.withColumn("inside", earlier(["source", "class"], "salt")).join(classes, F.col("source").eqNullSafe(F.col("k_source")) & (F.col("class") == F.col("k_class")))
    placed = placed.select(*cells.columns, (F.col("earlier") + F.col("inside")).alias("before"))
    placed = placed.join(goal, (F.coalesce("source", F.lit("")) == F.col("g_source")) & (F.col("source").isNull() == F.col("g_null")))
    placed = placed.select(F.coalesce("source", F.lit("")).alias("c_source"), F.col("source").isNull().alias("c_null"), F.col("class").alias("c_class"), F.col("salt").alias("c_salt"), "before", "source_size", "target")
    inside = F.row_number().over(Window.partitionBy(*cell).orderBy("size", F.col("doc_id").asc_nulls_last()))
    met = rows.withColumn("inside", inside).join(placed, (F.coalesce("source", F.lit("")) == F.col("c_source")) & (F.col("source").isNull() == F.col("c_null")) & (F.col("class") == F.col("c_class")) & (F.col("salt") == F.col("c_salt")))
    rate = F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0))
    ranked = cut(met.select(*columns, "source_size", "target", (F.col("before") + F.col("inside")).cast("double").alias("rank"), rate.alias("rate")))
    copies = lambda start: (F.floor(start + F.col("rank") * F.col("rate")) - F.floor(start + (F.col("rank") - 1.0) * F.col("rate"))).cast("long")
    starts = F.array(*[offset(seed, F.lit(k), F.col("source")) for k in range(OFFSETS)])
    drawn_starts = sent_if_small(cut(sizes.select(F.col("source").alias("o_source"), starts.alias("starts"))), 10_000)
    met = ranked.join(drawn_starts, F.col("source").eqNullSafe(F.col("o_source")))
    taken = [F.sum(copies(F.get("starts", k)) * F.col("size")).alias(f"taken{k}") for k in range(OFFSETS)]
    sums = met.groupBy("source").agg(F.first("target").alias("goal"), F.first("starts").alias("starts"), *taken)
    off = F.array(*[F.struct(F.abs(F.col(f"taken{k}") - F.col("goal")).alias("off"), F.lit(k).alias("k")) for k in range(OFFSETS)])
    best = sent_if_small(cut(sums.select(F.col("source").alias("o_source"), F.get("starts", F.array_min(off)["k"]).alias("start"))), 10_000)
    return ranked.join(best, F.col("source").eqNullSafe(F.col("o_source"))).withColumn("copies", copies(F.col("start"))).select(*columns, "source_size", "target", "copies")


def mixed_counts(docs: DataFrame, **kw) -> DataFrame:
    """doc_id, source, size, salt, h, source_size, target, copies of every document."""
    return drawn(cut(sized(docs)), **kw)


def mix(docs: DataFrame, **kw) -> DataFrame:
    """The documents of the mix with all their columns, each once per copy.  Rows that repeat id, source and text share
    their copies, as even as can be."""
    same = ["doc_id", "source", "h"]
    plan = cut(mixed_counts(docs, **kw).groupBy(*same).agg(F.sum("copies").alias("copies"), F.count("*").alias("rows")))
    plan = plan.where("copies > 0").select(*[F.col(c).alias(f"p_{c}") for c in same], "copies", "rows")
    rows = docs.select(whole_row(docs), *[c.alias(f"d_{n}") for n, c in (("doc_id", docs["doc_id"]), ("source", docs["source"]), ("h", F.xxhash64(docs["text"])))])
    met = rows.join(plan, (F.col("d_h") == F.col("p_h")) & F.col("d_doc_id").eqNullSafe(F.col("p_doc_id")) & F.col("d_source").eqNullSafe(F.col("p_source")))
    if plan.where("rows > 1").isEmpty():
        n = F.col("copies")
    else:
        nth = F.row_number().over(Window.partitionBy("d_doc_id", "d_source", "d_h").orderBy("d_h"))
        met = met.withColumn("nth", nth)
        n = F.floor(F.col("copies") / F.col("rows")) + (F.col("nth") <= F.col("copies") % F.col("rows")).cast("long")
    met = met.withColumn("times", n.cast("int")).where("times > 0")
    return met.select("row", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("copy")).select("row.*")
