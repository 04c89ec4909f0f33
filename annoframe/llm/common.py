"""Shared folder, lineage cuts and small frame helpers of the training-data operators."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_OWN: list[str] = []

#: Words are maximal runs of anything but these six characters.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: spark.checkpoint.dir; a folder of our own only where that is unset
    and everything runs on one machine.  (`sources.store` has the like, as nothing else may import this subpackage.)"""
    set_dir = spark.conf.get("spark.checkpoint.dir", "")
    if set_dir:
        return set_dir.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _OWN:
        _OWN.append("file://" + tempfile.mkdtemp(prefix="annoframe-"))
    return _OWN[0]


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint; for small rows."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def stored_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write a table in the shared folder and read it back; for rows with payloads, which stay columnar and compressed."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def stored(df: DataFrame, name: str) -> DataFrame:
    return stored_at(df, name)[0]


def removed(spark: SparkSession, path: str) -> None:
    """Delete a table that stored_at wrote and that nothing reads any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of a query go as soon as it has run; else they stay until the driver collects its garbage.  For
    queries whose rows are stored, cut or taken by the driver, as a frame that runs twice would make its shuffles again."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def columns_of(df: DataFrame) -> list[Column]:
    """All columns, whatever characters their names have."""
    return [df["`" + c.replace("`", "``") + "`"] for c in df.columns]


def whole_row(df: DataFrame) -> Column:
    """All columns as one column `row`, beside which helper columns can stand under any name; `row.*` gives them back."""
    return F.struct(*columns_of(df)).alias("row")


def arrow_schema(rows: DataFrame, kept: str, added: str) -> StructType:
    """Schema of a mapInArrow that passes the columns `kept` (comma-separated) and adds those of a DDL text."""
    return StructType([rows.schema[c.strip()] for c in kept.split(",") if c.strip()] + StructType.fromDDL(added).fields)


def sent_if_small(df: DataFrame, most: int = 300_000) -> DataFrame:
    """A frame of a few numbers a row, marked for broadcast if it has at most so many rows; else joined by shuffle.  The
    frame is counted, so it should be stored or cut."""
    return F.broadcast(df) if df.count() <= most else df


def rows_that_stay(docs: DataFrame, own: Column, judged: DataFrame) -> DataFrame:
    """The rows of docs that stay, with all their columns.  judged: doc_id, own, n (rows that repeat both), stays, one row for
    each pair of doc_id and `own` (a hash of the text) in docs; of repeated rows that stay, one does.

    Where few rows go, they are sent to all tasks and no text moves; else rows meet by id and hash, so that a hot group is
    spread by its ids."""
    judged = cut(judged)
    rows = docs.select(whole_row(docs), docs["doc_id"].alias("id"), own.alias("own"))
    same = lambda x, y: x["id"].eqNullSafe(y["doc_id"]) & (x["own"] == y["own"])
    gone = sent_if_small(judged.where("not stays"))
    left = rows.join(gone, same(rows, gone), "left_anti")
    repeated = judged.where("stays and n > 1")
    if repeated.isEmpty():
        return left.select("row.*")
    repeated = sent_if_small(repeated)
    again = lambda how: left.join(repeated, same(left, repeated), how)
    once = again("left_semi").groupBy("id", "own").agg(F.first("row").alias("row"))
    return again("left_anti").select("row").union(once.select("row")).select("row.*")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, everything else as it is; null is empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def unit_hash(seed: int, *cols: Column) -> Column:
    """A number in (0, 1) that depends on nothing but the seed and the columns."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *cols), 11)
    return (bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))


def kth_largest(df: DataFrame, col: str, k: int, few: int = 2000, bins: int = 4096) -> float:
    """The exact k-th largest value of a column of finite doubles.

    Each pass counts the values in equal bins of the interval that must hold the answer and goes on with one bin, so
    the driver sees bin counts, and at most `few` values at the end.  k below 1: infinity; k over the rows: minus
    infinity."""
    if k < 1:
        return math.inf
    low, high, n = df.agg(F.min(col), F.max(col), F.count(col)).first()
    if k > n:
        return -math.inf
    above = 0  # values over the interval
    inside = df.select(F.col(col).alias("v"))
    while True:
        here = inside.where(F.col("v").between(low, high))
        if low == high:
            return low
        width = (high - low) / bins
        slot = F.least(F.floor((F.col("v") - F.lit(low)) / F.lit(width)), F.lit(bins - 1))
        counts = here.groupBy(slot.alias("slot")).agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        for slot_n, lo, hi in counts.orderBy(F.desc("slot")).select("n", "lo", "hi").collect():
            if above + slot_n >= k:
                low, high, inside_n = lo, hi, slot_n
                break
            above += slot_n
        if low == high:
            return low
        if inside_n <= few:
            rows = inside.where(F.col("v").between(low, high)).collect()
            return sorted((r.v for r in rows), reverse=True)[k - above - 1]


def united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node, root of the components of all edges (a, b) of a task."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.setdefault(x, x)) != x:
            root[x] = root[up]
            x = up
        return x

    for batch in batches:
        for x, y in zip(*[batch.column(c).to_pylist() for c in ("a", "b")]):
            x, y = find(x), find(y)
            root[max(x, y)] = min(x, y)
    nodes = list(root)
    yield pa.RecordBatch.from_pydict({"node": pa.array(nodes, pa.int64()), "root": pa.array(map(find, nodes), pa.int64())})


def components(edges: DataFrame, few: int = 0) -> DataFrame:
    """Connected components of the undirected edges (a, b): one row (node, root) per node, root its component's least node.

    Alternating large-star and small-star rounds (Kiveris et al. 2014); rounds grow with the logarithm of the longest
    path.  Every round is a pre-aggregated minimum and a join, cut by a checkpoint.  Up to `few` edges, which are counted, are
    united by one task instead, without shuffles."""

    def star(pairs: DataFrame, take) -> DataFrame:
        least = pairs.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        return take(pairs.join(least, "a")).where("a <> b").distinct()

    now = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    if few and now.count() <= few:
        return cut(now.coalesce(1).mapInArrow(united, "node long, root long"))
    seen = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b").distinct())
        seen = state
        both = now.union(now.select("b", "a"))
        large = star(both, lambda x: x.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        small = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        now = cut(star(small, lambda x: x.select(F.col("b").alias("a"), F.col("m").alias("b")).union(x.select("a", F.col("m")))))


def sums_before(totals: DataFrame, key: str, value: str, width: int = 4096) -> DataFrame:
    """totals: one row per whole number `key`.  key, value and `before`, the sum of `value` over all smaller keys.  Sums over stretches
    of `width` keys come first, so that one task orders only those, and each stretch is then summed alone."""
    t = totals.select(F.col(key).alias("k"), F.col(value).alias("v"), F.floor(F.col(key) / width).alias("part"))
    whole = t.groupBy("part").agg(F.sum("v").alias("s"))
    base = whole.select("part", F.coalesce(F.sum("s").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    inside = F.coalesce(F.sum("v").over(Window.partitionBy("part").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return t.withColumn("inside", inside).join(base, "part").select(F.col("k").alias(key), F.col("v").alias(value), (F.col("base") + F.col("inside")).alias("before"))
