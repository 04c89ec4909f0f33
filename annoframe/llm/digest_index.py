"""Operator 9, exact dedup: a persistent digest index, bucketed and sorted by hash.

The index is a table of rows (digest, keep_id, group_size), one for each digest, bucketed and sorted by digest and partitioned
by batch.  A batch is first reduced to its distinct digests, which removes any hot group before a join.  It then meets the
index in a sort-merge anti-join on the buckets, which moves the batch only: the digests that are left are new and are appended.
What the batch adds to digests that were there goes to a table of changes, which readers fold in: the largest keep_id, the sum
of group sizes.  DataFrame functions only.

A batch has a number.  It overwrites its own part of both tables and meets the parts of all others, so a batch that is
given again, or was broken off between the writes, counts once.  A number stands for the same rows each time.

Texts are equal when identical after lower-casing A-Z; null counts as empty.  Of equal texts the row with the largest
doc_id stays, over all batches so far; a row without id stays only in a group without ids.  A later, larger id thus takes
over a group: `resolve` tells so, `keep_one` keeps only rows of digests that its batch brought first.  Rows that repeat both
id and text are one document for `keep_one` and as many rows in `resolve`.  Other columns pass, whatever their names.

The number of buckets (the session's shuffle partitions, unless given) is stored with the index; opening it with another
is an error.  `close` takes the table out of the
session's catalogue and leaves the files.  One writer at a time.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, cut, rows_that_stay, shared_dir

ROWS = "digest STRING, keep_id BIGINT, group_size BIGINT"


def digest_of(text: Column) -> Column:
    return F.sha2(ascii_lower(text), 256)


def digested(docs: DataFrame) -> DataFrame:
    """doc_id, digest of every row."""
    return docs.select("doc_id", digest_of(docs["text"]).alias("digest"))


class DigestIndex:
    """An index at `path` (a folder of its own in the shared folder unless given), opened if there is one already."""

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None):
        self.spark, self.table = spark, f"digest_index_{uuid.uuid4().hex}"
        self.path = path or f"{shared_dir(spark)}/{self.table}"
        try:
            stored = spark.read.schema("buckets INT").parquet(f"{self.path}/buckets").first().buckets
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            stored = None
        if stored and buckets and stored != buckets:
            raise ValueError(f"the index has {stored} buckets, not {buckets}")
        self.buckets = stored or buckets or min(100_000, int(spark.conf.get("spark.sql.shuffle.partitions")))  # Spark's limit
        if not stored:
            spark.range(1).select(F.lit(self.buckets).cast("int").alias("buckets")).write.parquet(f"{self.path}/buckets")
        spark.sql(f"CREATE TABLE {self.table} ({ROWS}, batch BIGINT) USING parquet PARTITIONED BY (batch) CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self.path}/rows'")
        if stored:
            spark.sql(f"ALTER TABLE {self.table} RECOVER PARTITIONS")

    def add(self, digests: DataFrame, batch: int) -> DataFrame:
        """digests: doc_id, digest.  Adds the batch of that number; returns what it brought first (digest, keep_id, group_size)."""
        reduced = cut(digests.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")))
        known = self.spark.table(self.table).where(F.col("batch") != batch)
        fresh = cut(reduced.join(known.select("digest").hint("merge"), "digest", "left_anti").select("digest", "keep_id", "group_size"))
        # dealt by the buckets' own hash, so that each bucket gets one file of one task
        view = f"{self.table}_batch"
        fresh.repartition(self.buckets, "digest").sortWithinPartitions("digest").createOrReplaceTempView(view)
        self.spark.sql(f"INSERT OVERWRITE {self.table} PARTITION (batch = {batch}) SELECT digest, keep_id, group_size FROM {view}")
        self.spark.catalog.dropTempView(view)
        changes = reduced.join(fresh.select("digest"), "digest", "left_anti")
        changes.write.mode("overwrite").parquet(f"{self.path}/changes/batch={batch}")
        return fresh

    def rows(self) -> DataFrame:
        """The index with its changes, one row per digest.  Read without its buckets, so that a join with hot digests can be split."""
        read = lambda name: self.spark.read.schema(ROWS + ", batch BIGINT").parquet(f"{self.path}/{name}").drop("batch")
        changed = read("changes").groupBy("digest").agg(F.max("keep_id").alias("later_id"), F.sum("group_size").alias("more"))
        size = (F.col("group_size") + F.coalesce("more", F.lit(0))).alias("group_size")
        return read("rows").join(changed, "digest", "left").select("digest", F.greatest("keep_id", "later_id").alias("keep_id"), size)

    def resolve(self, digests: DataFrame) -> DataFrame:
        """digests: doc_id, digest, of rows that were added.  Adds keep_id and group_size."""
        return digests.join(self.rows(), "digest")

    def close(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")


def resolved(docs: DataFrame, batches: int = 2) -> DataFrame:
    """doc_id, digest, keep_id, group_size of every row, all fed to a new index in so many batches (dealt by a hash of the id).
    Texts are read once."""
    rows = cut(digested(docs))
    index = DigestIndex(docs.sparkSession)
    for k in range(batches):
        index.add(rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(batches)) == k), k)
    index.close()
    return index.resolve(rows)


def keep_one(docs: DataFrame, index: DigestIndex | None = None, batch: int = 0) -> DataFrame:
    """The documents that stay, with all their columns: the kept row of each digest that this batch brought first."""
    own = index or DigestIndex(docs.sparkSession)
    rows = cut(digested(docs))
    fresh = own.add(rows, batch).select("digest", F.col("keep_id").alias("keep"), F.lit(True).alias("new"))
    if not index:
        own.close()
    each = rows.groupBy("doc_id", "digest").agg(F.count("*").alias("n"))
    stays = F.col("new").isNotNull() & F.col("doc_id").eqNullSafe(F.col("keep"))
    judged = each.join(fresh, "digest", "left").select("doc_id", F.col("digest").alias("own"), "n", stays.alias("stays"))
    return rows_that_stay(docs, digest_of(docs["text"]), judged)
