"""Folders that the driver and all executors see, clustered and partitioned tables, tables that are continued."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN: list[str] = []
PARTS = 4  # of a scan's task, in which documents are dealt before each is written to a file
#: Tasks put their files in place themselves; else the driver would move all of them one after the other when the write ends.  For
#: folders that are new and read after the write.
TASKS_COMMIT = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder name not yet used, below spark.checkpoint.dir; below a folder of our own only where that is unset and
    everything runs on one machine."""
    root = spark.conf.get("spark.checkpoint.dir", "")
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if not _OWN:
            _OWN.append("file://" + tempfile.mkdtemp(prefix="annoframe-"))
        root = _OWN[0]
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def clustered(rows: DataFrame, table: str, key: str = "text_id", buckets: int = 64) -> DataFrame:
    """Save as a table bucketed and sorted by the key, so that joins of such tables on it move no rows."""
    dealt = rows.repartition(buckets, key).sortWithinPartitions(key)  # one file per bucket
    dealt.write.format("parquet").bucketBy(buckets, key).sortBy(key).mode("overwrite").saveAsTable(table)
    return rows.sparkSession.table(table)


def write_layout(rows: DataFrame, folder: str, file: str, group: Column) -> None:
    """Documents in folders by file and group of ids, so that a reader of one file or group opens no other.  Rows are dealt by ranges
    of both and of a hash of the row, so that a small group is one file, or two at a range's edge, and a large one is written by
    several tasks.  The number of ranges is given, as files cost more than bytes: else Spark would put small ranges of many files
    together."""
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.withColumn("doc_group", group).repartitionByRange(ranges, file, "doc_group", F.xxhash64(*rows.columns))
    dealt.write.options(**TASKS_COMMIT).partitionBy(file, "doc_group").parquet(folder)


def read_layout(spark: SparkSession, folder: str, files: list[str] | None = None, groups: list[int] | None = None, file: str = "file") -> DataFrame:
    """The documents of the given files and groups (all if None).  Other folders are not even listed if the files have plain names,
    else pruned from the scan."""
    reader = spark.read.option("partitionColumnTypeInference.enabled", "true")
    some = f"{file}={_one_of(files)}/doc_group={_one_of(groups)}"
    try:
        rows = reader.option("basePath", folder).parquet(f"{folder}/{some}") if (files or groups) and _plain(files) else reader.parquet(folder)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = reader.parquet(folder)  # none of the wanted folders is there
    rows = rows if files is None else rows.where(F.col(file).isin(files))
    return rows if groups is None else rows.where(F.col("doc_group").isin(groups))


def _plain(names: list[str] | None) -> bool:
    """Whether names stand in paths as they are."""
    return all(re.fullmatch(r"[A-Za-z0-9_-]+", str(x)) for x in names or [])


def _one_of(values: list | None) -> str:
    """A pattern of paths for the values; any if there are none given."""
    return "{" + ",".join(map(str, values)) + "}" if values else "*"


def write_documents(rows: DataFrame, folder: str, file: str, group: Column, id_: str) -> None:
    """Documents as JSON, one to a file, in folders by file, group and id.  Rows are dealt evenly first, as each costs a file whatever its size."""
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), PARTS * rows.rdd.getNumPartitions())
    rows.repartition(parts, id_).withColumn("doc_group", group).write.options(**TASKS_COMMIT).partitionBy(file, "doc_group", id_).json(folder)


class StoredTable:
    """A table in a folder that is continued batch by batch, in parts by file and batch.

    A batch writes the parts of its own number only (dynamic partition overwrite), and reads which keys there are from the
    other batches' parts of the same files.  So a batch that was broken off, or is given again, leaves one copy of its rows, and rows
    of earlier batches are never rewritten.  One writer at a time; a number stands for the same rows each time."""

    def __init__(self, spark: SparkSession, folder: str, key: list[str], file: str = "file"):
        self.spark, self.folder, self.key, self.file = spark, folder, key, file

    def _read(self, schema=None) -> DataFrame | None:
        try:
            return (self.spark.read.schema(schema) if schema else self.spark.read).parquet(self.folder)
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return None

    def rows(self) -> DataFrame:
        """All rows, without their batches; a table that nothing was appended to is an error."""
        found = self._read()
        if found is None:
            raise ValueError(f"no table at {self.folder}")
        return found.drop("batch")

    def append(self, new: DataFrame, batch: int, most_files: int = 10_000) -> None:
        """Add the rows whose key the table lacks.  A key that is twice among those is an error, and nothing is written then.  Only
        parts of the batch's files are read, if they are `most_files` at most."""
        from annoframe.operators.collection import append_missing, unique

        there = self._read()
        if there is not None:
            known = there.where(F.col("batch") != batch)
            files = [r[0] for r in new.select(self.file).distinct().limit(most_files + 1).collect()]
            known = known.where(F.col(self.file).isin([str(f) for f in files])) if len(files) <= most_files else known
            new = append_missing(known, new, self.key)
        checked = unique(new, self.key).withColumn("batch", F.lit(batch))
        dealt = checked.repartition(self.file, F.pmod(F.xxhash64(*self.key), F.lit(8)))
        dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(self.file, "batch").parquet(self.folder)


def add_stored_layers(spark: SparkSession, folder: str, new: dict[str, DataFrame], only: list[str], update: bool = False) -> list[str]:
    """Add the listed layers to a stored collection, a table each below its folder; the names of those that were written.  A listed
    layer that is not given is an error; one that is there is kept if `update`, else an error.  A layer is there once its write has
    been committed, so one that was broken off is written anew."""
    missing = [n for n in only if n not in new]
    if missing:
        raise ValueError(f"layers not given: {missing}")
    present = [n for n in only if committed(spark, f"{folder}/{n}")]
    if present and not update:
        raise ValueError(f"layers exist: {present}")
    for name in (written := [n for n in only if n not in present]):
        new[name].write.mode("overwrite").parquet(f"{folder}/{name}")
    return written


def committed(spark: SparkSession, folder: str) -> bool:
    """Whether a write to the folder has ended."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
