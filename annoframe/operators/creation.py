"""Creation times of documents: first and last posts, look-ups by file and title, completeness."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from annoframe.functions import dates


def post_span(posts: DataFrame, by: list[str], posted: str) -> DataFrame:
    """First and last readable time of the posts of a file or topic; posts without one don't count."""
    times = posts.withColumn("at", dates.iso_minutes(F.col(posted))).where("at is not null")
    return times.groupBy(*by).agg(F.min("at").alias("first_post"), F.max("at").alias("last_post"), F.count("*").alias("n_posts"))


def resolved(docs: DataFrame, by_file: DataFrame, by_title: DataFrame | None = None) -> DataFrame:
    """docs: text_id, file, title, dct (may be null or partial).  A time that is null or has an X is replaced by the one
    found for the file and title, else for the file (by_*: file[, title], found); what is left is unknown.

    One row per document as long as by_file and by_title have one row per key."""
    d = docs.join(by_file.select("file", F.col("found").alias("of_file")), "file", "left")
    of_title = F.lit(None).cast("string")
    if by_title is not None:
        d = d.join(by_title.select("file", "title", F.col("found").alias("of_title")), ["file", "title"], "left")
        of_title = F.col("of_title")
    unsure = F.col("dct").isNull() | F.col("dct").contains("X")
    found = F.when(unsure, F.coalesce(of_title, F.col("of_file"), F.col("dct"))).otherwise(F.col("dct"))
    return d.select("text_id", "file", F.coalesce(found, F.lit(dates.UNKNOWN)).alias("dct"))


def completeness_report(docs: DataFrame, date: str) -> DataFrame:
    """Documents with a full, partial and unknown date, and the share of each in per cent."""
    c = docs.groupBy(dates.completeness(F.col(date)).alias("kind")).agg(F.count("*").alias("n"))
    return c.withColumn("pct", F.round(F.col("n") * 100 / F.sum("n").over(Window.partitionBy()), 4))  # three rows
