"""Reproducible samples: rows in the order of md5(seed | key), whatever the cluster."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annoframe.operators.collection import numbered

FEW = 10_000  # rows that a top-k brings into one task


def turn(seed: int, key: Column) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), key.cast("string")))


def pick(rows: DataFrame, k: int, seed: int, key: str) -> DataFrame:
    """k rows, all if there are fewer.  Up to `FEW` of them by a top-k; more by the place where the k-th hash stands: rows are
    counted by the hash's first three digits, then within the stretch that holds it by the next three, until that stretch
    is short.  What is before it is taken by a filter, without an order, and the rest by a top-k of the stretch."""
    own = turn(seed, F.col(key))
    if k <= FEW:
        return rows.orderBy(own, key).limit(k)
    known, left = "", k  # all rows whose hash is below `known` are in; so many are to come from those that begin with it
    while len(known) < 30:
        digits = F.substring(own, len(known) + 1, 3).alias("digits")
        counts = rows.where(own.startswith(known)).groupBy(digits).agg(F.count("*").alias("n")).orderBy("digits").collect()  # 4096 at most
        for r in counts:
            if r.n >= left:
                break
            left -= r.n
        else:
            return rows.where((own < known) | own.startswith(known))  # fewer than k in all
        known += r.digits
        if r.n <= FEW:
            break
    return rows.where(own < known).union(rows.where(own.startswith(known)).orderBy(own, key).limit(left))


def pick_bounded(rows: DataFrame, k: int, seed: int, key: str, size: str, least: int, most: int) -> DataFrame:
    """k rows of a size within bounds."""
    return pick(rows.where(F.col(size).between(least, most)), k, seed, key)


def goals(rows: DataFrame, by: str, size: str, wanted: int) -> DataFrame:
    """Each category's share of all sizes, and the whole part of that share of the wanted size.  More than there is is an error."""
    sums = rows.groupBy(by).agg(F.sum(size).alias("total"))
    everything = F.sum("total").over(Window.partitionBy())
    share = F.when(everything >= wanted, F.col("total") / everything).otherwise(F.raise_error(F.lit(f"{wanted} wanted, which is over the whole")).cast("double"))
    return sums.select(by, "total", F.round(share, 6).alias("share"), F.floor(share * wanted).alias("goal"))


def pick_budget(rows: DataFrame, by: str, size: str, wanted: int, seed: int, key: str) -> DataFrame:
    """Rows of each category until their sizes reach its goal; the row that crosses it is in.  Sizes are summed by the first two
    digits of the order's hash, so that only stretches that begin below the goal are put in order, each by itself."""
    r = rows.withColumn("turn", turn(seed, F.col(key))).withColumn("part", F.substring("turn", 1, 2))
    sums = r.groupBy(by, "part").agg(F.sum(size).alias("n"))
    base = F.coalesce(F.sum("n").over(Window.partitionBy(by).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = sums.select(by, "part", base.alias("base")).join(goals(rows, by, size, wanted).select(by, "goal"), by).where("base < goal")
    order = Window.partitionBy(by, "part").orderBy("turn", key).rowsBetween(Window.unboundedPreceding, -1)
    near = r.join(parts, [by, "part"]).withColumn("before", F.col("base") + F.coalesce(F.sum(size).over(order), F.lit(0)))
    return near.where("before < goal").select(*rows.columns)


def _ranked(rows: DataFrame, by: str, seed: int, key: str, most: int) -> DataFrame:
    """The first `most` rows of each category, numbered; limited before rows are gathered."""
    nth = F.row_number().over(Window.partitionBy(by).orderBy(turn(seed, F.col(key)), key))
    return rows.withColumn("nth", nth).where(F.col("nth") <= most)


def quotas(rows: DataFrame, by: str, k: int) -> DataFrame:
    """k div categories each, one more for the first k mod categories in order of name.  One row per category."""
    c = rows.groupBy(by).agg(F.count("*").alias("n_rows"))
    place, number = F.row_number().over(Window.orderBy(by)), F.count("*").over(Window.partitionBy())
    return c.select(by, "n_rows", (F.floor(F.lit(k) / number) + F.when(place <= F.pmod(F.lit(k), number), 1).otherwise(0)).cast("long").alias("quota"))


def pick_even(rows: DataFrame, by: str, k: int, seed: int, key: str) -> DataFrame:
    """As many rows of each category, as far as it has them."""
    return _ranked(rows, by, seed, key, k).join(quotas(rows, by, k), by).where("nth <= quota").select(*rows.columns)


def pick_even_numeric(rows: DataFrame, by: str, k: int, seed: int, key: str, skipped: list[str]) -> DataFrame:
    """Even over the categories that are not skipped, of rows whose key is a number."""
    return pick_even(rows.where(~F.coalesce(F.col(by).isin(skipped), F.lit(False)) & F.col(key).rlike("^[0-9]+$")), by, k, seed, key)


def total(rows: DataFrame, size: str) -> DataFrame:
    """One row: the number of rows and the sum of their sizes."""
    return rows.agg(F.count("*").alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("total"))


def pick_even_or_any(rows: DataFrame, by: str, k: int, seed: int, key: str) -> DataFrame:
    """Even only if k divides by the number of categories and each is large enough; any k rows else."""
    q = quotas(rows, by, k)
    even = q.agg(((F.count("*") <= k) & (F.pmod(F.lit(k), F.count("*")) == 0) & F.bool_and(F.col("n_rows") >= F.col("quota"))).alias("even"))
    a = pick_even(rows, by, k, seed, key).crossJoin(F.broadcast(even)).where("even").select(*rows.columns)  # one row
    b = pick(rows, k, seed, key).crossJoin(F.broadcast(even)).where("not even").select(*rows.columns)
    return a.union(b)


def pick_spread(rows: DataFrame, by: str, k: int, seed: int, key: str) -> DataFrame:
    """Even; what short categories lack goes to the others, one each per round in order of name."""
    q = quotas(rows, by, k)
    lack = q.agg(F.sum(F.greatest(F.col("quota") - F.col("n_rows"), F.lit(0))).alias("lack"))
    ranked = _ranked(rows, by, seed, key, 2 * k).join(q, by)  # a quota and as many more at most
    base = ranked.where("nth <= quota")
    more = ranked.where("nth > quota").withColumn("round", F.col("nth") - F.col("quota"))
    more = more.where(F.col("round") <= k)  # no further round can be reached
    slot = F.row_number().over(Window.orderBy("round", by))
    extra = more.withColumn("slot", slot).crossJoin(F.broadcast(lack)).where("slot <= lack")  # one row
    return base.select(*rows.columns).union(extra.select(*rows.columns))


def round_robin(rows: DataFrame, by: str, n: int, key: str, block: str) -> DataFrame:
    """Groups 0..n-1 in turn within each category.  block: as in `collection.numbered`."""
    return numbered(rows, by, key, block).withColumn("grp", F.pmod(F.col("nth") - 1, F.lit(n))).drop("nth")


def checked_size(rows: DataFrame, k: int) -> DataFrame:
    """The same rows; k over their number is an error."""
    n = rows.count()
    if k > n:
        raise ValueError(f"{k} rows wanted of {n}")
    return rows


def extremes(rows: DataFrame, size: str) -> DataFrame:
    """One row: number of rows, sum of sizes, least and largest."""
    return rows.agg(F.count("*").alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("total"), F.min(size).alias("least"), F.max(size).alias("most"))
