"""Queries on creation times.  File names, issues and posts are derived from the orders' and events' times, so that the SQL
checks know the dates without reading them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from annoframe.functions import dates
from annoframe.operators import creation
from annoframe.plans.base import query, table

#: Estonian month names as they are written, and the forms in turn that an order's date takes.
MONTHS = ("jaanuar", "veebruar", "märts", "aprill", "mai", "juuni", "juuli", "august", "september", "oktoober", "november", "detsember")
PAPERS = ("aja_EPL_{d}.x", "aja_SLOLEHT_{d}.x", "aja_pm_{d}Extra.x", "aja_le_{d}.x", "aja_kr_{d}.x", "aja_vm_{d}.x", "aja_luup_{y}_9.x", "aja_luup_{y}_9.x", "aja_ml_{y}_40.x", "aja_ee_{y}_7.x", "other.x", "feed")
DATES_SQL = """WITH o AS (SELECT o_orderkey AS text_id, o_orderkey % 12 AS k, o_orderdate AS ts FROM orders),
dated AS (SELECT text_id, CASE WHEN k = 7 THEN strftime(ts, '%Y-%m-XX') WHEN k = 9 THEN strftime(ts, '%Y-XX-XX') WHEN k = 10 THEN 'XXXX-XX-XX' ELSE strftime(ts, '%Y-%m-%d') END AS dct FROM o)"""


def _orders(spark, d):
    """text_id, k (form), src, file, issue, stamp."""
    at, k = F.col("o_orderdate"), F.col("o_orderkey") % len(PAPERS)
    y, m, day = F.year(at), F.month(at), F.dayofmonth(at)
    date = F.concat_ws("_", y, m, day)
    file = F.element_at(F.array(*map(F.lit, PAPERS)), (k + 1).cast("int"))
    name = F.element_at(F.array(*map(F.lit, MONTHS)), m)
    issue = F.when(k == 6, F.concat(F.lit("Luup Nr . 9 ( 118 ) , "), day, F.lit("."), name, F.lit(" "), y)).when(k == 7, F.concat(F.lit("Luup Nr . 12 ( 139 ) , "), name, F.lit(" "), y)).when(k == 8, F.concat(F.lit("Maaleht "), day, F.lit("."), m, F.lit("."), y, F.lit(" ( number 40 )")))
    src = F.when(k == 11, "Timestamped 2014").when(k < 6, "Reference Corpus 1990").otherwise("Balanced Corpus 1990")
    stamp = F.when(k == 11, F.date_format(at, "yyyy-M-d HH:mm"))
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("text_id"), k.alias("k"), src.alias("src"), F.replace(F.replace(file, F.lit("{d}"), date), F.lit("{y}"), y.cast("string")).alias("file"), issue.alias("issue"), stamp.alias("stamp"))


def _dated(spark, d):
    return _orders(spark, d).withColumn("dct", dates.creation_time(F.col("src"), F.col("file"), F.col("issue"), F.col("stamp")))


@query(DATES_SQL + " SELECT text_id, dct FROM dated")
def creation_times(spark, d):
    return _dated(spark, d).select("text_id", "dct")


@query(DATES_SQL + ", c AS (SELECT CASE WHEN dct = 'XXXX-XX-XX' THEN 'unknown_date' WHEN contains(dct, 'X') THEN 'partial_date' ELSE 'full_date' END AS kind, count(*) AS n FROM dated GROUP BY 1) SELECT kind, n, round(n * 100 / sum(n) OVER (), 4) AS pct FROM c")
def creation_time_report(spark, d):
    return creation.completeness_report(_dated(spark, d), "dct")


#: Files of a mixed collection in turn, and what each is known to say.
MIXED = (("rkogu_{y}_{m}.x", "strftime(o_orderdate, '%Y-%m-XX')"), ("tea_eesti_arst_{y}.x", "strftime(o_orderdate, '%Y-%m-XX')"), ("tea_AA_{yy}_2.x", "strftime(o_orderdate, '%Y-04-XX')"),
         ("xagraar_{y}.x", "strftime(o_orderdate, '%Y-XX-XX')"), ("horisont_{y}.x", "strftime(o_orderdate, '%Y-XX-XX')"),
         ("delfi{dd}{mm}{yy}.x", "strftime(o_orderdate, '%Y-%m-%d')"),
         ("tea_ESA_49.x", "'2003-XX-XX'"), ("tea_x.x", "'XXXX-XX-XX'"), ("ilu_x.x", "'XXXX-XX-XX'"), ("none.x", "'none'"), ("aja_EPL_{y}_{m}_{d}.x", "strftime(o_orderdate, '%Y-%m-%d')"))


@query("SELECT o_orderkey AS text_id, CASE o_orderkey % 11 " + " ".join(f"WHEN {k} THEN {f}" for k, (_, f) in enumerate(MIXED)) + " END AS dct FROM orders")
def mixed_creation_times(spark, d):
    at, file = F.col("o_orderdate"), F.element_at(F.array(*[F.lit(f) for f, _ in MIXED]), (F.col("o_orderkey") % len(MIXED) + 1).cast("int"))
    for mark, form in (("{yy}", "yy"), ("{mm}", "MM"), ("{dd}", "dd"), ("{y}", "yyyy"), ("{m}", "M"), ("{d}", "d")):
        file = F.replace(file, F.lit(mark), F.date_format(at, form))
    title = F.concat(F.lit("Nr 3 "), F.initcap(F.element_at(F.array(*map(F.lit, MONTHS)), F.month(at))), F.lit(" "), F.year(at))
    rows = table(spark, d, "orders").select(F.col("o_orderkey").alias("text_id"), file.alias("file"), title.alias("title"), F.lit("jututoavestlus").alias("subcorpus"), F.lit(None).cast("string").alias("issue"))
    found = dates.creation_time_mixed(F.col("file"), F.col("subcorpus"), F.col("issue"), F.col("issue"), F.col("title"))
    return rows.select("text_id", F.coalesce(found, F.lit("none")).alias("dct"))


def _posts(spark, d):
    """event_id, user_id, posted: the events' times in the seven forms in turn."""
    at, k = F.col("ts"), F.col("event_id") % 7
    f = lambda form: F.date_format(at, form)
    name = F.element_at(F.array(*map(F.lit, MONTHS)), F.month(at))
    posted = (
        F.when(k == 0, f("dd.MM.yyyy HH:mm")).when(k == 1, F.concat(F.lit("Wed , "), f("dd MMM yyyy HH:mm:ss"), F.lit(" +0200 ( EET )"))).when(k == 2, F.concat(f("d MMM yyyy HH:mm:ss"), F.lit(" +0200")))
        .when(k == 3, F.concat(f("d"), F.lit(". "), name, F.lit(" "), f("yyyy"), F.lit(". a. "), f("H : mm"))).when(k == 4, F.concat(F.lit("Thu , "), f("dd MMM yy HH:mm:ss"), F.lit(" GMT"))).when(k == 5, f("dd-MM-yyyy , HH:mm")).otherwise(f("d.M.yyyy"))
    )
    return table(spark, d, "events").select("event_id", "user_id", posted.alias("posted"))


POSTS_SQL = "WITH p AS (SELECT event_id, user_id, CASE WHEN event_id % 7 = 6 THEN strftime(ts, '%Y-%m-%dTXX:XX') ELSE strftime(ts, '%Y-%m-%dT%H:%M') END AS post FROM events)"


@query(POSTS_SQL + " SELECT event_id, post FROM p")
def iso_post_times(spark, d):
    return _posts(spark, d).select("event_id", dates.iso_minutes(F.col("posted")).alias("post"))


@query(POSTS_SQL + " SELECT coalesce(user_id, -1) AS user_id, min(post) AS first_post, max(post) AS last_post, count(*) AS n_posts FROM p GROUP BY user_id")
def post_spans(spark, d):
    return creation.post_span(_posts(spark, d), ["user_id"], "posted").withColumn("user_id", F.coalesce("user_id", F.lit(-1).cast("long")))


@query(DATES_SQL + ", f AS (SELECT strftime(ts, '%Y') AS y, min(strftime(ts, '%Y-%m-%d')) AS found FROM o WHERE k = 9 GROUP BY 1) SELECT o.text_id, CASE WHEN k = 9 THEN found ELSE dct END AS dct FROM o JOIN dated USING (text_id) LEFT JOIN f ON f.y = strftime(ts, '%Y')")
def resolved_creation_times(spark, d):
    """Partial dates of weeklies get the first date known for their file."""
    weekly = table(spark, d, "orders").where(F.col("o_orderkey") % len(PAPERS) == 9)  # the form that names the year only
    found = weekly.groupBy(F.concat(F.lit("aja_ee_"), F.year("o_orderdate"), F.lit("_7.x")).alias("file")).agg(F.min(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("found"))
    return creation.resolved(_dated(spark, d).withColumn("title", F.lit("")), found).select("text_id", "dct")
