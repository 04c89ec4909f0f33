"""Operator 10, secret scans: patterns, and character Markov models compared by log-likelihood ratio.

Base kinds are patterns (assign, access, hex).  The method adds tokens that look random: a first-order Markov model of
characters of random strings is compared with one of ordinary identifiers, and the sum of the log-likelihood ratios of a
candidate's transitions is told from its `threshold`.  A candidate is a stretch of `TOKEN_MIN` or more token characters
outside all base spans; what a base span leaves of a longer run is a candidate of its own.  Added spans are of kind
`markov`.

Both models and the threshold are trained from labelled samples (`labelled`: value, random).  By default
(`default_samples`) random strings are digests in four spellings, which are random by construction.  Ordinary ones are
the words of about `max_docs` documents (all if there are fewer; picked by a hash of their id), alone and joined as
identifiers are, and names of the shapes that code and markup are full of (`ordinary_names`: camel and snake case, paths, dotted
names, versions, dates, numbers, rules of one character), made from common words; those bounds are the only ones.  Pairs that
neither sort shows are smoothed so far that a few odd ones don't make a name a secret.  Half of the samples train the models, the others set the threshold: the least value that at most
`false_rate` of the ordinary ones exceed.  `quality_of` gives precision and recall on any labelled strings.

DataFrame functions only.  Every text is matched once: the pieces between matches (`split`) and the matches
(`regexp_extract_all`) are stored in short rows, and places come from running sums over them, in time in proportion to the
matches.  The models are a table of at most 67 x 67 pairs of characters.

Edge cases: null text is empty; a text without matches has no spans; spans of different kinds may overlap; without samples
of either sort nothing is added; repeated rows are scanned each.  Other columns are not read.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, cut, stored

# Fixed patterns. Leftmost matches, not overlapping within a kind; a match stays if it, or its value, is long enough.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_MIN = 12
#: The whole match of a run of one class that starts anywhere in the run, if long enough.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
TOKEN_MIN = 12
TOKEN = r"[A-Za-z0-9+/_=-]{12,}"
PATTERNS = (ASSIGN, ACCESS, HEX, TOKEN)
KINDS = ("assign", "access", "hex", "markov")
MARKOV = 3
SMOOTH = 20.0  # added to the count of each pair by `default_models`
#: Common words of names in code.
NAME_WORDS = (
    "get set add put new old is has to from by of in on at with and or not all any first last next previous index count size length total sum max min average "
    "user name account balance id key value item list array map table row column field type class object node tree path file folder directory root home local "
    "lib bin usr var etc opt share data base model view controller service server client request response message error warning status code result test main "
    "python java script http https www com org net html json xml text image video audio document page header footer title body content description config "
    "setting option default property attribute create read update delete remove insert select filter order group join load save open close start stop run "
    "begin end time date year month day hour minute second event handler listener manager factory builder helper util common core public private static "
    "final function method return string number integer float double boolean true false null address email phone customer order product price currency payment "
    "version release build package module import export width height color background border margin window screen button label input output"
).split()
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."


class Models(NamedTuple):
    ratio: dict[str, float]  # of each pair of characters: log-likelihood under random less that under ordinary
    unseen: float  # of pairs with a character of neither
    threshold: float  # infinite without samples of both sorts


def matches(text: Column, pattern: str, kind: int) -> Column:
    """Array of (kind, nth, gap, found): each match and the length of the text between it and the one before; empty where
    there is none."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.slice(F.transform(F.split(text, pattern, -1), F.length), 1, F.size(found))
    item = lambda x, k: F.struct(F.lit(kind).alias("kind"), k.alias("nth"), x["gap"].alias("gap"), x["found"].alias("found"))
    each = F.transform(F.arrays_zip(gaps.alias("gap"), found.alias("found")), item)
    return F.when(text.rlike(pattern), each).otherwise(F.array().cast("array<struct<kind:int,nth:int,gap:int,found:string>>"))


def scanned(docs: DataFrame) -> DataFrame:
    """key (a number of the row), doc_id, found (matches of all patterns), stored; texts are left behind."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"))
    every = F.concat(*[matches(F.col("text"), p, k) for k, p in enumerate(PATTERNS)])
    return stored(rows.select(F.monotonically_increasing_id().alias("key"), "doc_id", every.alias("found")), "matches")


def placed(rows: DataFrame) -> DataFrame:
    """key, kind, start, end, found of every match that is long enough."""
    each = rows.select("key", F.explode("found").alias("m")).select("key", "m.*")
    so_far = Window.partitionBy("key", "kind").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.length("found")).over(so_far).cast("int")
    spans = each.withColumn("end", end).withColumn("start", F.col("end") - F.length("found"))
    long_enough = (F.col("kind") != 0) | (F.length(F.regexp_extract("found", ASSIGN, 2)) >= ASSIGN_MIN)
    return spans.where(long_enough).select("key", "kind", "start", "end", "found")


def candidates(spans: DataFrame) -> DataFrame:
    """key, start, end, found: stretches of token runs outside all base spans, TOKEN_MIN long at least.

    The edges of all spans of a text are walked in order: a stretch lies in a run and in no base span."""
    run = F.col("kind") == MARKOV
    info = F.when(run, F.struct("start", "found"))
    keyed = spans.join(spans.where(run).select("key").distinct(), "key", "left_semi")  # texts with a run
    edges = keyed.select("key", F.col("start").alias("at"), run.cast("int").alias("runs"), (~run).cast("int").alias("bases"), info.alias("opens"))
    edges = edges.union(keyed.select("key", "end", -run.cast("int"), -(~run).cast("int"), F.lit(None).cast(edges.schema["opens"].dataType)))
    edges = edges.groupBy("key", "at").agg(F.sum("runs").alias("runs"), F.sum("bases").alias("bases"), F.max("opens").alias("opens"))
    order = Window.partitionBy("key").orderBy("at")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    walked = edges.select("key", F.col("at").alias("start"), F.lead("at").over(order).alias("end"), F.sum("runs").over(so_far).alias("runs"), F.sum("bases").over(so_far).alias("bases"), F.last("opens", ignorenulls=True).over(so_far).alias("run"))
    free = walked.where((F.col("runs") > 0) & (F.col("bases") == 0) & (F.col("end") - F.col("start") >= TOKEN_MIN))
    return free.select("key", "start", "end", F.substring("run.found", F.col("start") - F.col("run.start") + 1, F.col("end") - F.col("start")).alias("found"))


def characters(value: Column) -> Column:
    return F.regexp_extract_all(value, F.lit("(?s)."), F.lit(0))


def transitions(value: Column) -> Column:
    """Pairs of neighbouring characters of a string."""
    c = characters(value)
    pairs = F.arrays_zip(F.slice(c, 1, F.size(c) - 1).alias("x"), F.slice(c, 2, F.size(c) - 1).alias("y"))
    return F.when(F.length(value) >= 2, F.transform(pairs, lambda p: F.concat(p["x"], p["y"]))).otherwise(F.array().cast("array<string>"))


def default_samples(docs: DataFrame, max_docs: int = 2_000, n_random: int = 20_000) -> DataFrame:
    """value, random: digests of numbers in hexadecimal, base 64 and two mixtures of letters and digits, of many lengths; words
    of documents, and two or three of them joined by _ or - or capitals, some with a number."""
    spark = docs.sparkSession
    digest = F.base64(F.unhex(F.sha2(F.col("id").cast("string"), 512)))
    length = (F.lit(TOKEN_MIN) + F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(37))).cast("int")
    kind = F.pmod(F.col("id"), F.lit(4))
    plain = F.regexp_replace(digest, "[+/=\n\r]", "")
    spelled = F.when(kind == 0, F.sha2(F.col("id").cast("string"), 256)).when(kind == 1, F.regexp_replace(digest, "[\n\r]", "")).when(kind == 2, plain).otherwise(F.regexp_replace(plain, "[0-9]", ""))
    random = spark.range(n_random).select(F.substring(spelled, F.lit(1), length).alias("value"), F.lit(True).alias("random"))
    share = min(1.0, max_docs / max(1, docs.count()))
    own = F.xxhash64(F.lit(3), "doc_id", F.length("text"))
    picked = docs.where(F.col("text").isNotNull() & (F.pmod(own, F.lit(1 << 30)) < F.lit(share * (1 << 30)))).select("text", own.alias("h"))
    word = F.regexp_replace(F.col("w"), "^[^A-Za-z]+|[^A-Za-z]+$", "")
    words = cut(picked.select("h", F.posexplode(F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).alias("pos", "w")).select("h", "pos", word.alias("w")).where("w rlike '^[A-Za-z][a-z]+$'"))
    distinct = words.groupBy("w").agg(F.min(F.struct("h", "pos")).alias("p")).select("w", F.xxhash64(F.lit(5), "w").alias("t"), F.xxhash64(F.lit(7), "w").alias("u"))
    # each word with two others: the next ones in the order of a hash, inside groups by another hash
    inside = Window.partitionBy(F.pmod("u", F.lit(64))).orderBy("t")
    three = distinct.select("w", F.lead("w").over(inside).alias("x"), F.lead("w", 2).over(inside).alias("y"), F.pmod("t", F.lit(6)).alias("form"), F.pmod("u", F.lit(2000)).cast("string").alias("n")).where("y is not null")
    form = F.col("form")
    joined = F.when(form == 0, F.concat_ws("_", "w", "x", "y")).when(form == 1, F.concat_ws("-", "w", "x", "y")).when(form == 2, F.concat("w", F.initcap("x"), F.initcap("y"))).when(form == 3, F.upper(F.concat_ws("_", "w", "x")))
    joined = joined.when(form == 4, F.concat_ws("_", "w", "x", "n")).otherwise(F.concat_ws("/", "w", "x", "y"))
    ordinary = three.select(F.explode(F.array("w", joined)).alias("value"), F.lit(False).alias("random"))
    return random.union(ordinary).union(ordinary_names(spark))


def ordinary_names(spark: SparkSession, n: int = 60_000) -> DataFrame:
    """value, random (false): names of two to five common words in the ways that code and markup join them, some with numbers;
    versions, dates and numbers; rules of one character."""
    words = F.array(*map(F.lit, NAME_WORDS))
    pick = lambda k: F.get(words, F.pmod(F.xxhash64(F.lit(k), "id"), F.lit(len(NAME_WORDS))).cast("int"))
    roll = lambda k, most: F.pmod(F.xxhash64(F.lit(k), "id"), F.lit(most)).cast("int")
    own = F.slice(F.array(*[pick(k) for k in range(5)]), 1, roll(10, 4) + 2)
    upper = F.transform(own, F.initcap)
    number = roll(11, 10_000).cast("string")
    camel = F.concat(F.element_at(own, 1), F.array_join(F.slice(upper, 2, 4), ""))
    day = F.date_format(F.date_add(F.lit("1990-01-01"), roll(12, 15_000)), "yyyy-MM-dd")
    clock = F.format_string("%02d-%02d-%02d", roll(13, 24), roll(14, 60), roll(15, 60))
    mark = F.substring(F.lit("-=_+/.axX0oO1z*"), roll(16, 15) + 1, F.lit(1))
    digits = F.concat(*[F.abs(F.xxhash64(F.lit(k), "id")).cast("string") for k in (17, 18)])
    forms = [
        camel, F.array_join(upper, ""), F.array_join(own, "_"), F.array_join(own, "-"), F.upper(F.array_join(own, "_")), F.array_join(own, "."), F.array_join(own, "/"),
        F.concat(F.lit("/"), F.array_join(own, "/")), F.concat(F.array_join(own, "_"), F.lit("_"), number), F.concat(camel, number), F.concat(F.array_join(own, "-"), F.lit("-v"), roll(19, 20).cast("string")),
        F.array_join(own, ""), F.concat(F.array_join(own, "/"), F.lit("."), pick(20)), F.concat(F.lit("__"), F.array_join(own, "_"), F.lit("__")), F.concat(day, F.lit("T"), clock), F.concat(F.replace(day, F.lit("-"), F.lit("")), F.replace(clock, F.lit("-"), F.lit(""))),
        F.substring(digits, F.lit(1), roll(21, 16) + 12), F.repeat(mark, roll(23, 12) + 12), F.repeat(pick(25), 3),
        F.concat(F.array_join(upper, "-"), F.lit("_"), day), F.concat(F.array_join(own, "+"), F.lit("="), number), F.concat(F.array_join(own, "_"), F.lit("="), pick(26)), F.concat(F.upper(pick(27)), F.lit("-"), F.lpad(number, 8, "0")),
    ]
    return spark.range(n).select(F.get(F.array(*forms), roll(28, len(forms))).alias("value"), F.lit(False).alias("random"))


def default_models(docs: DataFrame) -> Models:
    """Models of the default samples."""
    return fit(default_samples(docs), SMOOTH, repeats=False)


def fit(samples: DataFrame, smooth: float = 0.5, false_rate: float = 0.001, repeats: bool = True) -> Models:
    """Models from one half of the samples (by a hash of the value), the threshold from the ordinary ones of the other.
    Without `repeats`, a character that follows itself never speaks for randomness, as in long rules of one."""
    held = F.pmod(F.xxhash64(F.lit(11), "value"), F.lit(2)) == 1
    samples = cut(samples.where("value is not null").select("value", F.col("random").cast("int").alias("r"), held.alias("held")))
    pairs = samples.where("not held").select("r", F.explode(transitions(F.col("value"))).alias("pair"))
    count = {(x.r, x.pair): x["count"] for x in pairs.groupBy("r", "pair").count().collect()}  # pairs of characters
    if not any(r for r, _ in count) or all(r for r, _ in count):
        return Models({}, 0.0, math.inf)
    seen = sorted({c for _, pair in count for c in pair} | set(ALPHABET))
    first = {(r, a): sum(n for (q, p), n in count.items() if q == r and p[0] == a) for r in (0, 1) for a in seen}
    log = lambda r, p: math.log((count.get((r, p), 0) + smooth) / (first[r, p[0]] + smooth * len(seen)))
    ratio = {a + b: log(1, a + b) - log(0, a + b) for a in seen for b in seen}
    if not repeats:
        ratio |= {a + a: min(0.0, ratio[a + a]) for a in seen}
    models = Models(ratio, 0.0, 0.0)
    others = samples.where("held and r = 0").where(F.length("value") >= TOKEN_MIN).agg(F.percentile(score(models, F.col("value")), 1 - false_rate)).first()[0]
    return models._replace(threshold=max(0.0, others or 0.0))


def constants(values: list, kind: str) -> Column:
    """An array of numbers as one constant."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast(f"array<{kind}>")


def score(models: Models, value: Column) -> Column:
    """Sum of the log-likelihood ratios of a string's transitions, in one walk over its characters.  A pair with a character
    of neither model counts as `unseen`."""
    known = sorted({c for pair in models.ratio for c in pair})
    n = len(known) + 1
    place = constants([known.index(chr(k)) if chr(k) in known else n - 1 for k in range(128)], "int")
    table = constants([models.ratio.get(a + b, models.unseen) for a in [*known, ""] for b in [*known, ""]], "double")
    own = lambda c: F.coalesce(F.get(place, F.ascii(c)), F.lit(n - 1))

    def step(acc: Column, c: Column) -> Column:
        added = F.when(acc["last"] >= 0, F.get(table, acc["last"] * n + own(c))).otherwise(0.0)
        return F.struct(own(c).alias("last"), (acc["sum"] + added).alias("sum"))

    return F.aggregate(characters(value), F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("sum")), step, lambda acc: acc["sum"])


def quality_of(models: Models, samples: DataFrame) -> tuple[float, float]:
    """Precision and recall on labelled strings (value, random) of TOKEN_MIN characters or more."""
    said = samples.where(F.length("value") >= TOKEN_MIN).select("random", (score(models, F.col("value")) > models.threshold).alias("said"))
    hit, told, there = said.agg(F.count_if(F.col("random") & F.col("said")), F.count_if("said"), F.count_if("random")).first()
    return hit / told if told else 1.0, hit / there if there else 1.0


def found_spans(rows: DataFrame, models: Models) -> DataFrame:
    """key, kind, start, end of all base spans and of the candidates over the threshold.  rows: as of `scanned`."""
    spans = cut(placed(rows))
    base = spans.where(F.col("kind") != MARKOV).select("key", "kind", "start", "end")
    if not models.ratio:
        return base
    added = candidates(spans).where(score(models, F.col("found")) > models.threshold)
    return base.union(added.select("key", F.lit(MARKOV), "start", "end"))


def listed(spans: Column) -> Column:
    name = lambda s: F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s), s["start"], s["end"])), ",")


def scan(docs: DataFrame, models: Models | None = None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_markov."""
    models = models or default_models(docs)
    rows = scanned(docs)
    of_text = found_spans(rows, models).groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("all"))
    every = F.coalesce("all", F.array().cast("array<struct<start:int,kind:int,end:int>>"))
    out = rows.select("key", "doc_id").join(of_text, "key", "left").select("doc_id", every.alias("all"))
    n = lambda k: F.size(F.filter("all", lambda s: s["kind"] == k)).cast("long")
    base = F.filter("all", lambda s: s["kind"] != MARKOV)
    return out.select("doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"), F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("all")).alias("spans"), n(MARKOV).alias("n_markov"))


def session_models(spark: SparkSession, path: str) -> Models:
    """Models from a table of labelled samples (value, random) of one's own."""
    return fit(spark.read.parquet(path))
