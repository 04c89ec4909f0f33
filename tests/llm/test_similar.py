"""The pipeline's near copies against brute-force Jaccard similarity."""

import gc
import random
from pathlib import Path

from pyspark.sql import functions as F

import corpus_pipeline
from annoframe.llm import common, similar

KIND = "doc_id long, text string, lang string, source string, n_chars long"


def shingles(text, width=5):
    w = (text or "").lower().split()
    return {tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()


def brute(rows, similarity=0.8):
    """Least row number reachable, by row number."""
    sets, root = [shingles(t) for _, t in rows], list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if x == y or len(x & y) >= similarity * len(x | y) - 1e-9:
                i, j = find(a), find(b)
                root[max(i, j)] = min(i, j)
    return [find(k) for k in range(len(rows))]


def edited(rng, words, n):
    out = list(words)
    for k in rng.sample(range(len(out)), n):
        out[k] = f"edit{rng.randrange(10**9)}"
    return out


def test_pipeline_drops_all_near_copies(spark):
    rng = random.Random(9)
    vocabulary = [f"w{k}" for k in range(2000)]
    lines = " ".join(rng.choice(vocabulary) for _ in range(40))
    texts = []
    for n, edits in [(100, (1, 2, 3)), (200, (2, 4)), (300, (2, 6, 8)), (500, (6, 10, 12)), (1000, (14, 22, 25, 40))] * 3:
        words = rng.choices(vocabulary, k=n)
        texts.append(" ".join(words))
        texts += [" ".join(edited(rng, words, e)) for e in edits]
    chain = rng.choices(vocabulary, k=200)  # each a copy of the last, the ends unlike
    for _ in range(8):
        texts.append(" ".join(chain))
        chain = edited(rng, chain, 3)
    texts += [lines + " " + " ".join(rng.choices(vocabulary, k=60)) for _ in range(30)]  # a shared passage, no copies
    texts += ["", None, " \t", "one two", "One  two", "one two three four five", "one two three four six", "A " + texts[0], texts[4].upper()]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    docs = spark.createDataFrame([(k, t, "en", "s", 0) for k, t in rows], KIND).repartition(3)
    want = sorted(set(brute(rows)))
    assert sorted(r.doc_id for r in corpus_pipeline.near_copies(spark, docs, "").collect()) == want
    assert len(want) < len(rows) - 30


def test_ids_and_empty_tables(spark):
    rows = [(None, "no id but kept all the same as it is", "en", "s", 0), (1, "a b c d e f", "en", "s", 0), (None, "A b c d e f", "en", "s", 0), (1, "quite another text with this id here", "en", "s", 0)]
    docs = spark.createDataFrame(rows, KIND)
    assert sorted(r.text for r in similar.keep_one(docs).collect()) == sorted(rows[k][1] for k in (0, 1, 3))
    assert similar.keep_one(docs.where(F.lit(False))).count() == 0


def test_texts_that_only_share_a_passage_are_not_paired(spark, monkeypatch):
    """120 texts of a passage and a few words of their own each: 7,140 pairs, below the similarity."""
    rng = random.Random(3)
    passage = " ".join(f"p{k}" for k in range(50))
    texts = [passage + " " + " ".join(f"own{rng.randrange(10**9)}" for _ in range(rng.randint(7, 12))) for _ in range(120)]
    texts += [texts[0] + " end", "first " + texts[1]]
    docs = spark.createDataFrame([(k, t, "en", "s", 0) for k, t in enumerate(texts)], KIND).repartition(3)
    met, verified = [], similar.verified
    monkeypatch.setattr(similar, "verified", lambda pairs, *a: met.append(pairs.count()) or verified(pairs, *a))
    assert similar.keep_one(docs).count() == 120
    assert sum(met) < 300


def test_one_task_and_star_rounds_unite_alike(spark):
    rng = random.Random(5)
    rows = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(k, k + 1) for k in range(1000, 1060)] + [(-5, 7), (3, 3)]
    edges = spark.createDataFrame(rows, "a long, b long").repartition(3)
    rounds, at_once = (sorted(map(tuple, common.components(edges, few).collect())) for few in (0, 10_000))
    assert rounds == at_once and len(at_once) > 100
    assert common.components(edges.where("false"), 10).count() == 0


def test_texts_with_one_set_are_one_node(spark):
    """Many texts that differ in case or in repeats of their shingles only, and repeated rows."""
    texts = [("Alpha beta gamma delta epsilon zeta " * k).title() if k % 2 else "alpha beta gamma delta epsilon zeta " * k for k in (2, 3, 4, 5)] * 3
    docs = spark.createDataFrame([(k % 7, t, "en", "s", 0) for k, t in enumerate(texts)], KIND).repartition(3)
    assert [r.doc_id for r in similar.keep_one(docs).collect()] == [0]


def test_places_lose_no_pair():
    """Of random sets that are similar, the first shared element's places allow it."""
    from pyspark.sql import SparkSession

    rng, rows = random.Random(7), []
    for _ in range(3000):
        n, swap = rng.randint(1, 60), rng.randint(0, 8)
        a = sorted(rng.sample(range(1000), n))
        b = sorted((set(a) - set(rng.sample(a, min(n, swap)))) | set(rng.sample(range(1000), rng.randint(0, 6)))) or [0]
        x, y = set(a), set(b)
        if len(x & y) >= 0.8 * len(x | y) - 1e-9:
            first = min(x & y)
            rows.append((len(a), a.index(first), len(b), b.index(first)))
            assert a.index(first) <= len(a) - similar.shared_least(len(a), 0.8) and b.index(first) <= len(b) - similar.shared_least(len(b), 0.8)
    frame = SparkSession.getActiveSession().createDataFrame(rows, "n long, i long, m long, j long")
    assert frame.where(~similar.go_together(*map(F.col, "nimj"), 0.8)).count() == 0 and len(rows) > 300


def test_stored_tables_and_shuffles_go(spark, monkeypatch):
    """Only the rows' own table stays of those that near_dedup stores, and no shuffle files of its queries; classes that meet
    no other by size and place are not moved on with their counts."""
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(3000)]
    passage = rng.choices(vocabulary, k=12)
    texts = [" ".join(passage + rng.choices(vocabulary, k=n)) for n in range(60, 3000, 60)]  # one of a size
    texts += [" ".join(edited(rng, texts[0].split(), 3)), " ".join(rng.choices(vocabulary, k=80))]
    docs = spark.createDataFrame([(k, t, "en", "s", 0) for k, t in enumerate(texts)], KIND).repartition(3)
    kept, rows, stored_at = [], {}, similar.stored_at

    def seen(df, name):
        out, path = stored_at(df, name)
        rows[name] = out.count()
        kept.append(path)
        return out, path

    monkeypatch.setattr(similar, "stored_at", seen)
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffles = lambda: {f.name for d in manager.localDirsString() for f in Path(d).rglob("shuffle_*.data")}
    gc.disable()  # as long as nothing is collected
    try:
        before = shuffles()
        out = similar.keep_one(docs)
        assert not shuffles() - before
    finally:
        gc.enable()
    assert kept and not [p for p in kept if Path(p.removeprefix("file://")).exists()]
    assert rows["left"] < rows["mixed"]
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    assert out.count() == len(set(brute(list(enumerate(texts)))))
