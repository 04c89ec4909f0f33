"""Source mixing and the digest index against plain loops."""

import hashlib
import math
import random
import shutil
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from annoframe.llm import digest_index, mixing
from annoframe.llm.hashing import LOWER


def words(text):
    return (text or "").encode().translate(LOWER).split()


def water(sizes):
    w = {k: (5, 2, 1)[i % 3] for i, k in enumerate(sorted(sizes, key=lambda x: (x is None, x or "")))}
    left, out, free = 1.5 * sum(sizes.values()), {}, set(sizes)
    while free:
        total = sum(w[k] for k in free)
        over = [k for k in free if left * w[k] / total > 2 * sizes[k]]
        if not over:
            return out | {k: left * w[k] / total for k in free}
        for k in over:
            out[k] = 2.0 * sizes[k]
            free.discard(k)
        left = 1.5 * sum(sizes.values()) - sum(out.values())
    return out


def test_mixing(docs, empty, rows):
    sizes = Counter()
    for _, text, _, source in rows:
        sizes[source] += len(words(text))
    goal = water(sizes)
    got = mixing.mixed_counts(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, goal[r.source]) and 0 <= r.copies <= 2
    again = mixing.mixed_counts(docs.repartition(5)).collect()
    assert Counter((r.doc_id, r.copies) for r in got) == Counter((r.doc_id, r.copies) for r in again)
    # the sum of expected copies in order, and one copy for each whole number that it crosses
    order = lambda r: (math.floor(math.log2(r[2] + 1) * 64), int(hashlib.md5(str(r[0] if r[0] is not None else r[1] or "").encode()).hexdigest()[:2], 16), r[2], r[0] is None, r[0] or 0)
    want = Counter()
    for source in sizes:
        rate = goal[source] / sizes[source] if sizes[source] else 0.0
        own = sorted(((d, t, len(words(t))) for d, t, _, s in rows if s == source), key=order)
        draws = []
        for k in range(mixing.OFFSETS):  # the offset whose words come nearest
            at = start = int(hashlib.md5(f"5|{k}|{source or ''}".encode()).hexdigest()[:8], 16) / 2**32
            drawn = []
            for n, (doc_id, _, size) in enumerate(own, 1):
                drawn.append((doc_id, size, math.floor(start + n * rate) - math.floor(at)))
                at = start + n * rate
            draws.append((abs(sum(c * s for _, s, c in drawn) - goal[source]), k, drawn))
        want.update(min(draws)[2])
    assert Counter((r.doc_id, r.size, r.copies) for r in got) == want
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in got)
    copies = Counter()
    for r in got:
        copies[r.doc_id, r.h] += r.copies
    found = Counter((r.doc_id, r.h) for r in mixed.select("doc_id", F.xxhash64("text").alias("h")).collect())
    assert found == Counter({k: n for k, n in copies.items() if n})
    assert mixing.mix(empty).count() == 0


def test_words_come_near_their_targets(spark):
    """Sources of a few dozen documents, some with one very long text of up to a fifth of their words."""
    rng = random.Random(3)
    rows = [(k, "w " * min(4000, int(rng.paretovariate(0.9) * 20)), f"s{k % 12}") for k in range(900)]
    found = defaultdict(lambda: [0, 0.0, 0])
    for r in mixing.mixed_counts(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect():
        own = found[r.source]
        own[0], own[1], own[2] = own[0] + r.copies * r.size, r.target, max(own[2], r.size)
    for taken, target, longest in found.values():
        assert abs(taken - target) <= max(0.03 * target, 0.3 * longest), (taken, target, longest)


def norm(text):
    return hashlib.sha256((text or "").encode().translate(LOWER)).hexdigest()


def groups(rows):
    keep, size = {}, Counter()
    for doc_id, text, *_ in rows:
        keep[norm(text)] = max(keep.get(norm(text), -1), -1 if doc_id is None else doc_id)
        size[norm(text)] += 1
    return keep, size


@pytest.mark.parametrize("batches", [1, 2, 5])
def test_all_batches_make_one_answer(docs, empty, rows, batches):
    keep, size = groups(rows)
    got = Counter((r.digest, -1 if r.keep_id is None else r.keep_id, r.group_size) for r in digest_index.resolved(docs, batches).collect())
    assert got == Counter((norm(t), keep[norm(t)], size[norm(t)]) for _, t, *_ in rows)
    assert digest_index.resolved(empty, batches).count() == 0


def test_reopened_index(spark, docs, tmp_path):
    path, tables = f"file://{tmp_path}/index", spark.catalog.listTables()
    frame = lambda *r: digest_index.digested(spark.createDataFrame(list(r), "doc_id long, text string"))
    first = digest_index.DigestIndex(spark, path, buckets=4)
    assert first.add(frame((1, "same text"), (2, "other")), 1).count() == 2
    first.close()
    with pytest.raises(ValueError):
        digest_index.DigestIndex(spark, path, buckets=8)
    later = digest_index.DigestIndex(spark, path)
    assert later.buckets == 4
    fresh = later.add(frame((9, "Same Text"), (None, "third"), (0, "OTHER")), 2)
    assert [r.keep_id for r in fresh.collect()] == [None]
    got = {(r.doc_id, r.keep_id, r.group_size) for r in later.resolve(frame((1, "same text"), (9, "Same Text"), (0, "OTHER"), (None, "third"))).collect()}
    assert got == {(1, 9, 2), (9, 9, 2), (0, 2, 2), (None, None, 1)}
    plan = later.spark.table(later.table).select("digest").hint("merge")
    text = frame((5, "x")).join(plan, "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text and "Bucketed: true" in text  # only the batch is moved
    later.close()
    assert spark.catalog.listTables() == tables


def test_a_batch_counts_once(spark, tmp_path):
    frame = lambda *r: digest_index.digested(spark.createDataFrame(list(r), "doc_id long, text string"))
    one, two = frame((1, "a"), (2, "b"), (4, "A")), frame((3, "a"), (7, "c"), (0, "B"))
    index = digest_index.DigestIndex(spark, f"file://{tmp_path}/index", buckets=3)
    told = lambda: {(r.digest, r.keep_id, r.group_size) for r in index.rows().collect()}
    index.add(one, 1)
    index.add(two, 2)
    want = {(norm("a"), 4, 3), (norm("b"), 2, 2), (norm("c"), 7, 1)}
    assert told() == want
    for batch, again in ((1, one), (2, two), (2, two)):
        assert index.add(again, batch).count() == (2 if batch == 1 else 1)
        assert told() == want
    for name in ("rows", "changes"):  # broken off between the two writes
        shutil.rmtree(tmp_path / "index" / name / "batch=2")
        index.spark.sql(f"REFRESH TABLE {index.table}")
        index.add(two, 2)
        assert told() == want
    assert spark.table(index.table).count() == 3  # one row for each digest, whatever came later
    index.close()


def test_keep_one(spark, docs, empty, rows):
    keep, _ = groups(rows)
    kept = digest_index.keep_one(docs)
    assert kept.columns == docs.columns
    assert Counter((norm(r.text), -1 if r.doc_id is None else r.doc_id) for r in kept.collect()) == Counter(keep.items())
    assert digest_index.keep_one(empty).count() == 0
    index = digest_index.DigestIndex(spark)
    first = digest_index.keep_one(docs.where("doc_id < 100"), index, 0).count()
    assert first + digest_index.keep_one(docs.where("doc_id is null or doc_id >= 100"), index, 1).count() == len(keep)
    assert digest_index.keep_one(docs, index, 2).count() == 0
