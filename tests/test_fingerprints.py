"""Fingerprints of tokens with characters that Python's repr escapes."""

import hashlib

from pyspark.sql import functions as F

from annoframe.operators import layers


def test_unprintable_characters_are_escaped(spark):
    odd = ["a\tb", "10\u00a0000", "\u200b", "\x00", "\x7f", "\u00ad", "\r\n", "it's\t", "it's\t\"", "\\\t", "\U000e0001x", "\U0001f600", "\ue000", "\u0378", "\u4e2d", "õ", "\u2028"]
    cases = [odd, *[[x] for x in odd]]
    rows = spark.createDataFrame([(k, w) for k, w in enumerate(cases)], "k int, w array<string>")
    for r in rows.select("k", layers.python_list(F.col("w")).alias("p"), layers.fingerprint(F.col("w")).alias("f")).collect():
        assert r.p == str(cases[r.k])
        assert r.f == hashlib.sha256(str(cases[r.k]).encode()).hexdigest()
