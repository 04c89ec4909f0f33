"""A small, awkward table of documents that the operators' tests share."""

import random

import pytest

KIND = "doc_id long, text string, lang string, source string, n_chars long, kept string, row string, digest string, `my col` double"
EN, DE = ["the", "ing", "ha", "on", "wh"], ["ung", "sch", "ß", "ver", "ich"]


def prose(rng, n, stems):
    return " ".join(rng.choice(stems) + rng.choice(stems) for _ in range(n))


@pytest.fixture(scope="session")
def rows():
    rng = random.Random(3)
    out = [(k, prose(rng, rng.randint(1, 60), EN if k % 3 else DE), "en" if k % 3 else "de", f"s{k % 4}") for k in range(120)]
    out += [(200, None, None, None), (201, "", "en", "s1"), (202, " \t\n ", "de", None), (203, "x", "en", "s1"), (204, "12 34 !?", "en", "s0")]
    out += [(210, out[5][1], "en", "s2"), (211, out[5][1].upper(), "en", "s2"), (212, out[7][1] + " end", "en", "s3")]
    out += [(220, prose(rng, 60_000, EN), "en", "s0"), (221, "a" * 70_000, "en", "s1"), (222, "Ünïcode naïve  two\n\nlines \n", "de", "s1")]
    out += [(k, "*** %%% ### *** %%% @@ ##", "en", "s0") for k in range(230, 240)]
    out += [(250, "a <|endoftext|> b", "en", "s1"), (251, "<|startoftext|>x <|ENDOFTEXT|>", "en", "s1")]
    return out + [(None, "no id here", "en", "s1"), (None, "nor here", "en", "s1"), (203, "x", "en", "s1"), (203, "y", "en", "s1")]


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame([(*r, 0, "clash", "clash", "clash", 0.5) for r in rows], KIND).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], KIND)
