"""Operator 13 against the library on whole texts."""

import hashlib
import random

import sentencepiece
from pyspark.sql import functions as F

from annoframe.llm import queries, sentencepieces
from annoframe.llm.tokens import tokenizer_path

FOLDER = "/root/testdata/sf0.001"
ODD = ["", " ", "\n", "a", "▁", "▁▁ x", "  two  spaces ", "\n\n x\n", "tab\tand\r\nline", "naïve Ünïcode ﬁ Å", "漢字とかな", "🙂🙂‍🚀", "<s> </s> <unk> <0x41>", "a\x00b", "é̂", "​﻿", "x" * 5000, "ab" * 3000 + " " + "漢" * 2000, " " * 40, "\n" * 50, "1234567890 12.5e-7", "getUserName(foo_bar)", " private"]


def library():
    return sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(sentencepieces.MODEL))


def test_agenda_gives_the_librarys_ids():
    own, lib, rng = sentencepieces.Pieces(tokenizer_path(sentencepieces.MODEL)), library(), random.Random(5)
    letters = "aeiounrstlmd  \n▁.éß漢0🙂-"
    texts = ODD + ["".join(rng.choice(letters) for _ in range(rng.randint(1, 60))) for _ in range(2000)]
    for text, ids in zip(texts, own.encode(texts)):
        assert ids.tolist() == lib.encode(text), text


def test_one_by_one_and_together():
    own, rng = sentencepieces.Pieces(tokenizer_path(sentencepieces.MODEL)), random.Random(7)
    chunks = sorted({"▁" * rng.randint(0, 2) + "".join(rng.choice("aeiounrstlmdhéß0-.") for _ in range(rng.randint(1, 48))) for _ in range(3000)})
    assert [own.merged(c) for c in chunks] == [list(memoryview(x).cast("i")) for x in own.solved(chunks)]


def test_the_memo_is_bounded_and_lets_go(monkeypatch):
    monkeypatch.setattr(sentencepieces, "REMEMBERED", 20)
    own, lib, rng = sentencepieces.Pieces(tokenizer_path(sentencepieces.MODEL)), library(), random.Random(6)
    for _ in range(30):
        texts = [" ".join(rng.choice(["one", "two", "lines", str(rng.randrange(99))]) for _ in range(8)) for _ in range(3)]
        assert [x.tolist() for x in own.encode(texts)] == lib.encode(texts)
        assert len(own.known) <= 20


def test_a_difference_is_an_error():
    own = sentencepieces.Pieces(tokenizer_path(sentencepieces.MODEL))
    own.joined[:] = 5
    try:
        own.encode(["the other"])
    except ValueError as e:
        assert "differs from the library" in str(e)
    else:
        raise AssertionError


def test_rows(spark, docs, rows, empty):
    lib = library()
    want = sorted((str(r[0]), lib.encode(r[1] or ""), lib.decode(lib.encode(r[1] or ""))) for r in rows)
    assert sorted((str(r.doc_id), r.ids, r.decoded) for r in sentencepieces.encoded(docs).collect()) == want
    assert sentencepieces.encoded(empty).count() == 0


def test_query(spark):
    lib, got = library(), {r.doc_id: r for r in queries.QUERIES["op13_sentencepiece_agenda"](spark, FOLDER).collect()}
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect()
    assert len(got) == len(rows)
    for r in rows:
        ids, hashed = lib.encode(r.text), lambda x: hashlib.sha256(x.encode()).hexdigest()
        assert tuple(got[r.doc_id])[1:] == (len(ids), hashed(",".join(map(str, ids))), hashed(lib.decode(ids)))
