"""The memo of chunks: what it sends to the library, what it keeps, and columns as Spark hands them over."""

import random

import numpy as np
import pyarrow as pa
import pytest

from annoframe.llm.tokens import LONGEST, ChunkMemo, tokenizer_path

KINDS = [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)]


def library(name, texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path(name))
    return [t.encode(x or "", add_special_tokens=False).ids for x in texts]


class Counted:
    """A tokenizer that counts the characters it is given."""

    def __init__(self, own):
        self.own, self.n = own, 0

    def encode_batch_fast(self, texts, **kw):
        self.n += sum(map(len, texts))
        return self.own.encode_batch_fast(texts, **kw)


@pytest.mark.parametrize(("name", "space"), KINDS)
def test_a_word_is_encoded_once_whatever_mark_follows(name, space):
    words = [f"wo{k:c}rd{'x' * (k % 5)}" for k in range(97, 123)]
    texts = [" ".join(w + end for w in words for end in ("", ".", ",", "!", "?", ";", ":", ")", ".)")) for _ in range(3)]
    memo = ChunkMemo(tokenizer_path(name), space, 10_000)
    memo.tokenizer = Counted(memo.tokenizer)
    assert [np.frombuffer(x, "<u4").tolist() for x in memo.encode(texts)] == library(name, texts)
    assert memo.tokenizer.n < 1.5 * (sum(map(len, words)) + len(words) + 30)  # was nine times the words


@pytest.mark.parametrize(("name", "space"), KINDS)
@pytest.mark.parametrize("capacity", [0, 40, 10_000])
def test_columns_with_nulls_slices_and_a_full_memo(name, space, capacity):
    rng, memo = random.Random(7), ChunkMemo(tokenizer_path(name), space, capacity)
    parts = ["a", "The", ".", ",", "'s", " ", " ", " ", "\n", "\t", "\r\n", " ", "\x85", "　", "é", "́", "̸", "=", "<", "12", "日本", "“", "<|endoftext|>"]
    texts = [None, "", " ", "\n", "a\t\n", "a\n b", "\n a", " a", "a "] + [rng.choice([None, "".join(rng.choices(parts, k=rng.randint(0, 15)))]) for _ in range(1500)]
    for column in (pa.array(texts, pa.string()), pa.array(["first", *texts], pa.string())[1:]):
        for _ in range(2):
            ids, n = memo.encoded(column)
            assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == library(name, texts)
    assert len(memo.known) <= capacity
    for none in ([], [None], ["", None]):
        ids, n = memo.encoded(pa.array(none, pa.string()))
        assert len(ids) == 0 and n.tolist() == [0] * len(none)


@pytest.mark.parametrize(("name", "space"), KINDS)
def test_long_chunks_are_not_remembered(name, space):
    memo, texts = ChunkMemo(tokenizer_path(name), space, 10_000), ["short " + "ab" * LONGEST, "  two runs  " + "x y  " * LONGEST]
    assert [np.frombuffer(x, "<u4").tolist() for x in memo.encode(texts)] == library(name, texts)
    assert memo.known and max(map(len, memo.known)) <= LONGEST
