"""Vectorised hashes of all tokens of many texts at once, for use inside tasks.

A token's 64-bit hash is a polynomial over its lower-cased (A-Z) bytes, read off prefix sums modulo 2**64, and mixed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BASE = 0x9E3779B97F4A7C15
BLOCK = 1 << 20
SPACES = (9, 10, 11, 12, 13, 32)

LOWER = bytes(b | 32 if 65 <= b <= 90 else b for b in range(256))
#: Classes of bytes: 0 ends a token, and so does a change of class.
WORDS = np.array([0 if b in SPACES else 1 for b in range(256)], np.uint8)
WORDS_AND_MARKS = np.array([0 if b in SPACES else 1 if b >= 128 or chr(b).isalnum() else 2 for b in range(256)], np.uint8)

_POWERS: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, BLOCK + 4096)
        up, down = np.full(size, BASE, np.uint64), np.full(size, pow(BASE, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        _POWERS[:] = [np.cumprod(up), np.cumprod(down)]
    return _POWERS[0], _POWERS[1]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose low bits depend on all bits."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def texts_of(column: pa.Array) -> list[bytes]:
    """A string or binary column as bytes; null is empty."""
    return [x or b"" for x in pc.cast(column, pa.large_binary()).to_pylist()]


def runs(column: pa.Array, rows: int = 400, size: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """A batch's texts in runs of at most `rows` rows and about `size` bytes: first row, row after the last.  A longer text
    is a run of its own."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends, at = np.cumsum(sizes), 0
    while at < len(sizes):
        before = ends[at - 1] if at else 0
        end = min(max(at + 1, int(np.searchsorted(ends, before + size, "right"))), at + rows, len(sizes))
        yield at, end
        at = end


def slices(column: pa.Array, rows: int = 400, size: int = 4 << 20) -> Iterator[tuple[int, int, list[bytes]]]:
    """The same with the texts."""
    for a, b in runs(column, rows, size):
        yield a, b, texts_of(column[a:b])


def segments(text: bytes, size: int = BLOCK) -> Iterator[bytes]:
    """A text in parts of about `size` bytes, cut at a space, so that no token is cut."""
    at = 0
    while len(text) - at > size:
        end = min((p for s in SPACES if (p := text.find(s, at + size)) >= 0), default=len(text))
        yield text[at:end]
        at = end
    yield text[at:]


def blocks(texts: list[bytes], size: int = BLOCK) -> Iterator[tuple[list[int], list[bytes]]]:
    """The texts' segments, in order, in blocks of about `size` bytes: numbers of their texts, segments."""
    owners, parts, total = [], [], 0
    for k, text in enumerate(texts):
        for part in segments(text, size):
            if parts and total + len(part) > size:
                yield owners, parts
                owners, parts, total = [], [], 0
            owners.append(k)
            parts.append(part)
            total += len(part) + 1
    if parts:
        yield owners, parts


def hashed_tokens(texts: list[bytes], kinds: np.ndarray = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all tokens in order; where each text's tokens begin (one number more than texts); the last two bytes
    of each token as a number (its first byte twice if it has one)."""
    hashes, ends2, counts = [], [], np.zeros(len(texts) + 1, np.int64)
    for owners, parts in blocks(texts):
        raw = np.frombuffer(b" ".join(parts).translate(LOWER), np.uint8)
        kind = np.zeros(len(raw) + 2, np.uint8)
        kind[1:-1] = kinds[raw]
        change = kind[1:] != kind[:-1]
        starts = np.flatnonzero(change[:-1] & (kind[1:-1] > 0))
        ends = np.flatnonzero(change[1:] & (kind[1:-1] > 0)) + 1
        up, down = powers(len(raw) + 1)
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)], out=sums[1:])
        hashes.append(mix((sums[ends] - sums[starts]) * down[starts]))
        ends2.append(raw[ends - 1].astype(np.int32) * 256 + raw[np.maximum(ends - 2, starts)] if len(ends) else np.zeros(0, np.int32))
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        first = np.concatenate(([0], np.cumsum(sizes + 1)))
        np.add.at(counts, np.array(owners) + 1, np.diff(np.searchsorted(starts, first)))
    empty = np.zeros(0, np.uint64)
    return np.concatenate([empty, *hashes]), np.cumsum(counts), np.concatenate([np.zeros(0, np.int32), *ends2])
