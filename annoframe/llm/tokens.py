"""Whole-text tokenizing inside tasks with a bounded memo of chunks.

A public tokenizer spends most of its time on text pieces it has already seen.  Both tokenizers used here split texts before
anything else, so a text can be cut before single spaces and line ends, and where ASCII punctuation follows an ASCII letter or
digit; each chunk is encoded once per worker, and the ids joined again.  The chunks of many texts are found at once as
bytes in Arrow's buffer, told apart by a dictionary, and only the different ones are looked up in the memo; ids are then put
together by their places.  Texts with runs of white space (where the byte-level tokenizer merges the white space itself)
and texts that hold one of the tokenizer's added tokens are a chunk of their own, so all ids are those that the library gives.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SEPARATOR, ALNUM, MARK, WHITE, WIDE_WHITE = 1, 2, 3, 4, 5
#: Kinds of bytes; WIDE_WHITE may begin white space that is not ASCII.
KINDS = np.zeros(256, np.uint8)
KINDS[[b for b in range(128) if chr(b).isspace()]] = WHITE
KINDS[[10, 32]] = SEPARATOR
KINDS[[b for b in range(33, 127)]] = MARK
KINDS[[b for b in range(128) if chr(b).isalnum()]] = ALNUM
KINDS[list({chr(c).encode()[0] for c in range(128, 0x3001) if chr(c).isspace()})] = WIDE_WHITE
LONGEST = 1000  # bytes of a chunk that is remembered
TEXTS, BYTES = 4000, 8 << 20  # that are encoded together

_MEMO: dict[str, "ChunkMemo"] = {}


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def memo(path: str, keeps_space: bool, capacity: int = 1_000_000) -> "ChunkMemo":
    """The worker's memo for a tokenizer file; Python workers serve many tasks and keep it."""
    if path not in _MEMO:
        _MEMO[path] = ChunkMemo(path, keeps_space, capacity)
    return _MEMO[path]


def forget() -> None:
    """Let a worker's memos go, and memory that Arrow keeps; called by stages without tokenizers that share its workers with one
    that has them."""
    if _MEMO:
        _MEMO.clear()
        pa.default_memory_pool().release_unused()


class ChunkMemo:
    """keeps_space: the tokenizer keeps a space as part of the next word (byte-level BPE)."""

    def __init__(self, path: str, keeps_space: bool, capacity: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.first = {c.encode()[0] for t in self.added for c in (t[:1], t[:1].upper())}
        self.keeps_space, self.capacity = keeps_space, capacity
        self.known: dict[bytes, bytes] = {}
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.sizes = np.zeros(max(vocab.values()) + 1, np.int64)  # bytes of text that an id stands for
        for token, k in vocab.items():
            self.sizes[k] = len(token.removesuffix("</w>"))

    def bulk(self, chunks: list[str]) -> list[bytes]:
        """Ids of chunks that follow each other in one long text, cut where the ids' bytes add up to a chunk's.
        The direct way where they never do (a normaliser that changes lengths)."""
        if self.keeps_space:
            text, sizes = "".join(chunks), [len(c.encode()) for c in chunks]
        else:
            text, sizes = " ".join(chunks), [len(c.lower().encode()) for c in chunks]
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        ends, at = np.cumsum(sizes), np.cumsum(self.sizes[ids])
        cut = np.searchsorted(at, ends)
        if not len(ids) or at[-1] != ends[-1] or (at[cut] != ends).any():
            return self.direct(chunks)
        cut, raw = (4 * (cut + 1)).tolist(), ids.tobytes()
        return [raw[a:b] for a, b in zip([0, *cut], cut)]

    def direct(self, texts: list[str]) -> list[bytes]:
        out = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in out]

    def whole(self, raw: np.ndarray, kinds: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Texts that are not cut: those with an added token and, of a tokenizer that keeps spaces, those that begin with white space
        but a single space or line end, that end with either, or where either stands beside other white space that it merges with."""
        out = np.zeros(len(at) - 1, bool)
        for k in np.unique(np.searchsorted(at, np.flatnonzero(np.logical_or.reduce([raw == b for b in self.first])), "right") - 1).tolist():
            low = raw[at[k] : at[k + 1]].tobytes().decode().lower()
            out[k] = any(t in low for t in self.added)
        if not self.keeps_space:
            return out
        some = np.flatnonzero(np.diff(at))
        after = kinds == SEPARATOR
        out[some[after[at[some + 1] - 1]]] = True
        after[1:] = after[:-1]  # bytes after a separator or at a text's start
        after[at[some]] = True
        seen = np.flatnonzero(after & (kinds != ALNUM) & (kinds != MARK) & (kinds != 0))
        seen = seen[~np.isin(seen, at[some]) | (kinds[seen] != SEPARATOR)]  # a text may begin with one
        padded = np.concatenate((raw, np.zeros(4, np.uint8)))
        one, two, three = padded[seen], padded[seen + 1], padded[seen + 2]
        wide = (one == 0xC2) & ((two == 0x85) | (two == 0xA0)) | (one == 0xE1) & (two == 0x9A) & (three == 0x80) | (one == 0xE3) & (two == 0x80) & (three == 0x80)
        wide |= (one == 0xE2) & ((two == 0x80) & ((three <= 0x8A) | (three == 0xA8) | (three == 0xA9) | (three == 0xAF)) | (two == 0x81) & (three == 0x9F))
        # a line end and a space are apart where plain ASCII stands before them
        apart = (one == 32) & (padded[seen - 1] == 10) & (seen > 1) & np.isin(kinds[seen - 2], (ALNUM, MARK))
        out[np.searchsorted(at, seen[np.where(kinds[seen] == WIDE_WHITE, wide, ~apart)], "right") - 1] = True
        return out

    def encoded(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids (unsigned 32-bit) of all texts, one after the other, and how many each has; null is empty."""
        flat = pc.fill_null(pc.cast(texts, pa.large_binary()), b"")
        if not len(flat) or not flat.buffers()[2]:
            return np.zeros(0, "<u4"), np.zeros(len(flat), np.int64)
        at = np.frombuffer(flat.buffers()[1], np.int64)[flat.offset : flat.offset + len(flat) + 1]
        raw, at = np.frombuffer(flat.buffers()[2], np.uint8)[at[0] : at[-1]], at - at[0]
        if not len(raw):
            return np.zeros(0, "<u4"), np.zeros(len(flat), np.int64)
        kinds = np.frombuffer(raw.tobytes().translate(KINDS.tobytes()), np.uint8)
        whole = self.whole(raw, kinds, at)
        cut = kinds == SEPARATOR
        cut[1:] |= (kinds[1:] == MARK) & (kinds[:-1] == ALNUM)
        for k in np.flatnonzero(whole):
            cut[at[k] : at[k + 1]] = False
        cut[at[:-1][np.diff(at) > 0]] = True
        places = np.flatnonzero(cut)
        bounds = np.searchsorted(places, at)  # of texts in chunks
        ends = np.append(places, len(raw)).astype(np.int32)
        chunks = pa.Array.from_buffers(pa.binary(), len(places), [None, pa.py_buffer(ends), pa.py_buffer(raw)]).dictionary_encode()
        code = chunks.indices.to_numpy()
        found = self.looked_up(chunks.dictionary.to_numpy(zero_copy_only=False).tolist(), set(code[bounds[:-1][whole & (np.diff(at) > 0)]].tolist()))
        # ids of the different chunks lie one after the other; each chunk's are taken from their place
        kind = np.int32 if len(raw) < 1 << 29 else np.int64
        sizes = np.fromiter(map(len, found), kind, len(found)) // 4
        first = np.cumsum(sizes, dtype=kind) - sizes
        n = sizes[code]
        ends = np.cumsum(n, dtype=kind)
        taken = np.repeat(first[code] - (ends - n), n)
        taken += np.arange(len(taken), dtype=kind)
        return np.frombuffer(b"".join(found), "<u4")[taken], np.diff(np.concatenate(([0], ends))[bounds]).astype(np.int64)

    def looked_up(self, chunks: list[bytes], whole: set[int]) -> list[bytes]:
        """Little-endian ids of different chunks; `whole` are the places of whole texts among them."""
        found = list(map(self.known.get, chunks))
        new = [k for k, x in enumerate(found) if x is None]
        alone, rest, texts = [], [], []
        for k in new:
            c = chunks[k].decode()
            if k in whole or c.isspace():
                alone.append((k, c))
                continue
            if self.keeps_space:
                texts += [c] if c[0] in " \n" else ["\n", c]  # a line end never joins what follows
            else:
                texts.append(c[1:] if c[0] in " \n" else c)
            rest.append((k, len(texts) - 1))
        got: list[bytes] = []
        for a in range(0, len(texts), 4000):
            part = texts[a : a + 4000]
            lone = a and self.keeps_space and part[0][0] not in " \n"  # its line end is in the part before
            got += self.bulk(["\n", *part])[1:] if lone else self.bulk(part)
        for k, place in rest:
            found[k] = got[place]
        for (k, _), ids in zip(alone, self.direct([c for _, c in alone])):
            found[k] = ids
        room = self.capacity - len(self.known)
        self.known.update((chunks[k], found[k]) for k in new[: max(0, room)] if len(chunks[k]) <= LONGEST)
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        ids, n = self.encoded(pa.array(texts, pa.large_string()))
        raw, ends = ids.tobytes(), (4 * np.cumsum(n)).tolist()
        return [raw[a:b] for a, b in zip([0, *ends], ends)]
