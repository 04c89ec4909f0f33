"""Operator 13, SentencePiece encoding and decoding: a score-ordered agenda of adjacent symbol pairs.

A text's characters are symbols in a chain.  The agenda holds every adjacent pair whose joint spelling is a piece, best
score first and leftmost among equals.  The best pair still standing is merged, which puts up to two new pairs on the
agenda, until none is left.  What remains are pieces; a character that is none goes out as its UTF-8 bytes.

In a vocabulary whose pieces have the space mark at their start only, no merge crosses a mark that follows something else,
nor a character that is in no longer piece (the line end).  A text is cut there into chunks, and each worker remembers
the ids of short ones, a bounded number of them.  The short chunks that an Arrow batch brings anew are solved together: each has a
row of pairs as its agenda, and every round merges the best pair of each; for long ones the agenda is a heap.  Every chunk
that a worker solves is checked against the sentencepiece library, a thousand in one call; a difference is an error.
Decoding is the library's own.

Edge cases: null text is empty and has no ids.  Characters, byte pieces and names of control pieces in a text are plain
text, as for the library.  Long chunks without spaces are solved by the same agenda, in time n log n, and not remembered.
Repeated rows and rows without id are encoded each.  Other columns are not read.  Models that the agenda does not cover
(other than merge-type, other normalisation, no byte pieces) are refused.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import arrow_schema
from .hashing import runs
from .tokens import tokenizer_path

MODEL = "piece_bpe_32k.model"
MARK = "▁"
REMEMBERED, SHORT = 1_000_000, 48  # chunks that a worker remembers, and their length in characters at most
NONE = np.iinfo(np.int32).max  # place of a pair that makes no piece
PROBE = "  a b\t c　ﬁé \n"
_WORKER: dict[str, "Pieces"] = {}


def worker_pieces(path: str) -> "Pieces":
    """The worker's own vocabulary and memo; Python workers serve many tasks and keep it."""
    if path not in _WORKER:
        _WORKER[path] = Pieces(path)
    return _WORKER[path]


class Known(dict):
    """Ids by chunk, as bytes.  A chunk that it lacks is noted in `new` and gets a place to be filled."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, chunk: str) -> bytearray:
        place = self[chunk] = bytearray()
        self.new.append(chunk)
        return place


class Pieces:
    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.library = lib = SentencePieceProcessor(model_file=path)
        ids = range(lib.get_piece_size())
        plain = [k for k in ids if not (lib.is_control(k) or lib.is_byte(k) or lib.is_unknown(k))]
        self.ids = {lib.id_to_piece(k): k for k in plain}
        self.scores = {lib.id_to_piece(k): lib.get_score(k) for k in plain}
        self.bytes = [lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if not all(map(lib.is_byte, self.bytes)) or any(map(lib.is_unused, ids)) or lib.normalize(PROBE) != self.normal(PROBE):
            raise ValueError("the agenda covers merge-type models with byte pieces, a leading mark and no other normalisation")
        longer = [p for p in self.ids if len(p) > 1]
        self.cuts = not any(re.search(f"[^{MARK}]{MARK}", p) for p in longer) and not any("\n" in p for p in longer)
        self.chunks = re.compile(f"\n|{MARK}*[^{MARK}\n]+|{MARK}+" if self.cuts else r"(?s).+").findall
        self.line = lib.encode("\n")[1:] if self.cuts else []  # of a line end; the mark before it is another
        self.known = Known()
        # for agendas of many chunks at once: ids of characters, and for each two ids that make a piece its place by score and its id
        self.of_char = np.full(0x110000, -1, np.int32)
        for p, k in self.ids.items():
            if len(p) == 1:
                self.of_char[ord(p)] = k
        place = {x: k for k, x in enumerate(sorted({self.scores[p] for p in longer}, reverse=True))}
        pairs = sorted((self.ids[p[:k]] << 32 | self.ids[p[k:]], place[self.scores[p]], self.ids[p]) for p in longer for k in range(1, len(p)) if p[:k] in self.ids and p[k:] in self.ids)
        self.pairs, self.places, self.joined = (np.array(x, t) for x, t in zip(zip(*pairs), (np.int64, np.int32, np.int32)))

    @staticmethod
    def normal(text: str) -> str:
        return MARK + text.replace(" ", MARK) if text else ""

    def merged(self, chunk: str) -> list[int]:
        """Ids of one chunk; its agenda is a heap."""
        symbols, scores = list(chunk), self.scores
        n = len(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda = []
        for k in range(n - 1):
            score = scores.get(symbols[k] + symbols[k + 1])
            if score is not None:
                agenda.append((-score, k, k + 1, 2))
        heapq.heapify(agenda)
        while agenda:
            _, a, b, size = heapq.heappop(agenda)
            if not symbols[a] or not symbols[b] or len(symbols[a]) + len(symbols[b]) != size:
                continue  # one of the two has been merged since
            symbols[a] += symbols[b]
            symbols[b] = ""
            c, z = after[b], before[a]
            after[a] = c
            if c < n:
                before[c] = a
                score = scores.get(symbols[a] + symbols[c])
                if score is not None:
                    heapq.heappush(agenda, (-score, a, c, size + len(symbols[c])))
            if z >= 0:
                score = scores.get(symbols[z] + symbols[a])
                if score is not None:
                    heapq.heappush(agenda, (-score, z, a, size + len(symbols[z])))
        out = []
        for s in symbols:
            if s:
                own = self.ids.get(s)
                out += [self.bytes[b] for b in s.encode()] if own is None else [own]
        return out

    def looked_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place by score (NONE if they make no piece; id -1 is none) and joint id of pairs of ids."""
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        there = (self.pairs[at] == key) & (left >= 0) & (right >= 0)
        return np.where(there, self.places[at], NONE), self.joined[at]

    def merged_together(self, symbols: np.ndarray) -> np.ndarray:
        """symbols: ids of the characters of chunks of one length, a row each.  Each chunk's agenda is a row of places by score;
        in a round every chunk merges its best pair.  The ids that are left, others -1."""
        m, n = symbols.shape
        symbols, row = symbols.copy(), np.arange(m)
        agenda, joint = np.full((m, n), NONE, np.int32), np.zeros((m, n), np.int32)
        if n > 1:
            place, own = self.looked_up(symbols[:, :-1].ravel(), symbols[:, 1:].ravel())
            agenda[:, :-1], joint[:, :-1] = place.reshape(m, n - 1), own.reshape(m, n - 1)
        after = np.broadcast_to(np.arange(1, n + 1), (m, n)).copy()
        before = np.broadcast_to(np.arange(-1, n - 1), (m, n)).copy()
        while len(row):
            a = agenda[row].argmin(1)  # the leftmost of equals
            row, a = (x[agenda[row, a] < NONE] for x in (row, a))
            if not len(row):
                break
            b = after[row, a]
            c, z = after[row, b], before[row, a]
            symbols[row, a] = joint[row, a]
            symbols[row, b], agenda[row, b] = -1, NONE
            after[row, a] = c
            inner = c < n
            before[row[inner], c[inner]] = a[inner]
            right = np.where(inner, symbols[row, np.minimum(c, n - 1)], -1)
            agenda[row, a], joint[row, a] = self.looked_up(symbols[row, a], right)
            r, k, z = row[z >= 0], a[z >= 0], z[z >= 0]
            agenda[r, z], joint[r, z] = self.looked_up(symbols[r, z], symbols[r, k])
        return symbols

    def solved(self, chunks: list[str]) -> list[bytes]:
        """Ids of chunks as bytes: short ones of known characters together, others one by one."""
        out: list[bytes] = [b""] * len(chunks)
        by_length: dict[int, list[int]] = {}
        for k, c in enumerate(chunks):
            by_length.setdefault(len(c) if len(c) <= SHORT else 0, []).append(k)
        alone = by_length.pop(0, [])
        for n, own in by_length.items():
            points = np.frombuffer("".join([chunks[k] for k in own]).encode("utf-32-le"), np.uint32).reshape(-1, n)
            symbols = self.of_char[points]
            plain = (symbols >= 0).all(1)
            alone += [own[k] for k in np.flatnonzero(~plain).tolist()]
            own = [own[k] for k in np.flatnonzero(plain).tolist()]
            left = self.merged_together(symbols[plain])
            ends = 4 * np.cumsum((left >= 0).sum(1))
            raw, at = left[left >= 0].astype("<i4").tobytes(), 0
            for k, end in zip(own, ends.tolist()):
                out[k] = raw[at:end]
                at = end
        for k in alone:
            out[k] = np.array(self.merged(chunks[k]), "<i4").tobytes()
        return out

    def check(self, chunks: list[str], found: list[bytes]) -> None:
        """Compare with the library: chunks in one text, each between line ends, where a model's chunks can be cut so."""
        if self.cuts:
            line = np.array(self.line, "<i4").tobytes()
            said = self.library.encode("\n" + "\n".join(chunks) + "\n")
            if np.array(said[1:], "<i4").tobytes() == line + line.join(found) + line:
                return
        for c, ids in zip(chunks, found):
            own = np.frombuffer(ids, "<i4").tolist()
            if not self.cuts or c[0] == MARK:
                said = self.library.encode(c[1:] + ("\n" if self.cuts else ""))
            else:
                said = self.library.encode("\n" + c + "\n")[1 + len(self.line) :]
            if own != said[: len(said) - len(self.line)]:
                raise ValueError(f"the agenda differs from the library on {c[:80]!r}")

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        find = self.known.__getitem__
        places = [list(map(find, self.chunks(self.normal(t)))) for t in texts]  # one look at each chunk; new ones are filled below
        known, new = self.known, self.known.new
        try:
            found = self.solved(new)
            for a in range(0, len(new), 1000):
                self.check(new[a : a + 1000], found[a : a + 1000])
        except BaseException:
            self.known = Known()  # no place may stay unfilled
            raise
        for c, ids in zip(new, found):
            known[c] += ids
        out = [np.frombuffer(b"".join(p), "<i4") for p in places]
        if len(known) > REMEMBERED:
            self.known = Known()
        else:
            for c in new:
                if len(c) > SHORT:
                    del known[c]
            known.new = []
        return out


def encoded(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id, ids (array), decoded (the text that the library reads off the ids) of every row."""
    path = tokenizer_path(model)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = worker_pieces(path)
        for batch in batches:
            for a, b in runs(batch.column("text"), 500, 1 << 20):
                ids = own.encode([t or "" for t in batch.column("text")[a:b].to_pylist()])
                decoded = own.library.decode([x.tolist() for x in ids])
                ends = np.cumsum([0, *map(len, ids)])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(ids), pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id")[a:b], lists, pa.array(decoded, pa.string())], names=["doc_id", "ids", "decoded"])

    return docs.select("doc_id", "text").mapInArrow(of, arrow_schema(docs, "doc_id", "ids array<int>, decoded string"))
