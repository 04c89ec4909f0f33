"""Words and sentences of many texts at once, as arrays, for use inside tasks.

Texts of a batch are laid end to end in UTF-8, with a line end after each, and cut at bytes that stand for themselves.
Places are counted in characters: bytes that do not continue one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SPACE, LINE_END, MARKS = 32, 10, (33, 46, 63)  # ! . ?
PARTS = 16  # of a scan's task, which reads up to 128 MB
RUN_BYTES = 1 << 20  # of text laid out at once; a longer text is alone


class Pieces(NamedTuple):
    """Stretches of bytes, in order and without overlap."""

    start: np.ndarray
    end: np.ndarray


def runs(inside: np.ndarray) -> Pieces:
    around = np.zeros(len(inside) + 2, bool)
    around[1:-1] = inside
    edges = np.flatnonzero(around[1:] != around[:-1])
    return Pieces(edges[::2], edges[1::2])


def words(raw: np.ndarray) -> Pieces:
    """Runs between spaces and line ends."""
    return runs((raw != SPACE) & (raw != LINE_END))


def lines(raw: np.ndarray) -> Pieces:
    """Lines that are not empty."""
    return runs(raw != LINE_END)


def sentences(raw: np.ndarray) -> Pieces:
    """Runs without closing marks and line ends, with the marks after them."""
    mark = np.isin(raw, MARKS)
    plain = runs(~mark & (raw != LINE_END))
    no_mark = np.append(np.flatnonzero(~mark), len(raw))
    return Pieces(plain.start, no_mark[np.searchsorted(no_mark, plain.end)])


def laid_out(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """A text column in runs: first row, row after the last, bytes, where each text begins (one more than texts)."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1
    ends, at = np.cumsum(sizes), 0
    while at < len(sizes):
        before = ends[at - 1] if at else 0
        stop = min(max(at + 1, int(np.searchsorted(ends, before + RUN_BYTES, "right"))), len(sizes))
        texts = [x or b"" for x in pc.cast(column[at:stop], pa.large_binary()).to_pylist()]
        raw = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
        yield at, stop, raw, np.concatenate(([0], ends[at:stop] - before))
        at = stop


def found_in(batch: pa.RecordBatch, cut: Callable[[np.ndarray], Pieces]) -> Iterator[tuple]:
    """Of runs of a batch's texts: ids, each piece's text (by number), how many pieces lie before each text, starts, ends, pieces."""
    for a, b, raw, first in laid_out(batch.column("text")):
        found = cut(raw)
        owner = np.searchsorted(first, found.start, "right") - 1
        before = np.searchsorted(found.start, first)
        chars = np.concatenate(([0], np.cumsum(raw & 0xC0 != 0x80)))
        base = chars[first][owner]
        # the pieces' bytes, end to end
        edges = np.zeros(len(raw) + 1, np.int8)
        edges[found.start] += 1
        np.subtract.at(edges, found.end, 1)
        data = raw[np.cumsum(edges[:-1], dtype=np.int8).astype(bool)]
        ends = np.concatenate(([0], np.cumsum(found.end - found.start))).astype(np.int32)
        piece = pa.StringArray.from_buffers(len(owner), pa.py_buffer(ends.tobytes()), pa.py_buffer(data.tobytes()))
        yield batch.column("text_id")[a:b], owner, before, chars[found.start] - base, chars[found.end] - base, piece


def cut_lists(texts: DataFrame, cut: Callable[[np.ndarray], Pieces]) -> DataFrame:
    """text_id, high, low, pieces of every text that has any: its pieces in one text, a line to a piece (no piece holds a line end), and
    where they start: high * 256 + low + 128.  The high parts come in long runs of equal ones, which pack well where lists are
    moved; places as they are don't.  No rows move."""

    def run_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, _, before, start, _, piece in found_in(batch, cut):
                ends, of = pa.array(before.astype(np.int32)), pa.ListArray.from_arrays
                high, low = (start >> 8).astype(np.int32), ((start & 255) - 128).astype(np.int8)
                yield pa.RecordBatch.from_arrays([ids, of(ends, pa.array(high)), of(ends, pa.array(low)), pc.binary_join(of(ends, piece), "\n")], names=["text_id", "high", "low", "pieces"])

    schema = StructType([texts.schema["text_id"], *StructType.fromDDL("high array<int>, low array<tinyint>, pieces string").fields])
    return texts.select("text_id", "text").mapInArrow(run_lists, schema).where("size(low) > 0")


def place(high: Column, low: Column) -> Column:
    """A start that `cut_lists` keeps in two parts."""
    return (high * 256 + low.cast("int") + 128).cast("long")


def cut_texts(texts: DataFrame, cut: Callable[[np.ndarray], Pieces], number: str, name: str, by_text: bool = False) -> DataFrame:
    """text_id, `number` (from 1 in the text), start, end, `name` (the piece) of every text's pieces.  No rows move: a text's
    pieces are numbered and placed where the text is.  Null text has none.

    by_text: texts are dealt to tasks by text_id with their pieces as one list, which is taken apart after that.  Spark knows that a
    text's rows are together then, so groups, joins and windows inside texts move no rows again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, owner, before, start, end, piece in found_in(batch, cut):
                nth = np.arange(len(owner)) - before[owner] + 1
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(owner, pa.int64())), pa.array(nth.astype(np.int32)), pa.array(start), pa.array(end), piece], names=["text_id", number, "start", "end", name])

    own = texts.schema["text_id"]
    if by_text:
        flat = cut_lists(texts, cut).repartition(parts_for(texts), "text_id").select("text_id", "high", "low", F.posexplode(F.split("pieces", "\n")).alias("nth", name))
        start = place(*[F.element_at(c, F.col("nth") + 1) for c in ("high", "low")])
        return flat.select("text_id", (F.col("nth") + 1).alias(number), start.alias("start"), (start + F.length(name)).alias("end"), name)
    schema = StructType([own, *StructType.fromDDL(f"{number} int, start long, end long, {name} string").fields])
    return texts.select("text_id", "text").mapInArrow(run, schema)


def parts_for(texts: DataFrame) -> int:
    """In how many parts texts are dealt by text_id: a task that takes its part's words apart and sorts them shall do so in memory.
    With fewer than spark.sql.shuffle.partitions, Spark's joins would deal the rows anew; so they would on text_id and more keys,
    unless the session lets joins of rows that are dealt by some of their keys alone be, which is set here."""
    texts.sparkSession.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    return max(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), PARTS * texts.rdd.getNumPartitions())


def dealt(texts: DataFrame) -> DataFrame:
    """The same rows, dealt as `cut_texts` deals pieces by text."""
    return texts.repartition(parts_for(texts), "text_id")
