"""Operator 7, mixture-controlled packing: deficit round-robin over source queues.

Every source is a queue of its documents, cut where the tokens that a round gives it end, so that it can always give what it
is owed; a source that a round owes less than `LEAST` tokens is cut where as many rounds' tokens end as make that up.  (With
`piece`, documents are cut into pieces of at most so many tokens instead, and shorter ones stay whole, at the price of windows
off their targets by up to a piece a source.)  In each round every queue, in order of source, gets a quantum, its target share of a window's tokens, on top of
what it was owed; it gives pieces as long as what it is owed covers the next one, and the rest is its deficit, carried into
the next round.  Pieces are laid one after the other and the row of tokens is cut every `window` tokens, so sequences are
full but for the last, and each holds every source's target share up to the deficits: below a token for each source that
a round owes `LEAST`, below so many for others, and below one piece where `piece` is given.  A document is cut at the ends of
its pieces and of sequences only.

As a queue is owed n quanta after n rounds, a piece goes out in the first round n whose n quanta reach the tokens of its
queue up to its end.  So prefix sums give the schedule: any task knows the deficits before its own documents, and no round
is walked through.  Rounds are then laid out by sums per stretch of rounds, and a running sum inside each stretch.

Target weights are given by source, or by default are the sources' own tokens, so that all queues end together.  With
other weights a queue may run dry; the others go on by their weights.  No token is dropped and none repeated.

Tokenized documents are stored once in the shared folder with their place within their task; a queue is in order of task
and place, so the packing depends on how the input is split.  Nothing that grows with the input is in one task but one row
per source, one per task of a source, and one per 4096 stretches of rounds.

Edge cases: null text is empty and has the end id alone; null is a source of its own, last; repeated rows are packed each;
text that spells one of the tokenizer's special tokens gets its id, as the library gives it.  Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_schema, cut, sent_if_small, stored, sums_before
from .hashing import runs
from .tokens import BYTES, TEXTS, forget, memo, tokenizer_path

WINDOW, LEAST = 4096, 32
STRETCH = 64  # rounds laid out by one group
CHUNKS = 1_000_000  # of text that a worker remembers, until a stage without tokenizers lets them go


def tokenized(docs: DataFrame, path: str, end_id: int, wide: int) -> DataFrame:
    """doc_id, source, ids (little-endian, `wide` bytes each, with the end id), n, task, place (tokens of the same source before it in its task)."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, task, so_far = memo(path, keeps_space=False, capacity=CHUNKS), TaskContext.get().partitionId(), {}
        for batch in batches:
            for a, b in runs(batch.column("text"), TEXTS, BYTES):
                part = batch.slice(a, b - a)
                ids, n = words.encoded(part.column("text"))
                raw, n = np.insert(ids, np.cumsum(n), end_id).astype(f"<u{wide}"), n + 1
                ends = pa.array(np.concatenate(([0], wide * np.cumsum(n))), pa.int32())  # an error if too large
                packed = pa.Array.from_buffers(pa.binary(), len(n), [None, ends.buffers()[1], pa.py_buffer(raw)])
                n = n.tolist()
                places = []
                for source, k in zip(part.column("source").to_pylist(), n):
                    places.append(so_far.get(source, 0))
                    so_far[source] = places[-1] + k
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("source"), packed, pa.array(n, pa.int64()), pa.array([task] * len(n), pa.int64()), pa.array(places, pa.int64())], names=["doc_id", "source", "ids", "n", "task", "place"])

    return docs.select("doc_id", "source", "text").mapInArrow(encode, arrow_schema(docs, "doc_id, source", "ids binary, n long, task long, place long"))


def quanta(sums: DataFrame, targets: dict[str | None, float] | None, window: int) -> DataFrame:
    """source, turn (place in a round), quantum.  sums: one row (source, n) per source."""
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    rows = sums.select("source", F.col("n").cast("double").alias("weight"), turn.alias("turn"))
    if targets is not None:
        given = sums.sparkSession.createDataFrame([(k, float(v)) for k, v in targets.items()], "t_source string, weight double")
        known = sums.select("source", turn.alias("turn")).join(given, F.col("source").eqNullSafe(F.col("t_source")), "left")
        unknown = F.raise_error(F.concat(F.lit("no positive target for source "), F.coalesce("source", F.lit("null")))).cast("double")
        rows = known.select("source", "turn", F.when(F.col("weight") > 0, F.col("weight")).otherwise(unknown).alias("weight"))
    return rows.select("source", "turn", (F.lit(float(window)) * F.col("weight") / F.sum("weight").over(Window.partitionBy())).alias("quantum"))


def queued(rows: DataFrame, targets: dict[str | None, float] | None, window: int) -> DataFrame:
    """Adds turn, quantum and first (tokens of its queue before a document)."""
    tasks = cut(rows.groupBy("task", "source").agg(F.sum("n").alias("n")))
    before = Window.partitionBy("source").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = tasks.select("task", "source", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    own = quanta(tasks.groupBy("source").agg(F.sum("n").alias("n")), targets, window)
    bases = bases.join(own.withColumnRenamed("source", "q_source"), F.col("source").eqNullSafe(F.col("q_source")))
    bases = sent_if_small(cut(bases.select(F.col("task").alias("b_task"), F.col("source").alias("b_source"), "base", "turn", "quantum")))
    met = rows.join(bases, (F.col("task") == F.col("b_task")) & F.col("source").eqNullSafe(F.col("b_source")))
    return met.withColumn("first", F.col("base") + F.col("place")).drop("b_task", "b_source", "base", "task", "place")


def pieces(rows: DataFrame, piece: int | None, *columns: Column | str) -> DataFrame:
    """One row per piece of a document: the columns, turn, first (tokens of its queue before it), start, length, round, stretch."""
    if piece:
        starts = F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(piece).cast("long"))
    else:
        step = F.col("quantum") * F.ceil(F.lit(float(LEAST)) / F.col("quantum"))  # of the queue, in whole rounds
        places = F.sequence(F.floor(F.col("first") / step), F.floor((F.col("first") + F.col("n")) / step) + 1)
        ends = F.transform(places, lambda m: F.floor(m * step) - F.col("first"))
        starts = F.concat(F.array(F.lit(0).cast("long")), F.filter(ends, lambda x: (x > 0) & (x < F.col("n"))))
    cut_up = rows.withColumn("starts", starts).select(*columns, "n", "turn", "quantum", "first", "starts", F.posexplode("starts").alias("nth", "start"))
    length = F.coalesce(F.get("starts", F.col("nth") + 1), F.col("n")) - F.col("start")
    cut_up = cut_up.withColumn("length", length).withColumn("first", F.col("first") + F.col("start")).drop("starts", "nth")
    round_ = F.ceil((F.col("first") + F.col("length")) / F.col("quantum"))
    return cut_up.withColumn("round", round_).withColumn("stretch", F.floor(F.col("round") / STRETCH)).drop("quantum")


def pack(docs: DataFrame, targets: dict[str | None, float] | None = None, tokenizer: str = "word_bpe_49k.json", end_id: int = 2, window: int = WINDOW, piece: int | None = None) -> DataFrame:
    """One row per stretch of a document in a sequence: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, source, ids (unsigned 32-bit)."""
    path = tokenizer_path(tokenizer)
    wide = 2 if max(end_id, *memo(path, keeps_space=False, capacity=CHUNKS).tokenizer.get_vocab(with_added_tokens=True).values()) < 1 << 16 else 4
    rows = queued(stored(tokenized(docs, path, end_id, wide), "tokens"), targets, window)
    totals = cut(pieces(rows, piece).groupBy("stretch").agg(F.sum("length").alias("n")))
    bases = sent_if_small(cut(sums_before(totals, "stretch", "n").select("stretch", F.col("before").alias("base"))))
    laid = pieces(rows, piece, "doc_id", "source", "ids")
    laid = laid.withColumn("ids", F.substring("ids", (F.col("start") * wide + 1).cast("int"), (F.col("length") * wide).cast("int"))).join(bases, "stretch")
    earlier = Window.partitionBy("stretch").orderBy("round", "turn", "first").rowsBetween(Window.unboundedPreceding, -1)
    laid = laid.withColumn("at", F.col("base") + F.coalesce(F.sum("length").over(earlier), F.lit(0)))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()  # all texts are encoded
        for batch in batches:
            for a in range(0, len(batch), 2000):
                part = batch.slice(a, 2000)
                at, start = (part.column(c).to_numpy() for c in ("at", "start"))
                raw = part.column("ids").to_pylist()
                length = np.fromiter(map(len, raw), np.int64, len(raw)) // wide
                # a piece is cut where sequences end: into one part more than the ends inside it
                parts = (at + length - 1) // window - at // window + 1
                own = np.repeat(np.arange(len(raw)), parts)
                nth = np.arange(len(own)) - np.repeat(np.cumsum(parts) - parts, parts)
                sequence = at[own] // window + nth
                begin = np.maximum(at[own], sequence * window)
                take = np.minimum((at + length)[own], (sequence + 1) * window) - begin
                ids = np.frombuffer(b"".join(raw), f"<u{wide}").astype("<u4").tobytes()
                ends = np.concatenate(([0], 4 * np.cumsum(take))).tolist()  # pieces and parts follow each other in `ids`
                cut_up = [ids[x:y] for x, y in zip(ends, ends[1:])]
                owner = pa.array(own)
                columns = [start[own] + begin - at[own], take, np.fromiter(map(zlib.crc32, cut_up), np.int64, len(cut_up)), part.column("n").to_numpy()[own], sequence, begin - sequence * window]
                yield pa.RecordBatch.from_arrays([part.column("doc_id").take(owner), *map(pa.array, columns), part.column("source").take(owner), pa.array(cut_up, pa.binary())], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source", "ids"])

    schema = arrow_schema(docs, "doc_id", "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, source string, ids binary")
    return laid.select("doc_id", "source", "ids", "start", "n", "at").mapInArrow(split, schema)
