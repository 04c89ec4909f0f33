"""Operator 4, token-id output: a wavelet matrix per shard.

A shard file holds the ids of consecutive documents, one after the other, as bit-planes: the plane of the highest bit in
order, then each lower plane in the order that a stable partition by the planes above gives (Claude and Navarro 2012).
With the number of ones before each block of a plane, rank takes one look at a block, and select a binary search over
blocks; from these follow access to any id, the count of an id in a stretch, and the place of its k-th occurrence, without
decoding the rest.  Planes are compressed in blocks, so that a look inflates one block.

File: magic, header size, JSON header (bits, ids, block size, offsets of compressed blocks, document starts as a
compressed block), blocks.  Text ids are read once; documents go to shards by ranges of doc_id, so that shards in order
are documents in order.  Shards are cut by their number of ids, whatever the length of texts; one text is never cut.

Edge cases: null text is empty and has the end id alone; rows without doc_id come first; rows that share a doc_id (or have
none) are in order of a hash of their text, which also deals them to tasks; an empty table writes no file; text that spells
one of the tokenizer's special tokens gets its id, as the library gives it.  Other columns are not read.
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_right
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import arrow_schema, cut, shared_dir, stored, sums_before
from .hashing import runs
from .tokens import BYTES, TEXTS, memo, tokenizer_path

MAGIC = b"WAVMAT01"
BLOCK = 1 << 15  # bytes of a plane compressed together
FILES_BITS = 20  # a shard's number is its task's number times 2**20, plus its place among the task's files


class WaveletMatrix:
    """Reader of a shard file's bytes."""

    def __init__(self, raw: bytes, kept: int = 64):
        if raw[:8] != MAGIC:
            raise ValueError("not a wavelet matrix file")
        size = int.from_bytes(raw[8:12], "little")
        head = json.loads(raw[12 : 12 + size])
        self.raw, self.at = raw, 12 + size
        self.n, self.bits, self.block = head["ids"], head["bits"], head["block"]
        self.zeros = head["zeros"]
        self.places = head["places"]  # per plane, ends of its compressed blocks
        self.ones = head["ones"]  # per plane, ones before each block
        self.unpack = zstandard.ZstdDecompressor()
        self.starts = np.frombuffer(self.unpack.decompress(raw[self.at : self.at + head["starts"]]), "<i8")
        self.at += head["starts"]
        self.cache: OrderedDict[tuple[int, int], np.ndarray] = OrderedDict()
        self.kept = kept

    def plane_block(self, plane: int, k: int) -> np.ndarray:
        """Bits of a block, unpacked."""
        if (plane, k) not in self.cache:
            ends = self.places[plane]
            start = ends[k - 1] if k else (self.places[plane - 1][-1] if plane and self.places[plane - 1] else 0)
            packed = np.frombuffer(self.unpack.decompress(self.raw[self.at + start : self.at + ends[k]]), np.uint8)
            self.cache[plane, k] = np.unpackbits(packed, bitorder="little")
            if len(self.cache) > self.kept:
                self.cache.popitem(last=False)
        return self.cache[plane, k]

    def bit(self, plane: int, i: int) -> int:
        k, j = divmod(i, self.block * 8)
        return int(self.plane_block(plane, k)[j])

    def rank(self, plane: int, i: int, bit: int = 1) -> int:
        """How many of the first i bits of a plane are `bit`."""
        k, j = divmod(i, self.block * 8)
        ones = self.ones[plane][k] if k < len(self.ones[plane]) else self.n - self.zeros[plane]
        if j:
            ones += int(self.plane_block(plane, k)[:j].sum())
        return ones if bit else i - ones

    def select(self, plane: int, k: int, bit: int = 1) -> int:
        """Place of the k-th (from 0) such bit of a plane: a binary search over the counts before blocks, then one block."""
        ones, wide = self.ones[plane], self.block * 8
        before = lambda j: ones[j] if bit else j * wide - ones[j]
        j = bisect_right(range(len(ones)), k, key=before) - 1
        return j * wide + int(np.flatnonzero(self.plane_block(plane, j) == bit)[k - before(j)])

    def _down(self, plane: int, i: int, bit: int) -> int:
        return self.rank(plane, i, bit) + (self.zeros[plane] if bit else 0)

    def access(self, i: int) -> int:
        value = 0
        for plane in range(self.bits):
            bit = self.bit(plane, i)
            value = value << 1 | bit
            i = self._down(plane, i, bit)
        return value

    def _range(self, value: int, start: int, end: int) -> tuple[int, int]:
        for plane in range(self.bits):
            bit = value >> self.bits - 1 - plane & 1
            start, end = self._down(plane, start, bit), self._down(plane, end, bit)
        return start, end

    def count(self, value: int, start: int = 0, end: int | None = None) -> int:
        a, b = self._range(value, start, self.n if end is None else end)
        return b - a

    def occurrence(self, value: int, k: int) -> int | None:
        """Place of the k-th (from 0) occurrence of an id; None if there are fewer."""
        a, b = self._range(value, 0, self.n)
        if k >= b - a:
            return None
        i = a + k
        for plane in reversed(range(self.bits)):
            bit = value >> self.bits - 1 - plane & 1
            i = self.select(plane, i - (self.zeros[plane] if bit else 0), bit)
        return i

    def decode(self) -> np.ndarray:
        """All ids in order: from the lowest plane up, every order is undone."""
        kind = np.uint16 if self.bits <= 16 else np.uint32
        values = np.zeros(self.n, kind)
        for plane in reversed(range(self.bits)):
            blocks = [self.plane_block(plane, k) for k in range(len(self.places[plane]))]
            bits = np.concatenate([np.zeros(0, np.uint8), *blocks])[: self.n].view(bool)
            out, zeros = np.empty(self.n, kind), self.zeros[plane]
            out[np.flatnonzero(~bits)] = values[:zeros]
            out[np.flatnonzero(bits)] = values[zeros:] | kind(1 << self.bits - 1 - plane)
            values = out
        return values.astype(np.uint32)


def encode(ids: np.ndarray, starts: np.ndarray, level: int = 1) -> bytes:
    """The file of a shard: ids, and the place of each document's first id."""
    bits, now = max(1, int(ids.max(initial=0)).bit_length()), ids.astype(np.uint32)
    now = now.astype(np.uint16) if bits <= 16 else now
    pack = zstandard.ZstdCompressor(level=level)
    zeros, places, ones, out, at = [], [], [], [], 0
    for plane in range(bits):
        one = now & now.dtype.type(1 << bits - 1 - plane) > 0
        packed = np.packbits(one, bitorder="little")
        places.append([])
        ones.append([])
        so_far = 0
        for k in range(0, len(packed), BLOCK):
            piece = packed[k : k + BLOCK]
            out.append(pack.compress(piece.tobytes()))
            at += len(out[-1])
            places[-1].append(at)
            ones[-1].append(so_far)
            so_far += int(np.bitwise_count(piece).sum())
        zeros.append(len(now) - so_far)
        now = np.concatenate((np.compress(~one, now), np.compress(one, now)))
    first = pack.compress(np.asarray(starts, "<i8").tobytes())
    head = json.dumps({"ids": len(ids), "bits": bits, "block": BLOCK, "zeros": zeros, "places": places, "ones": ones, "starts": len(first)}).encode()
    return MAGIC + len(head).to_bytes(4, "little") + head + first + b"".join(out)


def write(docs: DataFrame, folder: str | None = None, tokenizer: str = "byte_bpe_50k.json", end_id: int = 0, shard_ids: int = 2_000_000) -> tuple[str, DataFrame]:
    """Write shard files; the folder, and one row per document: doc_id, shard, nth, n.

    Tasks get ranges in order of doc_id and of the text's hash (as many as the session's shuffle partitions, small ones put
    together by adaptive execution), and close a file once it holds `shard_ids` ids, so a task holds one shard (or one longer
    text).  Files are named by task and number and written by rename, so a task that runs twice leaves one of each."""
    spark = docs.sparkSession
    folder = folder or f"{shared_dir(spark)}/wavelet-{cut_name()}"
    path = tokenizer_path(tokenizer)

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words, number, nth = memo(path, keeps_space=True), TaskContext.get().partitionId() << FILES_BITS, 0
        raw, sizes, names, held = [], [], [], 0

        def closed() -> pa.RecordBatch:
            nonlocal raw, sizes, names, held, nth
            shard, n = number + nth, np.concatenate(sizes)
            save(f"{folder}/shard-{shard:015d}.wm", encode(np.concatenate(raw), np.concatenate(([0], np.cumsum(n)))))
            out = pa.RecordBatch.from_arrays([pa.concat_arrays(names), pa.array([shard] * len(n), pa.int64()), pa.array(np.arange(len(n))), pa.array(n)], names=["doc_id", "shard", "nth", "n"])
            raw, sizes, names, held, nth = [], [], [], 0, nth + 1
            return out

        for batch in batches:
            for a, b in runs(batch.column("text"), TEXTS, BYTES):
                ids, n = words.encoded(batch.column("text")[a:b])
                raw.append(np.insert(ids, np.cumsum(n), end_id))
                sizes.append(n + 1)
                names.append(batch.column("doc_id")[a:b])
                held += len(raw[-1])
                if held >= shard_ids:
                    yield closed()
        if raw:
            yield closed()

    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("h")).repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h")
    schema = arrow_schema(docs, "doc_id", "shard long, nth long, n long")
    return folder, stored(rows.select("doc_id", "text").mapInArrow(of_task, schema), "shard-rows")


def cut_name() -> str:
    import uuid

    return uuid.uuid4().hex


def save(uri: str, data: bytes) -> None:
    """Write a file of the shared store under a name of its own and move it into place."""
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    own = f"{path}.{cut_name()}.tmp"
    with system.open_output_stream(own) as out:
        out.write(data)
    system.move(own, path)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """shard, nth (place of the document in its shard), n_tokens, ids_crc32 of every document, decoded from the files."""

    def of_file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                matrix = WaveletMatrix(content.as_py(), kept=1)
                ids, starts = matrix.decode().astype("<u4").tobytes(), matrix.starts.tolist()
                shard = int(name.rpartition("shard-")[2].partition(".")[0])
                crcs = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(starts, starts[1:])]
                yield pa.RecordBatch.from_arrays([pa.array([shard] * len(crcs), pa.int64()), pa.array(range(len(crcs)), pa.int64()), pa.array(np.diff(starts), pa.int64()), pa.array(crcs, pa.int64())], names=["shard", "nth", "n_tokens", "ids_crc32"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.wm").load(folder).select("path", "content")
    return files.mapInArrow(of_file, "shard long, nth long, n_tokens long, ids_crc32 long")


def token_table(docs: DataFrame, **kw) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32, read from the written files."""
    spark = docs.sparkSession
    folder, rows = write(docs, **kw)
    names = rows.select("doc_id", "shard", "nth")
    found = cut(read(spark, folder)) if not rows.isEmpty() else spark.createDataFrame([], "shard long, nth long, n_tokens long, ids_crc32 long")
    shards = found.groupBy("shard").agg(F.sum("n_tokens").alias("total"))  # one row per file
    base = sums_before(shards, "shard", "total", 1 << (FILES_BITS + 10)).select("shard", F.col("before").alias("base"))
    inside = F.coalesce(F.sum("n_tokens").over(Window.partitionBy("shard").orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = found.withColumn("inside", inside).join(base, "shard")
    return names.join(placed, ["shard", "nth"]).select("doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")
