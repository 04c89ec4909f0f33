"""Operator 2, media columns: MPEG transport streams (ISO/IEC 13818-1).

`mux` stores a payload in a stream of 188-byte packets: a program association table, a program map table, then one
elementary stream of access units, each in a packetised elementary packet with a presentation time stamp, its first
packet marked as a random-access point with a clock reference.  `demux` parses the tables (all sections of all programs,
with their checksums), checks the continuity counters, reassembles the elementary packets of every elementary stream, and
lists time stamps and random-access points.

An elementary packet counts only if it is whole: it begins with a start code, no counter break, transport error or
scrambled packet lies inside, and its bytes are as many as its length field says (a length of 0 runs to the next start).
A packet that is sent twice, with the same counter and bytes, counts once.  What is not whole is left out and counted.

All packets of equal access units are built and read as one array; a text costs a few array operations.  A task holds a
few copies of one text's stream beside its batch, so the longest text bounds its memory.

Edge cases: null or empty text is a payload of padding only; damaged or foreign bytes (`demux`) give whatever elementary
packets are whole, and counts of what is wrong; a stream without tables has no elementary streams and an empty payload.
Repeated rows are repeated; other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import arrow_schema
from .hashing import slices

PACKET, SYNC = 188, 0x47
UNIT = 576
ACCESS_UNIT = 16 * UNIT  # payload bytes per elementary packet
CLOCK, UNITS_PER_SECOND = 90_000, 25
PAT_PID, PMT_PID, MEDIA_PID = 0, 0x1000, 0x100
PRIVATE_DATA, PRIVATE_STREAM = 0x06, 0xBD
PES_HEADER = 14


def _crc_table() -> list[int]:
    out = []
    for k in range(256):
        c = k << 24
        for _ in range(8):
            c = (c << 1 ^ 0x04C11DB7 if c & 0x80000000 else c << 1) & 0xFFFFFFFF
        out.append(c)
    return out


_CRC = _crc_table()


def section_crc(data: bytes) -> int:
    """The tables' checksum: polynomial 04C11DB7, most significant bit first, no final inversion; 0 over data and checksum."""
    c = 0xFFFFFFFF
    for b in data:
        c = (c << 8 & 0xFFFFFFFF) ^ _CRC[c >> 24 ^ b]
    return c


def table_packet(pid: int, table: int, number: int, body: bytes) -> np.ndarray:
    section = bytes([table, 0xB0, len(body) + 9]) + number.to_bytes(2, "big") + b"\xc1\x00\x00" + body
    section += section_crc(section).to_bytes(4, "big")
    raw = bytes([SYNC, 0x40 | pid >> 8, pid & 0xFF, 0x10, 0]) + section
    return np.frombuffer(raw.ljust(PACKET, b"\xff"), np.uint8)


TABLES = np.stack([table_packet(PAT_PID, 0, 1, bytes([0, 1, 0xE0 | PMT_PID >> 8, PMT_PID & 0xFF])), table_packet(PMT_PID, 2, 1, bytes([0xE0 | MEDIA_PID >> 8, MEDIA_PID & 0xFF, 0xF0, 0, PRIVATE_DATA, 0xE0 | MEDIA_PID >> 8, MEDIA_PID & 0xFF, 0xF0, 0]))])


def _clock_bytes(first: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """PTS fields (5 bytes) and PCR fields (6 bytes) of n access units from number `first` on."""
    t = ((np.arange(first, first + n, dtype=np.int64) + 1) * (CLOCK // UNITS_PER_SECOND)) & ((1 << 33) - 1)
    pts = np.stack([0x21 | t >> 30 << 1, t >> 22 & 0xFF, 1 | t >> 15 << 1 & 0xFF, t >> 7 & 0xFF, 1 | t << 1 & 0xFF], 1)
    c = t - CLOCK // UNITS_PER_SECOND
    pcr = np.stack([c >> 25 & 0xFF, c >> 17 & 0xFF, c >> 9 & 0xFF, c >> 1 & 0xFF, (c & 1) << 7 | 0x7E, 0 * c], 1)
    return pts.astype(np.uint8), pcr.astype(np.uint8)


def elementary_packets(units: np.ndarray, first: int) -> np.ndarray:
    """Transport packets (units, packets of each, 188) of equally long access units; `first`: number of the first unit."""
    n, size = units.shape
    pts, pcr = _clock_bytes(first, n)
    pes = np.empty((n, PES_HEADER + size), np.uint8)
    pes[:, :9] = np.frombuffer(bytes([0, 0, 1, PRIVATE_STREAM, (size + 8) >> 8, (size + 8) & 0xFF, 0x84, 0x80, 5]), np.uint8)
    pes[:, 9:14] = pts
    pes[:, 14:] = units
    head = PACKET - 4 - 8  # the first packet has an adaptation field of 8 bytes
    rest = max(0, pes.shape[1] - head)
    full, tail = divmod(rest, PACKET - 4)
    per = 1 + full + (tail > 0)
    out = np.full((n, per, PACKET), 0xFF, np.uint8)
    out[:, :, 0], out[:, :, 1], out[:, :, 2] = SYNC, MEDIA_PID >> 8, MEDIA_PID & 0xFF
    out[:, 0, 1] |= 0x40
    out[:, :, 3] = 0x10
    out[:, 0, 3] = 0x30
    out[:, 0, 4:6] = (7, 0x50)  # random access, clock reference
    out[:, 0, 6:12] = pcr
    out[:, 0, 12:] = pes[:, :head]
    out[:, 1 : 1 + full, 4:] = pes[:, head : head + full * (PACKET - 4)].reshape(n, full, PACKET - 4)
    if tail:  # stuffing in front of the last bytes
        out[:, -1, 3] = 0x30
        out[:, -1, 4] = PACKET - 5 - tail
        if PACKET - 5 - tail:
            out[:, -1, 5] = 0
        out[:, -1, PACKET - tail :] = pes[:, -tail:]
    return out.reshape(-1, PACKET)


def mux(payload: bytes) -> bytes:
    """The stream of a payload, a positive multiple of 576 bytes."""
    data = np.frombuffer(payload, np.uint8)
    whole = len(data) // ACCESS_UNIT
    parts = [TABLES]
    if whole:
        parts.append(elementary_packets(data[: whole * ACCESS_UNIT].reshape(whole, ACCESS_UNIT), 0))
    if len(data) > whole * ACCESS_UNIT:
        parts.append(elementary_packets(data[whole * ACCESS_UNIT :][None, :], whole))
    packets = np.concatenate(parts)
    packets[2:, 3] |= (np.arange(len(packets) - 2) & 15).astype(np.uint8)
    return packets.tobytes()


class Elementary(NamedTuple):
    pid: int
    kind: int  # stream type of the program map
    payload: bytes  # of its whole elementary packets
    breaks: int  # of continuity counters
    repeats: int  # packets sent twice
    torn: int  # elementary packets that are not whole
    times: np.ndarray  # time stamps of the whole elementary packets that have one
    access: np.ndarray  # packet numbers of random-access points


class Stream(NamedTuple):
    programs: int
    packets: int
    bad_sync: int
    crc_errors: int
    streams: list[Elementary]  # in the order that the tables list them

    @property
    def payload(self) -> bytes:
        return self.streams[0].payload if self.streams else b""


def payload_starts(m: np.ndarray) -> np.ndarray:
    """Where each packet's payload begins; PACKET where it has none."""
    control = m[:, 3] >> 4 & 3
    skip = np.where(control & 2, 5 + m[:, 4].astype(np.int64), 4)
    return np.where(control & 1, np.minimum(skip, PACKET), PACKET)


def sections(m: np.ndarray) -> tuple[list[bytes], int]:
    """The sections in one PID's packets whose checksums hold, each once; the number of those that don't."""
    out: dict[bytes, None] = {}
    wrong, data = 0, None
    for row, skip in zip(m, payload_starts(m).tolist()):
        raw = row.tobytes()
        if raw[1] & 0x40 and skip < PACKET:
            skip += 1 + raw[skip]  # the pointer field
            data = b""
        if data is None:
            continue
        data += raw[skip:]
        while len(data) >= 3 and data[0] != 0xFF:
            size = 3 + ((data[1] & 0x0F) << 8 | data[2])
            if len(data) < size:
                break
            section, data = data[:size], data[size:]
            if size < 12 or section_crc(section):
                wrong += 1
            else:
                out[section] = None
    return list(out), wrong + (data is not None and len(data) >= 3 and data[0] != 0xFF)


def elementary(a: np.ndarray, where: np.ndarray, pid: int, kind: int) -> Elementary:
    """Reassemble the packets a[where] of one PID."""
    m = a[where]
    again = np.zeros(len(m), bool)
    again[1:] = (m[1:] == m[:-1]).all(1) & (m[1:, 3] & 0x10 > 0)
    where, m = where[~again], m[~again]
    counter, control = m[:, 3] & 15, m[:, 3] >> 4 & 3
    broken = np.zeros(len(m), bool)  # a counter moves on with every packet that has a payload
    broken[1:] = (counter[1:] - counter[:-1] - (control[1:] & 1)) & 15 != 0
    bad = (m[:, 1] & 0x80 > 0) | (m[:, 3] & 0xC0 > 0)  # transport error, scrambled
    skip = payload_starts(m)
    access = where[(control & 2 > 0) & (m[:, 4] > 0) & (m[:, 5] & 0x40 > 0)]
    starts = np.flatnonzero((m[:, 1] & 0x40 > 0) & (skip < PACKET))
    pieces, times, torn = [], [], int(len(m) > 0 and (len(starts) == 0 or starts[0] > 0))
    # an elementary packet ends before the next start, break or bad packet
    stops = np.concatenate((np.flatnonzero(broken | bad), starts, [len(m)]))
    stops.sort()
    ends = stops[np.searchsorted(stops, starts, "right")]
    taken_to = np.concatenate(([0], np.cumsum(PACKET - skip)))
    cut_short = np.append(broken | bad, False)[ends]  # so that a packet without a length has no known end
    sound = ~bad[starts] & (skip[starts] <= PACKET - 9)
    bodies = np.arange(PACKET) >= skip[:, None]
    for s, e, ok, short, size in zip(starts.tolist(), ends.tolist(), sound.tolist(), cut_short.tolist(), (taken_to[ends] - taken_to[starts]).tolist()):
        head = m[s, skip[s] :].tobytes()
        declared = int.from_bytes(head[4:6], "big")
        ok = ok and head[:3] == b"\0\0\1" and 9 + head[8] <= size and (declared == size - 6 or declared == 0 and not short)
        if not ok:
            torn += 1
            continue
        pieces.append(m[s:e][bodies[s:e]].tobytes()[9 + head[8] :])
        if head[7] & 0x80 and len(head) >= PES_HEADER:
            times.append((head[9] >> 1 & 7) << 30 | head[10] << 22 | head[11] >> 1 << 15 | head[12] << 7 | head[13] >> 1)
    return Elementary(pid, kind, b"".join(pieces), int(broken.sum()), int(again.sum()), torn, np.array(times, np.int64), access)


def demux(stream: bytes) -> Stream:
    a = np.frombuffer(stream[: len(stream) // PACKET * PACKET], np.uint8).reshape(-1, PACKET)
    good = a[:, 0] == SYNC
    pid = (a[:, 1].astype(np.int32) & 0x1F) << 8 | a[:, 2]
    packets_of = lambda p: np.flatnonzero(good & (pid == p))
    tables, crc_errors = sections(a[packets_of(PAT_PID)])
    programs = {(t[k + 2] & 0x1F) << 8 | t[k + 3]: None for t in tables if t[0] == 0 for k in range(8, len(t) - 7, 4) if t[k : k + 2] != b"\0\0"}
    listed: dict[int, int] = {}
    for program in programs:
        maps, wrong = sections(a[packets_of(program)])
        crc_errors += wrong
        for t in maps:
            k = 12 + ((t[10] & 0x0F) << 8 | t[11])
            while t[0] == 2 and k + 5 <= len(t) - 4:
                listed.setdefault((t[k + 1] & 0x1F) << 8 | t[k + 2], t[k])
                k += 5 + ((t[k + 3] & 0x0F) << 8 | t[k + 4])
    return Stream(len(programs), len(a), int((~good).sum()), crc_errors, [elementary(a, packets_of(p), p, kind) for p, kind in listed.items()])


def padded(text: bytes) -> bytes:
    """With bytes 255 up to a positive multiple of UNIT."""
    return text.ljust(max(1, -(-len(text) // UNIT)) * UNIT, b"\xff")


def store(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes (unpadded), media (the stream)."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, end, texts in slices(batch.column("text"), 256):
                yield pa.RecordBatch.from_arrays([batch.column("doc_id")[at:end], pa.array([len(t) for t in texts], pa.int64()), pa.array([mux(padded(t)) for t in texts], pa.binary())], names=["doc_id", "n_bytes", "media"])

    return docs.select("doc_id", "text").mapInArrow(build, arrow_schema(docs, "doc_id", "n_bytes long, media binary"))


FEATURES = "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def features(media: DataFrame) -> DataFrame:
    """Of each stream, read back: its first elementary stream's size and digests, and what the tables and packets say."""

    def read(media: bytes | None) -> tuple:
        s = demux(media or b"")
        said = [f"programs={s.programs}", f"packets={s.packets}", f"bad_sync={s.bad_sync}", f"crc_errors={s.crc_errors}"]
        for e in s.streams:
            times = f"{e.times[0]}-{e.times[-1]}" if len(e.times) else "none"
            said += [f"pid={e.pid}", f"type={e.kind}", f"breaks={e.breaks}", f"repeats={e.repeats}", f"torn={e.torn}", f"pes={len(e.times)}", f"pts={times}", f"random_access={len(e.access)}@{zlib.crc32(e.access.astype('<i8').tobytes()):08x}"]
        payload = s.payload
        return len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(media or b""), hashlib.sha256(media or b"").hexdigest(), ";".join(said)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [read(x.as_py()) for x in batch.column("media")]
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            columns = [pa.array(x, t) for x, t in zip(zip(*rows), kinds)] if rows else [pa.array([], t) for t in kinds]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), *columns], names=["doc_id", "n_bytes", *[f.split()[0] for f in FEATURES.split(", ")]])

    return media.mapInArrow(parse, arrow_schema(media, "doc_id, n_bytes", FEATURES))
