"""Transport streams: exact round trips, and what is left of damaged ones."""

import hashlib
import random
import zlib

import numpy as np

from annoframe.llm import transport_stream as ts

UNIT = ts.ACCESS_UNIT


def test_round_trip(docs, empty, rows):
    got = {(r.doc_id, r.n_bytes, r.payload_sha256): r for r in ts.features(ts.store(docs)).collect()}
    for doc_id, text, *_ in rows:
        b = (text or "").encode()
        p = b + b"\xff" * (-len(b) % 576 if b else 576)
        r = got[doc_id, len(b), hashlib.sha256(p).hexdigest()]
        assert (r.payload_bytes, r.tail_crc32) == (len(p), zlib.crc32(p[-32:]))
        assert r.media_bytes % 188 == 0 and "bad_sync=0;crc_errors=0" in r.feature and "breaks=0;repeats=0;torn=0" in r.feature
    assert ts.features(ts.store(empty)).count() == 0


def made(n_units=5, seed=1):
    payload = random.Random(seed).randbytes(n_units * UNIT + 576)
    stream = ts.mux(payload)
    return payload, [stream[k : k + 188] for k in range(0, len(stream), 188)]


def starts(packets):
    return [k for k, p in enumerate(packets) if p[1] & 0x40 and (p[1] & 0x1F) << 8 | p[2] == ts.MEDIA_PID]


def without_unit(payload, k):
    return payload[: k * UNIT] + payload[(k + 1) * UNIT :]


def test_whole_stream():
    payload, packets = made()
    s = ts.demux(b"".join(packets))
    e = s.streams[0]
    assert s.payload == payload and (s.programs, s.bad_sync, s.crc_errors) == (1, 0, 0) and (e.breaks, e.repeats, e.torn) == (0, 0, 0)
    assert list(e.times) == [3600 * (k + 1) for k in range(6)] and list(e.access) == starts(packets)


def test_lost_packet_drops_its_elementary_packet_only():
    payload, packets = made()
    first = starts(packets)
    for at, unit in ((first[2] + 3, 2), (first[2], 2), (first[3] - 1, 2), (first[0] + 1, 0)):
        e = ts.demux(b"".join(packets[:at] + packets[at + 1 :])).streams[0]
        assert e.payload == without_unit(payload, unit) and e.breaks == 1
    gone = ts.demux(b"".join(packets[: first[1]] + packets[first[3] :])).streams[0]
    assert gone.payload == payload[:UNIT] + payload[3 * UNIT :]
    late = ts.demux(b"".join(packets[:2] + packets[first[1] - 2 :])).streams[0]  # begins in the midst of a packet
    assert late.payload == payload[UNIT:] and late.torn == 1


def test_repeated_packets_count_once():
    payload, packets = made()
    first = starts(packets)
    for at in (first[1], first[1] + 4):
        s = ts.demux(b"".join(packets[: at + 1] + packets[at:]))
        assert s.payload == payload and (s.streams[0].repeats, s.streams[0].breaks, s.streams[0].torn) == (1, 0, 0)


def test_damage():
    payload, packets = made()
    first = starts(packets)
    for at, place, value in ((first[2] + 2, 1, 0x80), (first[2], 12, 0x55), (first[2], 17, 0x99), (first[2] + 2, 3, 0xC0)):  # error flag, start code, length, scrambled
        hurt = bytearray(packets[at])
        hurt[place] ^= value
        s = ts.demux(b"".join([*packets[:at], bytes(hurt), *packets[at + 1 :]]))
        assert s.payload == without_unit(payload, 2) and s.streams[0].torn == 1
    hurt = bytearray(packets[first[2] + 1])
    hurt[0] = 0
    s = ts.demux(b"".join([*packets[: first[2] + 1], bytes(hurt), *packets[first[2] + 2 :]]))
    assert s.payload == without_unit(payload, 2) and s.bad_sync == 1
    table = bytearray(packets[1])
    table[20] ^= 1
    s = ts.demux(b"".join([packets[0], bytes(table), *packets[2:]]))
    assert s.crc_errors == 1 and not s.streams and s.payload == b""
    assert ts.demux(b"").payload == b"" and ts.demux(b"\0" * 400).bad_sync == 2


def renamed(packet, pid):
    return packet[:1] + bytes([packet[1] & 0xE0 | pid >> 8, pid & 0xFF]) + packet[3:]


def test_foreign_packets_and_several_programs():
    a, pa_ = made(3, 1)
    b, pb = made(2, 2)
    pat = ts.table_packet(0, 0, 1, bytes([0, 0, 0xE0, 0x10, 0, 1, 0xF0, 0, 0, 2, 0xF1, 0])).tobytes()  # a network entry, then two programs
    maps = [ts.table_packet(pid, 2, n, bytes([0xE1, n, 0xF0, 3, 9, 1, 7, 6, 0xE1, n, 0xF0, 2, 5, 0]) + more).tobytes() for n, pid, more in ((1, 0x1000, b""), (2, 0x1100, bytes([0x1B, 0xE1, 9, 0xF0, 0])))]
    own_a, own_b = [renamed(p, 0x101) for p in pa_[2:]], [renamed(p, 0x102) for p in pb[2:]]
    null = renamed(pa_[3], 0x1FFF)
    woven = [x for k in range(len(own_a)) for x in (own_a[k], null, *own_b[k : k + 1])]
    s = ts.demux(b"".join([pat, *maps, *woven, pat, *maps]))
    assert s.programs == 2 and [(e.pid, e.kind) for e in s.streams] == [(0x101, 6), (0x102, 6), (0x109, 0x1B)]
    assert [e.payload for e in s.streams] == [a, b, b""] and s.crc_errors == 0
    assert all(e.breaks == 0 and e.torn == 0 for e in s.streams)


def test_sections_over_several_packets():
    body = bytes([0xE1, 0, 0xF0, 0]) + b"".join(bytes([6, 0xE1, k, 0xF0, 0]) for k in range(60))
    section = bytes([2, 0xB0 | (len(body) + 9) >> 8, (len(body) + 9) & 0xFF, 0, 1, 0xC1, 0, 0]) + body
    section += ts.section_crc(section).to_bytes(4, "big")
    raw = b"\0" + section
    packets = [bytes([0x47, (0x40 if k == 0 else 0) | 0x10, 0, 0x10 | k]) + raw[184 * k : 184 * (k + 1)].ljust(184, b"\xff") for k in range(2)]
    found, wrong = ts.sections(np.frombuffer(b"".join(packets), np.uint8).reshape(-1, 188))
    assert found == [section] and wrong == 0
    found, wrong = ts.sections(np.frombuffer(packets[0], np.uint8).reshape(-1, 188))
    assert found == [] and wrong == 1
