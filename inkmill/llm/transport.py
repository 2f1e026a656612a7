"""MPEG transport streams as a lossless column format.

``mux`` lays a payload out as access units in PES packets, carried by 188-byte transport packets with
program tables, continuity counters, clock references and random-access flags.  ``demux`` reads such a
stream back, or another one: it parses the program tables (sections of any number of packets, with their
checksums), checks the continuity counters, reassembles the elementary packets and keeps every time stamp and
random-access point.

Defined cases: a null text is an empty text; an empty payload gives one padding block of zeros; very long texts
make long streams, of which one at a time is in memory; repeated rows give repeated results; an empty table
gives an empty table; input columns other than the two named ones are ignored, so clashing names do no harm.
A packet that is sent twice counts once; a counter may jump where the discontinuity flag says so; a jump
elsewhere is counted and ends the section that it cuts; a PES packet without a stamp has a null one, and one of
no given length goes on to the next.  Nothing is shuffled: rows are independent of each other.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkmill.llm.common import map_rows

PACKET = 188
BODY = 184
PAT_PID, PMT_PID, ES_PID = 0x0000, 0x1000, 0x0100
PROGRAM = 1
STREAM_TYPE = 0x06  # private data in PES packets
STREAM_ID = 0xBD
CLOCK = 3_003  # 90 kHz ticks between access units
UNIT = 8_192  # payload bytes of an access unit
RAP_EVERY = 8  # access units between random-access points
BLOCK = 64


def _crc_table() -> list[int]:
    table = []
    for n in range(256):
        c = n << 24
        for _ in range(8):
            c = ((c << 1) ^ (0x04C11DB7 if c & 0x80000000 else 0)) & 0xFFFFFFFF
        table.append(c)
    return table


_CRC = _crc_table()


@lru_cache(4096)
def section_crc(data: bytes) -> int:
    c = 0xFFFFFFFF
    for byte in data:
        c = ((c << 8) & 0xFFFFFFFF) ^ _CRC[(c >> 24) ^ byte]
    return c


@lru_cache(16)
def _section(table_id: int, table_ext: int, body: bytes) -> bytes:
    length = 5 + len(body) + 4
    head = bytes([table_id, 0xB0 | length >> 8, length & 255, table_ext >> 8, table_ext & 255, 0xC1, 0, 0])
    return head + body + section_crc(head + body).to_bytes(4, "big")


def _table_packet(pid: int, counter: int, section: bytes) -> bytes:
    head = bytes([0x47, 0x40 | pid >> 8, pid & 255, 0x10 | counter & 15, 0])
    return (head + section).ljust(PACKET, b"\xff")


def _stamp(prefix: int, ticks: int) -> bytes:
    ticks &= (1 << 33) - 1
    return bytes([prefix << 4 | ticks >> 30 << 1 | 1, ticks >> 22 & 255, ticks >> 15 << 1 & 254 | 1, ticks >> 7 & 255, ticks << 1 & 254 | 1])


def mux(payload: bytes, unit: int = UNIT, rap_every: int = RAP_EVERY) -> bytes:
    """``payload`` (any length) as a transport stream of one program with one elementary stream."""
    pat = _section(0x00, 1, bytes([PROGRAM >> 8, PROGRAM & 255, 0xE0 | PMT_PID >> 8, PMT_PID & 255]))
    pmt = _section(0x02, PROGRAM, bytes([0xE0 | ES_PID >> 8, ES_PID & 255, 0xF0, 0, STREAM_TYPE, 0xE0 | ES_PID >> 8, ES_PID & 255, 0xF0, 0]))
    out, counter, tables = [], 0, 0
    for number, at in enumerate(range(0, max(1, len(payload)), unit)):
        data = payload[at : at + unit]
        ticks = number * CLOCK
        pes = b"\x00\x00\x01" + bytes([STREAM_ID]) + (8 + len(data)).to_bytes(2, "big") + b"\x80\x80\x05" + _stamp(2, ticks) + data
        first = b""
        if number % rap_every == 0:
            out += [_table_packet(PAT_PID, tables, pat), _table_packet(PMT_PID, tables, pmt)]
            tables += 1
            base = ticks & ((1 << 33) - 1)
            first = bytes([7, 0x50, base >> 25 & 255, base >> 17 & 255, base >> 9 & 255, base >> 1 & 255, base << 7 & 128 | 0x7E, 0])
        room = BODY - len(first)
        n = 1 + max(0, -(-(len(pes) - room) // BODY))
        grid = np.empty((n, PACKET), np.uint8)
        grid[:, 0] = 0x47
        grid[:, 1] = ES_PID >> 8
        grid[0, 1] |= 0x40
        grid[:, 2] = ES_PID & 255
        grid[:, 3] = 0x10 | (np.arange(counter, counter + n) & 15)
        counter = (counter + n) & 15
        raw = np.frombuffer(pes, np.uint8)
        if n > 2:
            grid[1:-1, 4:] = raw[room : room + (n - 2) * BODY].reshape(n - 2, BODY)
        # only the first and the last packet have adaptation fields
        edges = [(0, raw[:room], first)]
        if n > 1:
            edges.append((n - 1, raw[room + (n - 2) * BODY :], b""))
        for row, part, extra in edges:
            lack = BODY - len(part) - len(extra)
            if lack and extra:
                extra = bytes([extra[0] + lack]) + extra[1:] + b"\xff" * lack
            elif lack:
                extra = bytes([lack - 1]) + (b"\x00" + b"\xff" * (lack - 2) if lack > 1 else b"")
            if extra:
                grid[row, 3] |= 0x20
                grid[row, 4 : 4 + len(extra)] = np.frombuffer(extra, np.uint8)
            grid[row, 4 + len(extra) :] = part
        out.append(grid.tobytes())
    return b"".join(out)


#: PES stream ids whose packets have no further header; the second one is padding.
BARE = frozenset([0xBC, 0xBE, 0xBF, 0xF0, 0xF1, 0xF2, 0xF8, 0xFF])
PADDING = 0xBE


@dataclass
class Stream:
    """What ``demux`` found."""

    programs: dict[int, list[tuple[int, int]]] = field(default_factory=dict)  # program -> (PID, stream type)
    packets: int = 0
    bad_sections: int = 0
    continuity_errors: int = 0
    stamps: list[int | None] = field(default_factory=list)  # of the PES packets of all elementary streams
    random_access: list[int] = field(default_factory=list)  # numbers of the PES packets flagged
    payloads: dict[int, bytes] = field(default_factory=dict)  # by PID

    @property
    def payload(self) -> bytes:
        return b"".join(self.payloads.values())

    def feature(self) -> str:
        pids = ";".join(f"{p}:{pid:04x}/{kind:02x}" for p, found in sorted(self.programs.items()) for pid, kind in found)
        known = [t for t in self.stamps if t is not None]
        span = f"{known[0]}-{known[-1]}" if known else "-"
        return f"prog={pids} packets={self.packets} pes={len(self.stamps)} rap={len(self.random_access)} pts={span} cc_err={self.continuity_errors} crc_err={self.bad_sections}"


def _carried(rows: np.ndarray, stream: Stream) -> tuple[np.ndarray, np.ndarray]:
    """Packets of one PID that carry payload, each once, and which of them a counter's jump precedes."""
    rows = rows[(rows[:, 3] & 0x10) > 0]
    if len(rows) < 2:
        return rows, np.zeros(len(rows), bool)
    step = np.diff(rows[:, 3].astype(np.int32) & 15, prepend=(int(rows[0, 3]) & 15) - 1) & 15
    twice = step == 0
    twice[twice] = (rows[twice] == rows[np.flatnonzero(twice) - 1]).all(1)
    rows, step = rows[~twice], step[~twice]
    told = ((rows[:, 3] & 0x20) > 0) & (rows[:, 4] > 0) & ((rows[:, 5] & 0x80) > 0)
    jump = (step != 1) & ~told
    jump[0] = False
    stream.continuity_errors += int(jump.sum())
    return rows, jump


def _body(row: bytes) -> int:
    return 5 + row[4] if row[3] & 0x20 else 4


def _sections(packets: np.ndarray, stream: Stream) -> Iterator[tuple[int, bytes]]:
    """(table id extension, body) of all current sections in packets of one PID; bad checksums are counted."""
    held: bytearray | None = None  # from the start of a section on
    for row, jump in zip(*_carried(packets, stream), strict=True):
        data = row.tobytes()
        part = data[_body(data) :]
        if jump:
            held = None
        parts = [part]
        if data[1] & 0x40 and part:  # a section starts behind the rest of the last one
            parts = [part[1 : 1 + part[0]], part[1 + part[0] :]]
        for number, piece in enumerate(parts):
            if number:
                held = bytearray()
            if held is None:
                continue
            held += piece
            while held is not None and len(held) >= 3:
                length = 3 + ((held[1] & 15) << 8 | held[2])
                if held[0] == 0xFF:
                    held = None
                elif len(held) < length:
                    break
                else:
                    section, held = bytes(held[:length]), held[length:]
                    if length < 12 or section_crc(section[:-4]) != int.from_bytes(section[-4:], "big"):
                        stream.bad_sections += 1
                    elif section[5] & 1:  # else it tells of a table to come
                        yield section[3] << 8 | section[4], section[8:-4]


def demux(data: bytes) -> Stream:
    """Parse a transport stream; raises ValueError where packets lack their sync byte or PES packets their start code."""
    if len(data) % PACKET:
        raise ValueError("not a whole number of transport packets")
    grid = np.frombuffer(data, np.uint8).reshape(-1, PACKET)
    if (grid[:, 0] != 0x47).any():
        raise ValueError("sync byte lost")
    stream = Stream(packets=len(grid))
    pid = (grid[:, 1] & 0x1F).astype(np.int32) << 8 | grid[:, 2]
    maps: dict[int, None] = {}
    for _, body in _sections(grid[pid == PAT_PID], stream):
        for at in range(0, len(body) - 3, 4):
            if body[at] or body[at + 1]:  # program 0 is the network's table
                maps[(body[at + 2] & 31) << 8 | body[at + 3]] = None
    for table_pid in maps:
        for program, body in _sections(grid[pid == table_pid], stream):
            found, at = [], 4 + ((body[2] & 15) << 8 | body[3])
            while at + 5 <= len(body):
                found.append(((body[at + 1] & 31) << 8 | body[at + 2], body[at]))
                at += 5 + ((body[at + 3] & 15) << 8 | body[at + 4])
            stream.programs[program] = found
    for es_pid in dict.fromkeys(p for _, found in sorted(stream.programs.items()) for p, _ in found):
        stream.payloads[es_pid] = _elementary(grid[pid == es_pid], stream)
    return stream


def _elementary(packets: np.ndarray, stream: Stream) -> bytes:
    """The payload of an elementary stream; its stamps and random-access points are appended to ``stream``."""
    rows, _ = _carried(packets, stream)
    extra = (rows[:, 3] & 0x20) > 0
    start = np.where(extra, rows[:, 4].astype(np.int32) + 5, 4)
    flags = np.where(extra & (rows[:, 4] > 0), rows[:, 5], 0)
    held = rows[np.arange(PACKET) >= start[:, None]].tobytes()
    begins = np.flatnonzero(rows[:, 1] & 0x40)
    offsets = np.concatenate([[0], np.cumsum(np.maximum(PACKET - start, 0))])
    parts = []
    for a, b in zip(begins.tolist(), [*begins[1:].tolist(), len(rows)], strict=True):
        pes = held[offsets[a] : offsets[b]]
        if pes[:3] != b"\x00\x00\x01" or len(pes) < 6:
            raise ValueError("a PES packet lacks its start code")
        if pes[3] == PADDING:
            continue
        size = int.from_bytes(pes[4:6], "big")
        end = 6 + size if size else len(pes)
        head, stamp = 6, None
        if pes[3] not in BARE and len(pes) >= 9:
            head = 9 + pes[8]
            if pes[7] & 0x80 and len(pes) >= 14:
                t = pes[9:14]
                stamp = (t[0] >> 1 & 7) << 30 | t[1] << 22 | t[2] >> 1 << 15 | t[3] << 7 | t[4] >> 1
        if flags[a] & 0x40:
            stream.random_access.append(len(stream.stamps))
        stream.stamps.append(stamp)
        parts.append(pes[head:end])
    return b"".join(parts)


def padded(text: str | None) -> tuple[int, bytes]:
    """(bytes of the text, its UTF-8 bytes filled with zeros to a positive multiple of 64)."""
    raw = (text or "").encode("utf-8")
    return len(raw), raw.ljust(max(1, -(-len(raw) // BLOCK)) * BLOCK, b"\0")


def write_streams(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, n_bytes, media): every text as a transport stream."""

    def rows(source: Iterator[tuple]) -> Iterator[tuple]:
        for k, t in source:
            n, payload = padded(t)
            yield k, n, mux(payload)

    picked = df.select(F.col(key).alias("k"), F.col(text).alias("t"))
    return map_rows(picked, f"{key} {picked.schema['k'].dataType.simpleString()}, n_bytes long, media binary", rows)


def read_streams(df: DataFrame, key: str) -> DataFrame:
    """(key, n_bytes, media digests, payload, program table, stamps, random-access points) of ``write_streams``."""

    def rows(source: Iterator[tuple]) -> Iterator[tuple]:
        for k, n, media in source:
            s = demux(media)
            payload = s.payload
            yield k, n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-BLOCK:]), len(media), hashlib.sha256(media).hexdigest(), s.feature(), s.continuity_errors, s.stamps, s.random_access

    kind = df.schema[key].dataType.simpleString()
    return map_rows(df.select(key, "n_bytes", "media"), f"{key} {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, continuity_errors long, stamps array<long>, random_access array<int>", rows)
