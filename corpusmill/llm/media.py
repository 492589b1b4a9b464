"""Media columns: MPEG-2 transport streams (ISO/IEC 13818-1).

``mux`` wraps a payload in a transport stream of one program with one private elementary
stream: PAT and PMT, then one PES packet for each access unit, with time stamps, clock
references and random-access flags. ``demux`` reads any stream of 188-byte packets: it
parses the program tables, checks continuity counters, reassembles PES packets and returns
time stamps and random-access points.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .shared import settings, sliced, staged, text_of

PACKET = 188
SYNC = 0x47
PAT_PID, PMT_PID, ES_PID, NULL_PID = 0x0000, 0x1000, 0x0100, 0x1FFF
PRIVATE_STREAM, PRIVATE_TYPE = 0xBD, 0x06
#: Payload bytes of an access unit, ticks of the 90 kHz clock between two, and units between random-access points.
UNIT, TICKS, RAP_EVERY = 16_384, 3_600, 8
#: Payloads are padded with zero bytes to a positive multiple of this.
BLOCK = 64


def _crc_table() -> list[int]:
    table = []
    for i in range(256):
        crc = i << 24
        for _ in range(8):
            crc = (crc << 1 ^ 0x04C11DB7 if crc & 0x80000000 else crc << 1) & 0xFFFFFFFF
        table.append(crc)
    return table


_CRC = _crc_table()


def crc32_mpeg(data: bytes) -> int:
    """CRC-32/MPEG-2, as program tables carry it."""
    crc = 0xFFFFFFFF
    for byte in data:
        crc = (crc << 8 ^ _CRC[crc >> 24 ^ byte]) & 0xFFFFFFFF
    return crc


def _section(table_id: int, ident: int, body: bytes) -> bytes:
    length = 5 + len(body) + 4
    head = bytes([table_id, 0xB0 | length >> 8, length & 0xFF, ident >> 8, ident & 0xFF, 0xC1, 0, 0]) + body
    return head + crc32_mpeg(head).to_bytes(4, "big")


def _table_packet(pid: int, section: bytes) -> bytes:
    packet = bytes([SYNC, 0x40 | pid >> 8, pid & 0xFF, 0x10, 0]) + section
    return packet + b"\xff" * (PACKET - len(packet))


_PAT = _table_packet(PAT_PID, _section(0x00, 1, bytes([0, 1, 0xE0 | PMT_PID >> 8, PMT_PID & 0xFF])))
_PMT = _table_packet(
    PMT_PID,
    _section(
        0x02, 1,
        bytes([0xE0 | ES_PID >> 8, ES_PID & 0xFF, 0xF0, 0, PRIVATE_TYPE, 0xE0 | ES_PID >> 8, ES_PID & 0xFF, 0xF0, 0]),
    ),
)


def _stamp(ticks: int, mark: int) -> bytes:
    """A 33-bit time stamp in the five bytes of a PES header."""
    return bytes(
        [
            mark << 4 | (ticks >> 30 & 7) << 1 | 1, ticks >> 22 & 0xFF, (ticks >> 15 & 0x7F) << 1 | 1,
            ticks >> 7 & 0xFF, (ticks & 0x7F) << 1 | 1,
        ]
    )


def _unstamp(b: bytes) -> int:
    return (b[0] >> 1 & 7) << 30 | b[1] << 22 | b[2] >> 1 << 15 | b[3] << 7 | b[4] >> 1


def _clock(ticks: int) -> bytes:
    """A program clock reference (base only)."""
    return bytes([ticks >> 25 & 0xFF, ticks >> 17 & 0xFF, ticks >> 9 & 0xFF, ticks >> 1 & 0xFF, (ticks & 1) << 7 | 0x7E, 0])


def mux(payload: bytes) -> bytes:
    """The payload as a transport stream."""
    out = [_PAT, _PMT]
    counter = 0
    for k, at in enumerate(range(0, len(payload), UNIT)):
        unit = payload[at : at + UNIT]
        ticks = (k * TICKS + TICKS) % (1 << 33)
        length = 3 + 5 + len(unit)
        # aligned private data, time stamp only
        pes = b"\x00\x00\x01" + bytes([PRIVATE_STREAM, length >> 8, length & 0xFF, 0x84, 0x80, 5]) + _stamp(ticks, 2) + unit
        adaptation = bytes([7, 0x50 if k % RAP_EVERY == 0 else 0x10]) + _clock(k * TICKS % (1 << 33))
        room = PACKET - 4 - len(adaptation)
        if len(pes) < room:
            adaptation = bytes([adaptation[0] + room - len(pes)]) + adaptation[1:] + b"\xff" * (room - len(pes))
        first = pes[:room]
        out.append(bytes([SYNC, 0x40 | ES_PID >> 8, ES_PID & 0xFF, 0x30 | counter]) + adaptation + first)
        counter = counter + 1 & 15
        rest = pes[room:]
        whole = len(rest) // (PACKET - 4)
        if whole:  # full packets differ in their counter only
            block = np.empty((whole, PACKET), np.uint8)
            block[:, :3] = SYNC, ES_PID >> 8, ES_PID & 0xFF
            block[:, 3] = 0x10 | (np.arange(counter, counter + whole) & 15)
            block[:, 4:] = np.frombuffer(rest, np.uint8, whole * (PACKET - 4)).reshape(whole, PACKET - 4)
            out.append(block.tobytes())
            counter = counter + whole & 15
        tail = rest[whole * (PACKET - 4) :]
        if tail:
            size = PACKET - 5 - len(tail)
            stuffing = bytes([size]) + (b"\x00" + b"\xff" * (size - 1) if size else b"")
            out.append(bytes([SYNC, ES_PID >> 8, ES_PID & 0xFF, 0x30 | counter]) + stuffing + tail)
            counter = counter + 1 & 15
    return b"".join(out)


@dataclass
class Unit:
    """A reassembled PES packet."""

    pid: int
    stream_id: int
    data: bytes
    pts: int | None
    dts: int | None
    random_access: bool
    broken: bool


@dataclass
class Stream:
    """What ``demux`` finds."""

    packets: int = 0
    programs: dict[int, int] = field(default_factory=dict)
    streams: dict[int, tuple[int, int]] = field(default_factory=dict)  # pid -> (program, stream type)
    units: list[Unit] = field(default_factory=list)
    #: continuity errors, duplicate packets, damaged tables, packets without sync or flagged as errors
    discontinuities: int = 0
    duplicates: int = 0
    bad_tables: int = 0
    bad_packets: int = 0
    clocks: list[tuple[int, int]] = field(default_factory=list)  # (pid, 90 kHz clock)

    def payload(self, pid: int | None = None) -> bytes:
        """The data of all PES packets (of one pid), in order."""
        return b"".join(u.data for u in self.units if pid is None or u.pid == pid)


class _Tables:
    """Program tables as they come: sections may span packets, and several may share one."""

    def __init__(self, out: Stream):
        self.out = out
        self.open: dict[int, bytearray] = {}

    def add(self, pid: int, data: bytes, begins: bool) -> None:
        """The payload of a packet; where a section begins in it, its first byte points there."""
        if begins and data:
            start = 1 + data[0]
            if pid in self.open:  # what stands before it ends the section before
                self.open[pid] += data[1:start]
                self._read(pid)
            self.drop(pid)
            self.open[pid] = bytearray(data[start:])
            self._read(pid)
        elif pid in self.open:
            self.open[pid] += data
            self._read(pid)

    def drop(self, pid: int) -> None:
        """A section that does not end counts as a bad table."""
        self.out.bad_tables += pid in self.open
        self.open.pop(pid, None)

    def _read(self, pid: int) -> None:
        held, at = self.open[pid], 0
        while at + 3 <= len(held) and held[at] != 0xFF:
            end = at + 3 + ((held[at + 1] & 0x0F) << 8 | held[at + 2])
            if end > len(held):
                break
            section = bytes(held[at:end])
            if len(section) < 12 or crc32_mpeg(section):
                self.out.bad_tables += 1
            elif section[5] & 1:  # in force already
                _table(section, self.out)
            at = end
        if at == len(held) or held[at] == 0xFF:  # nothing more but stuffing
            del self.open[pid]
        else:
            del held[:at]


def _table(s: bytes, out: Stream) -> None:
    """What a section (its checksum is right) says of programs or of a program's streams."""
    ident, body = s[3] << 8 | s[4], s[8:-4]
    if s[0] == 0x00:
        for i in range(0, len(body) - 3, 4):
            if number := body[i] << 8 | body[i + 1]:
                out.programs[number] = (body[i + 2] & 0x1F) << 8 | body[i + 3]
    elif s[0] == 0x02 and len(body) >= 4:
        i = 4 + ((body[2] & 0x0F) << 8 | body[3])
        while i + 5 <= len(body):
            out.streams[(body[i + 1] & 0x1F) << 8 | body[i + 2]] = ident, body[i]
            i += 5 + ((body[i + 3] & 0x0F) << 8 | body[i + 4])


def _pes(pid: int, data: bytes, random_access: bool, broken: bool) -> Unit | None:
    if len(data) < 6 or data[:3] != b"\x00\x00\x01":
        return None
    length = data[4] << 8 | data[5]
    end = 6 + length if length else len(data)
    start, pts, dts = 6, None, None
    if data[3] not in (0xBC, 0xBE, 0xBF, 0xF0, 0xF1, 0xF2, 0xF8, 0xFF) and len(data) >= 9:
        start = 9 + data[8]
        if data[7] & 0x80 and len(data) >= 14:
            pts = _unstamp(data[9:14])
        if data[7] & 0xC0 == 0xC0 and len(data) >= 19:
            dts = _unstamp(data[14:19])
    return Unit(pid, data[3], data[start:end], pts, dts, random_access, broken or end > len(data))


def demux(stream: bytes) -> Stream:
    """Parse a transport stream; damaged parts are counted and what can be read is returned.

    An empty stream has nothing in it. Bytes after the last whole packet, and packets without
    sync byte, count as bad packets. A counter that does not follow marks the PES packet that it
    interrupts as broken; a repeated packet is dropped.
    """
    out = Stream()
    whole, rest = divmod(len(stream), PACKET)
    out.bad_packets += bool(rest)
    out.packets = whole
    view = np.frombuffer(stream, np.uint8, whole * PACKET).reshape(whole, PACKET)
    head = view[:, :6].astype(np.int64)
    pids = (head[:, 1] & 0x1F) << 8 | head[:, 2]
    good = (head[:, 0] == SYNC) & (head[:, 1] & 0x80 == 0)
    out.bad_packets += int((~good).sum())
    plain = (head[:, 1] & 0x40 == 0) & (head[:, 3] & 0x30 == 0x10)  # nothing but payload
    counters, flags = head[:, 3] & 15, head[:, 3]
    parts: dict[int, list[bytes]] = {}
    state: dict[int, list] = {}  # pid -> [random access, broken]
    last: dict[int, int] = {}
    previous: dict[int, int] = {}
    tables = _Tables(out)

    def close(pid: int) -> None:
        if pid in parts:
            unit = _pes(pid, b"".join(parts.pop(pid)), *state.pop(pid))
            if unit:
                out.units.append(unit)

    at = 0
    pid_list, good_list, plain_list = pids.tolist(), good.tolist(), plain.tolist()
    # the run of plain packets from i on that follow one another: same pid, counters in step
    follows = np.zeros(whole, bool)
    if whole:
        follows[1:] = plain[1:] & good[1:] & (pids[1:] == pids[:-1]) & (
            counters[1:] == (counters[:-1] + 1 & 15)
        ) & good[:-1] & (flags[:-1] & 0x10 != 0)
    breaks = np.append(np.flatnonzero(~follows), whole)
    while at < whole:
        pid = pid_list[at]
        if not good_list[at] or pid == NULL_PID:
            at += 1
            continue
        packet = stream[at * PACKET : (at + 1) * PACKET]
        begins, has_adaptation, has_payload = packet[1] & 0x40, packet[3] & 0x20, packet[3] & 0x10
        counter, start, random_access, jump = packet[3] & 15, 4, False, False
        if has_adaptation:
            size = packet[4]
            start = 5 + size
            if size:
                jump, random_access = bool(packet[5] & 0x80), bool(packet[5] & 0x40)
                if packet[5] & 0x10 and size >= 7:
                    c = packet[6:12]
                    out.clocks.append((pid, c[0] << 25 | c[1] << 17 | c[2] << 9 | c[3] << 1 | c[4] >> 7))
        if not has_payload:
            at += 1
            continue
        if pid in last and not jump:
            if counter == last[pid]:
                before = previous[pid]
                if stream[before * PACKET : (before + 1) * PACKET] == packet:
                    out.duplicates += 1
                    at += 1
                    continue
            if counter != last[pid] + 1 & 15:
                out.discontinuities += 1
                tables.drop(pid)
                if pid in state:
                    state[pid][1] = True
        last[pid], previous[pid] = counter, at
        data = packet[start:]
        if pid == PAT_PID or pid in out.programs.values():
            tables.add(pid, data, bool(begins))
            at += 1
            continue
        if begins:
            close(pid)
            parts[pid], state[pid] = [data], [random_access, False]
        elif pid in parts:
            parts[pid].append(data)
        end = int(breaks[np.searchsorted(breaks, at, side="right")])
        if end > at + 1:  # the packets that follow in step, at once
            if pid in parts:
                parts[pid].append(view[at + 1 : end, 4:].tobytes())
            last[pid], previous[pid] = int(counters[end - 1]), end - 1
        at = max(end, at + 1)
    for pid in sorted(parts):
        close(pid)
    for pid in list(tables.open):
        tables.drop(pid)
    return out


def padded(text: str) -> tuple[bytes, int]:
    """UTF-8 bytes with zero bytes up to a positive multiple of ``BLOCK``, and their number before."""
    data = text.encode("utf-8", "surrogatepass")
    return data + bytes(-len(data) % BLOCK or (BLOCK if not data else 0)), len(data)


def describe(s: Stream) -> str:
    """Programs, streams, packets, damage, time stamps and random-access points in one line."""
    stamps = [u.pts for u in s.units if u.pts is not None]
    raps = [i for i, u in enumerate(s.units) if u.random_access]
    kinds = ",".join(f"{pid}:{kind}" for pid, (_, kind) in sorted(s.streams.items()))
    return f"programs={len(s.programs)};streams={kinds};packets={s.packets};units={len(s.units)};cc_errors={s.discontinuities};bad={s.bad_tables + s.bad_packets};pts={stamps[0] if stamps else ''}-{stamps[-1] if stamps else ''};rap={'/'.join(map(str, raps))}"


def store_texts(documents: DataFrame) -> DataFrame:
    """doc_id, n_bytes, media: each whole text as a transport stream. Null texts are empty; an empty text is 64 zero bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in sliced(batch.column(1)):
                data = [padded(t) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a), pa.array([n for _, n in data], pa.int64()),
                        pa.array([mux(d) for d, _ in data], pa.binary()),
                    ],
                    ["doc_id", "n_bytes", "media"],
                )

    schema = T.StructType(
        [
            T.StructField("doc_id", documents.schema["doc_id"].dataType), T.StructField("n_bytes", T.LongType()),
            T.StructField("media", T.BinaryType()),
        ]
    )
    return documents.select("doc_id", text_of(documents).alias("text")).mapInArrow(run, schema)


_UNIT = T.StructType(
    [
        T.StructField("pid", T.IntegerType()), T.StructField("stream_id", T.IntegerType()),
        T.StructField("pts", T.LongType()), T.StructField("dts", T.LongType()),
        T.StructField("random_access", T.BooleanType()), T.StructField("broken", T.BooleanType()),
        T.StructField("data", T.BinaryType()),
    ]
)


def parse_streams(media: DataFrame, key: str = "doc_id", column: str = "media") -> DataFrame:
    """The key, damage counts and an array of reassembled units (time stamps, random access, data) of each stream.

    A null stream is an empty one. Rows stay apart whether or not their keys repeat.
    """
    names = ["pid", "stream_id", "pts", "dts", "random_access", "broken", "data"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                s = demux(batch.column(1)[at].as_py() or b"")
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, 1),
                        *(
                            pa.array([n], pa.int64()) for n in (
                                s.packets, s.discontinuities, s.duplicates, s.bad_tables + s.bad_packets,
                            )
                        ),
                        pa.array([[{n: getattr(u, n) for n in names} for u in s.units]], _UNITS),
                    ],
                    ["key", "packets", "discontinuities", "duplicates", "damaged", "units"],
                )

    schema = T.StructType(
        [T.StructField("key", media.schema[key].dataType)] + [
            T.StructField(n, T.LongType()) for n in ("packets", "discontinuities", "duplicates", "damaged")
        ] + [T.StructField("units", T.ArrayType(_UNIT))]
    )
    return media.select(key, column).mapInArrow(run, schema).withColumnRenamed("key", key)


_UNITS = pa.list_(
    pa.struct(
        [
            ("pid", pa.int32()), ("stream_id", pa.int32()), ("pts", pa.int64()), ("dts", pa.int64()),
            ("random_access", pa.bool_()), ("broken", pa.bool_()), ("data", pa.binary()),
        ]
    )
)


def read_digests(media: DataFrame) -> DataFrame:
    """doc_id and what is read from each stored stream (doc_id, n_bytes, media): sizes, hashes, and features."""
    sha = hashlib.sha256

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
        for batch in batches:
            out = []
            for n, stored in zip(batch.column(1).to_pylist(), batch.column(2)):
                stream = stored.as_py()
                found = demux(stream)
                back = found.payload()
                out.append(
                    (
                        n, len(back), sha(back).hexdigest(), zlib.crc32(back[-BLOCK:]), len(stream),
                        sha(stream).hexdigest(), describe(found),
                    )
                )
            if out:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *(pa.array(v, k) for v, k in zip(zip(*out), kinds))], ["doc_id", *_DIGESTS],
                )

    longs = {"n_bytes", "payload_bytes", "tail_crc32", "media_bytes"}
    schema = T.StructType(
        [T.StructField("doc_id", media.schema["doc_id"].dataType)] + [
            T.StructField(n, T.LongType() if n in longs else T.StringType()) for n in _DIGESTS
        ]
    )
    return media.select("doc_id", "n_bytes", "media").mapInArrow(run, schema)


def stored_digests(documents: DataFrame) -> DataFrame:
    """What is read back from each text's stored stream: sizes, hashes, and features.

    The streams are written as a binary column of a table in the shared folder, and everything is computed
    from that table. Null and empty texts give the stream of 64 zero bytes; equal texts give equal values;
    repeated rows give a row each; further columns are not read; an empty table gives no rows. A very long text is one
    stream, which is held whole (about three times the text).
    """
    with settings(documents.sparkSession, {"spark.sql.parquet.compression.codec": "zstd"}):
        return read_digests(staged(store_texts(documents), "media"))


_DIGESTS = ["n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
