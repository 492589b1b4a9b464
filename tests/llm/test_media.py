import hashlib
import zlib

import pytest
from corpusmill.llm import media
from corpusmill.llm.queries import table
from hypothesis import given, settings
from hypothesis import strategies as st


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=600), st.integers(0, 200))
def test_round_trip(data, times):
    payload = data * times
    found = media.demux(media.mux(payload))
    assert found.payload() == payload
    assert (found.discontinuities, found.duplicates, found.bad_tables, found.bad_packets) == (0, 0, 0, 0)
    assert found.programs == {1: media.PMT_PID} and found.streams == {media.ES_PID: (1, media.PRIVATE_TYPE)}
    assert [u.pts for u in found.units] == [(k + 1) * media.TICKS for k in range(len(found.units))]
    assert [u.random_access for u in found.units] == [k % media.RAP_EVERY == 0 for k in range(len(found.units))]


def test_packets_are_whole_and_tables_carry_a_crc():
    stream = media.mux(b"x" * 100_000)
    assert len(stream) % 188 == 0 and set(stream[::188]) == {0x47}
    assert media.crc32_mpeg(b"123456789") == 0x0376E6E7


def test_lost_repeated_and_damaged_packets_are_counted():
    packets = [media.mux(b"y" * 50_000)[i : i + 188] for i in range(0, len(media.mux(b"y" * 50_000)), 188)]
    lost = media.demux(b"".join(packets[:10] + packets[11:]))
    assert lost.discontinuities == 1 and [u.broken for u in lost.units] == [True, False, False, False]
    twice = media.demux(b"".join(packets[:10] + [packets[9]] + packets[10:]))
    assert twice.duplicates == 1 and twice.payload() == b"y" * 50_000 and twice.discontinuities == 0
    table_hurt = bytearray(packets[0])
    table_hurt[10] ^= 1
    assert media.demux(bytes(table_hurt) + b"".join(packets[1:])).bad_tables == 1
    assert media.demux(b"".join(packets)[:-7]).bad_packets == 1
    assert media.demux(b"").units == []


def expected(text):
    data = (text or "").encode()
    pad = data + bytes((64 - len(data) % 64) % 64 if data else 64)
    return len(data), len(pad), hashlib.sha256(pad).hexdigest(), zlib.crc32(pad[-64:])


def test_query_values_against_the_definition(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame([(-1, None), (-2, ""), (-3, "a" * 64), (-3, "a" * 64), (None, "é" * 40_000)], docs.schema)).selectExpr("*", "1 as feature")
    out = {(r.doc_id, r.payload_sha256): r for r in media.stored_digests(docs).collect()}
    for r in docs.collect():
        e = expected(r.text)
        got = out[r.doc_id, e[2]]
        assert (got.n_bytes, got.payload_bytes, got.payload_sha256, got.tail_crc32) == e
        assert got.media_sha256 == hashlib.sha256(media.mux(media.padded(r.text or "")[0])).hexdigest()
    assert media.stored_digests(docs.limit(0)).count() == 0


def test_stored_column_and_parsed_units(spark):
    docs = spark.createDataFrame([(1, "abc"), (2, None)], "doc_id long, text string")
    parsed = {r.doc_id: r for r in media.parse_streams(media.store_texts(docs)).collect()}
    assert bytes(parsed[1].units[0].data) == b"abc" + bytes(61) and parsed[1].units[0].pts == media.TICKS
    assert bytes(parsed[2].units[0].data) == bytes(64)
    assert media.parse_streams(spark.createDataFrame([(1, None)], "doc_id long, media binary")).first().units == []


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 16_384, 16_385])
def test_padding(n):
    data, size = media.padded("a" * n)
    assert size == n and len(data) % 64 == 0 and len(data) >= max(64, n) and len(data) < n + 65


def section(table_id, ident, body):
    """A program table's section, by the standard's layout."""
    length = 5 + len(body) + 4
    head = bytes([table_id, 0xB0 | length >> 8, length & 0xFF, ident >> 8, ident & 0xFF, 0xC1, 0, 0]) + body
    crc = 0xFFFFFFFF
    for byte in head:
        for bit in range(7, -1, -1):
            top = crc >> 31 ^ byte >> bit & 1
            crc = (crc << 1 & 0xFFFFFFFF) ^ (0x04C11DB7 if top else 0)
    return head + crc.to_bytes(4, "big")


def packets(pid, payload, counter=0, pointer=True):
    """Packets of 188 bytes that carry sections: the first has a pointer field, the last is filled up with 0xFF."""
    data = (b"\x00" if pointer else b"") + payload
    out = b""
    for k, at in enumerate(range(0, len(data), 184)):
        part = data[at : at + 184]
        out += bytes([0x47, (0x40 if k == 0 and pointer else 0) | pid >> 8, pid & 0xFF, 0x10 | counter + k & 15]) + part + b"\xff" * (184 - len(part))
    return out


def test_tables_that_span_packets():
    """Hand-made streams: a table of 60 streams over two packets, two sections in one packet, and a section that never ends."""
    pat = section(0, 1, bytes([0, 7, 0xE1, 0x00]))
    pids = [0x200 + i for i in range(60)]
    body = bytes([0xE2, 0x00, 0xF0, 0]) + b"".join(bytes([0x1B if i % 2 else 0x0F, 0xE0 | p >> 8, p & 0xFF, 0xF0, 0]) for i, p in enumerate(pids))
    pmt = section(2, 7, body)
    assert len(pmt) > 184
    pes = b"\x00\x00\x01\xe0\x00\x00\x80\x00\x00" + b"v" * 175  # unbounded packet without time stamp
    es = bytes([0x47, 0x42, 0x00, 0x10]) + pes
    whole = media.demux(packets(0, pat) + packets(0x100, pmt) + es)
    assert whole.programs == {7: 0x100} and whole.bad_tables == 0
    assert whole.streams == {p: (7, 0x1B if i % 2 else 0x0F) for i, p in enumerate(pids)}
    assert whole.payload() == b"v" * 175 and whole.units[0].pts is None
    # the next section begins where the pointer says, after the end of the one before
    first, rest = pmt[:183], pmt[183:]
    second = section(2, 8, bytes([0xE3, 0x00, 0xF0, 0, 0x06, 0xE3, 0x01, 0xF0, 0]))
    shared = bytes([len(rest)]) + rest + second
    stream = packets(0, pat) + packets(0x100, first) + bytes([0x47, 0x41, 0x00, 0x11]) + shared + b"\xff" * (184 - len(shared))
    both = media.demux(stream)
    assert both.streams[0x301] == (8, 6) and len(both.streams) == 61 and both.bad_tables == 0
    # its second packet is lost: nothing of the table is taken, and it counts as bad
    cut = media.demux(packets(0, pat) + packets(0x100, pmt)[:188] + es)
    assert cut.streams == {} and cut.bad_tables == 1
    jumped = media.demux(packets(0, pat) + packets(0x100, pmt)[:188] + packets(0x100, pmt, counter=3)[188:] + es)
    assert jumped.streams == {} and jumped.bad_tables == 1 and jumped.discontinuities == 1


def test_digests_come_from_what_is_stored(spark):
    docs = spark.createDataFrame([(1, "abc" * 9_000), (2, None)], "doc_id long, text string")
    stored = media.store_texts(docs).collect()
    stream = bytearray(next(bytes(r.media) for r in stored if r.doc_id == 1))
    stream[188 * 30 + 50] ^= 0xFF  # one payload byte of the stored form
    table = spark.createDataFrame([(1, 27_000, bytes(stream))], "doc_id long, n_bytes long, media binary")
    hurt = media.read_digests(table).first()
    whole = {r.doc_id: r for r in media.stored_digests(docs).collect()}
    assert hurt.media_sha256 == hashlib.sha256(stream).hexdigest() != whole[1].media_sha256
    assert hurt.payload_sha256 != whole[1].payload_sha256
    # the feature line, from the definition: 27,000 bytes padded to 27,008 are two units, each a private stream's packet
    n = [-(-(14 + 16_384 + 8) // 184), -(-(14 + 27_008 - 16_384 + 8) // 184)]
    assert whole[1].feature == f"programs=1;streams=256:6;packets={2 + sum(n)};units=2;cc_errors=0;bad=0;pts=3600-7200;rap=0"
