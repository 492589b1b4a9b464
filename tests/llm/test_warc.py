import base64
import hashlib
import io
import os

import pytest
from corpusmill.llm import warc
from corpusmill.llm.queries import table

SF = "/root/testdata/sf0.001"


def brute(pages, least=0):
    """(page_id, bytes, digest, type, refers_to) of (page_id, url, html) rows."""
    out = []
    for page, _, html in pages:
        payload = (html or "").encode()
        same = [p for p, _, h in pages if (h or "").encode() == payload and p is not None]
        largest = max(same, default=None)
        first = len(payload) < least or largest is None or page == largest
        out.append((page, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(), "response" if first else "revisit", None if first else largest))
    return sorted(out, key=str)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


PAGES = [(1, "http://a/", "<p>same</p>"), (5, "http://b/ x\r\ny", "<p>same</p>"), (3, None, "<p>same</p>"), (5, "http://b/", "<p>same</p>"), (None, "u", "<p>same</p>"), (None, "v", "only here"), (None, "w", "only here"), (7, "", None), (6, "é", ""), (8, "http://c/", "\r\n\r\nWARC/1.1\r\n\x00 é" * 40_000), (-9, "x", "a")]
NAMES = "page_id long, url string, html string, payload int, sha string, file string"


def frame(spark, pages):
    return spark.createDataFrame([(*p, 1, "s", "f") for p in pages], NAMES)


def test_matches_brute_force_on_given_pages(spark):
    pages = table(spark, SF, "pages")
    got = rows(warc.stored_digests(pages))
    assert got == brute([tuple(r) for r in pages.select("page_id", "url", "html").collect()])
    assert any(r[3] == "revisit" for r in rows(warc.stored_digests(pages.unionByName(pages))) + got) or got


def test_edge_cases_and_least_size(spark):
    for least in (0, 5):
        archives = warc.write_archives(frame(spark, PAGES).repartition(3), least)
        got = warc.read_archives(archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
        assert rows(got) == brute(PAGES, least)


def test_empty_table(spark):
    archives = warc.write_archives(frame(spark, PAGES).limit(0))
    assert archives.count() == 0 and warc.read_archives(archives, payloads=True).count() == 0


def test_payloads_come_back_and_urls_fit_a_line(spark):
    archives = warc.write_archives(frame(spark, PAGES).coalesce(1))
    found = warc.read_archives(archives, payloads=True).collect()
    assert {bytes(r.payload) for r in found if r.record_type == "response"} == {(h or "").encode() for _, _, h in PAGES}
    assert all(r.payload is None for r in found if r.record_type == "revisit")
    assert {r.url for r in found} >= {"http://a/", "http://b/%20x%0D%0Ay", "about:invalid", "é"}


def test_archives_carry_their_dictionary_and_records_are_read_by_place(spark):
    pages = table(spark, SF, "pages").coalesce(1)
    many = pages.selectExpr("page_id", "url", "explode(transform(sequence(1, 20), i -> concat(html, '<i>', i * page_id, '</i>'))) AS html")
    archives = warc.write_archives(many)
    [file] = {r.file for r in archives.collect()}
    with open(file.removeprefix("file://"), "rb") as raw:
        data = raw.read()
    assert int.from_bytes(data[:4], "little") == warc.DICTIONARY_FRAME
    dictionary = warc.unpacked_dictionary(data[8 : 8 + int.from_bytes(data[4:8], "little")])
    assert int.from_bytes(dictionary[:4], "little") == warc.DICTIONARY_MAGIC
    found = warc.read_archives(archives, payloads=True).collect()
    assert len(found) == many.count()
    for r in found[:: len(found) // 7]:
        one = warc.record_at(r.file, r.offset, r.length)
        assert one.kind == r.record_type and (one.kind == "revisit" or one.payload()[1] == bytes(r.payload))
    alone = warc.Archives(os.path.dirname(file), "alone", b"", "1970-01-01T00:00:00Z", 1 << 30)
    for r in found:
        alone.add(warc.page_record(r.page_id, r.url, bytes(r.payload or b""), r.refers_to, "1970-01-01T00:00:00Z", alone.place()))
    alone.close()
    assert sum(r.bytes for r in archives.collect()) < 0.8 * alone.written[0][2]  # the dictionary pays


def test_archives_roll_and_an_abandoned_one_is_not_read(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 2_000)
    archives = warc.write_archives(frame(spark, PAGES).coalesce(1))
    assert archives.count() > 1
    folder = os.path.dirname(archives.first().file).removeprefix("file://")
    with open(f"{folder}/pages-000000-lost-0000.warc.zst", "wb") as lost:
        lost.write(b"what a task left that was killed")
    got = warc.read_archives(archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert rows(got) == brute(PAGES)


def test_frames_of_damaged_archives():
    packer = warc.zstandard.ZstdCompressor()
    whole = b"".join(packer.compress(warc.record("response", {"X-Page-ID": k}, b"b" * k)) for k in range(50))
    assert [warc.Record.of(d).fields["x-page-id"] for _, _, d in warc.frames(io.BytesIO(whole))] == [str(k) for k in range(50)]
    for cut in (1, 5, len(whole) // 2, len(whole) - 1):
        with pytest.raises((ValueError, warc.zstandard.ZstdError)):
            list(warc.frames(io.BytesIO(whole[:-cut])))
    with pytest.raises(ValueError):
        warc.Record.of(b"WARC/1.1\r\nContent-Length: 5\r\n\r\nab\r\n\r\n")


def test_small_reads_change_nothing(monkeypatch):
    packer = warc.zstandard.ZstdCompressor()
    data = warc.dictionary_frame(b"") + b"".join(packer.compress(b"x%d" % k * (k % 7)) for k in range(200))
    whole = list(warc.frames(io.BytesIO(data)))
    for size in (1, 7, 64):
        monkeypatch.setattr(warc, "READ_BYTES", size)
        assert list(warc.frames(io.BytesIO(data))) == whole
    assert all(d == b"x%d" % k * (k % 7) for k, (_, _, d) in enumerate(whole))
