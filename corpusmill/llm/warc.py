"""WARC archives whose records are compressed one by one with a Zstandard dictionary of their own kind.

An archive begins with a skippable frame that holds the dictionary; after it comes one frame for each record, so a
record can be read by its offset alone once the dictionary is known. The dictionary is trained on a bounded sample of
the records. A page whose payload another page has too becomes a revisit record, which names that page instead of
storing the payload again.

Tasks write their archives beside each other in the shared folder, under names of their own, and return the names;
the table of these names is what commits them. An archive of a task that was lost or repeated is in no such table.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from typing import BinaryIO, NamedTuple

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import Scratch, discard_later, shared_folder, staged

#: Records that the dictionary is trained on at most, the payload bytes of the longest of them, and its size.
SAMPLE_ROWS, SAMPLE_BYTES, DICTIONARY_BYTES = 1_000, 1 << 15, 1 << 16
#: Compressed bytes from which on a task begins its next archive.
ARCHIVE_BYTES = 128 << 20
LEVEL = 6
#: Bytes read from an archive at once, and payload bytes of the records that are handed on together.
READ_BYTES, BATCH_BYTES = 1 << 20, 1 << 22

#: Fixed values of the format: magic numbers of the dictionary's frame and of a dictionary, version, revisit profile.
DICTIONARY_FRAME, DICTIONARY_MAGIC, FRAME_MAGIC = 0x184D2A5D, 0xEC30A437, 0xFD2FB528
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_SPACE = uuid.UUID("6f1d0a52-54d4-4c3e-9d0c-6a5a2f0f6d11")


def digest_of(payload: bytes) -> str:
    """Base32 SHA-1, as in WARC-Payload-Digest but without its ``sha1:``."""
    return base64.b32encode(hashlib.sha1(payload, usedforsecurity=False).digest()).decode()


def _record_id(*parts: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, ' '.join(map(str, parts)))}>"


def header_value(text: str) -> str:
    """A value that fits one header line: controls and spaces are percent-encoded, the rest stays as it is."""
    if text.isprintable() and " " not in text:
        return text
    return "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode("utf-8", "surrogatepass")) for c in text)


def record(kind: str, fields: dict[str, object], block: bytes) -> bytes:
    """One WARC record; fields of the value None are left out."""
    lines = [f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in fields.items() if v is not None), f"Content-Length: {len(block)}"]
    return b"".join([VERSION, b"\r\n", "\r\n".join(lines).encode("utf-8", "surrogatepass"), b"\r\n\r\n", block, b"\r\n\r\n"])


def page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str, place: str) -> bytes:
    """A response with the payload or, with ``refers_to``, a revisit with the HTTP head alone."""
    digest = digest_of(payload)
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    fields = {
        "WARC-Record-ID": _record_id(place), "WARC-Date": date,
        "WARC-Target-URI": header_value(url) if url else "about:invalid",
        "WARC-Payload-Digest": f"sha1:{digest}", "Content-Type": "application/http;msgtype=response", "X-Page-ID": page_id,
    }
    if refers_to is None:
        return record("response", fields, head + payload)
    return record("revisit", fields | {"WARC-Profile": REVISIT_PROFILE, "X-Refers-To-Page-ID": refers_to}, head)


class Record(NamedTuple):
    kind: str
    fields: dict[str, str]
    block: bytes

    @classmethod
    def of(cls, data: bytes) -> Record:
        """A record from its bytes; ValueError if they are no record."""
        head, gap, rest = data.partition(b"\r\n\r\n")
        first, *lines = head.decode("utf-8", "surrogatepass").split("\r\n")
        if not gap or not first.startswith("WARC/"):
            raise ValueError("no WARC record")
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        length = int(fields.get("content-length", -1))
        if length < 0 or rest[length:] != b"\r\n\r\n":
            raise ValueError("a WARC record of another length than it says")
        return cls(fields.get("warc-type", ""), fields, rest[:length])

    def payload(self) -> tuple[dict[str, str], bytes]:
        """The HTTP header fields of the block and what follows them."""
        head, _, body = self.block.partition(b"\r\n\r\n")
        return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode("latin-1").split("\r\n")[1:])}, body


def dictionary_of(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A Zstandard dictionary trained on the samples; empty where they are too few or too much alike to train on."""
    if sum(map(len, samples)) < 4 * size:
        size = max(256, sum(map(len, samples)) // 16)
    try:
        return zstandard.train_dictionary(size, samples, level=LEVEL).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def dictionary_frame(dictionary: bytes) -> bytes:
    """The skippable frame that an archive begins with; nothing without a dictionary."""
    if not dictionary:
        return b""
    packed = zstandard.ZstdCompressor(level=19).compress(dictionary)
    return struct.pack("<II", DICTIONARY_FRAME, len(packed)) + packed


def _known(dictionary: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(dictionary) if dictionary else None


class Archives:
    """Writes records to archives in a folder, the next one whenever ARCHIVE_BYTES are reached; ``written`` names those that are whole."""

    def __init__(self, folder: str, prefix: str, dictionary: bytes, date: str, roll: int):
        self.files, self.folder = fs.FileSystem.from_uri(folder)  # streams are told not to compress what they find named .zst
        self.prefix, self.date, self.roll, self.dictionary = prefix, date, roll, dictionary
        self.packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=_known(dictionary), write_checksum=True)
        self.out, self.written = None, []

    def place(self) -> str:
        """What names the next record."""
        if self.out is None:
            self.name, self.size, self.records = f"{self.prefix}-{len(self.written):04d}.warc.zst", 0, 0
            self.out = self.files.open_output_stream(f"{self.folder}/{self.name}", compression=None)
            self._put(dictionary_frame(self.dictionary))
            info = b"software: corpusmill\r\nformat: WARC File Format 1.1\r\n"
            self._put(self.packer.compress(record("warcinfo", {
                "WARC-Record-ID": _record_id(self.name), "WARC-Date": self.date, "WARC-Filename": self.name, "Content-Type": "application/warc-fields",
            }, info)))
        return f"{self.name} {self.records}"

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def add(self, data: bytes) -> None:
        self.place()
        self._put(self.packer.compress(data))
        self.records += 1
        if self.size >= self.roll:
            self.close()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None
            self.written.append((self.name, self.records, self.size))


def frames(stream: BinaryIO) -> Iterator[tuple[int, int, bytes]]:
    """Offset, length and content of each compressed frame of an archive; only one of them is held at a time."""
    data, at, reader = stream.read(READ_BYTES), 0, zstandard.ZstdDecompressor()
    while len(data) >= 8 or data:
        magic = struct.unpack_from("<I", data)[0] if len(data) >= 4 else 0
        if magic & 0xFFFFFFF0 == 0x184D2A50:  # skippable
            length = 8 + struct.unpack_from("<I", data, 4)[0]
            while len(data) < length and (more := stream.read(READ_BYTES)):
                data += more
            if len(data) < length:
                raise ValueError("the archive ends within a frame")
            if magic == DICTIONARY_FRAME and at == 0:
                reader = zstandard.ZstdDecompressor(dict_data=_known(unpacked_dictionary(data[8:length])))
        else:
            one, parts, length = reader.decompressobj(), [], 0
            while True:
                parts.append(one.decompress(data))
                if one.eof:
                    length += len(data) - len(one.unused_data)
                    break
                length += len(data)
                data = stream.read(READ_BYTES)
                if not data:
                    raise ValueError("the archive ends within a record")
            yield at, length, b"".join(parts)
            data, at = one.unused_data, at + length
            if len(data) < 8:
                data += stream.read(READ_BYTES)
            continue
        data, at = data[length:], at + length
        if len(data) < 8:
            data += stream.read(READ_BYTES)


def unpacked_dictionary(content: bytes) -> bytes:
    """The dictionary in a leading frame, which holds it as it is or compressed."""
    magic = struct.unpack_from("<I", content)[0]
    if magic not in (DICTIONARY_MAGIC, FRAME_MAGIC):
        raise ValueError("no dictionary in the leading frame")
    return content if magic == DICTIONARY_MAGIC else zstandard.ZstdDecompressor().decompress(content, max_output_size=1 << 30)


def record_at(uri: str, offset: int, length: int) -> Record:
    """One record by its place, without reading those before it."""
    files, path = fs.FileSystem.from_uri(uri)
    with files.open_input_file(path) as file:
        magic, size = struct.unpack("<II", file.read_at(8, 0))
        reader = zstandard.ZstdDecompressor(dict_data=_known(unpacked_dictionary(file.read_at(size, 8))) if magic == DICTIONARY_FRAME else None)
        return Record.of(reader.decompressobj().decompress(file.read_at(length, offset)))


def _payload(pages: DataFrame) -> Column:
    return F.coalesce(pages["html"].cast("string"), F.lit("")).cast("binary")


def _rows(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, n (its bytes), sha (SHA-256) of each page."""
    rows = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"), _payload(pages).alias("payload"))
    return rows.withColumn("n", F.octet_length("payload").cast("long")).withColumn("sha", F.unhex(F.sha2("payload", 256)))


def sample_dictionary(rows: DataFrame, groups: DataFrame) -> bytes:
    """A dictionary from at most SAMPLE_ROWS records of different payloads, those of the least hash, none longer than SAMPLE_BYTES."""
    fits = F.col("n").between(1, SAMPLE_BYTES)
    chosen = groups.filter(fits).select("sha").distinct().orderBy(F.xxhash64("sha"), "sha").limit(SAMPLE_ROWS)
    found = rows.filter(fits).join(F.broadcast(chosen), "sha").dropDuplicates(["sha"]).select("page_id", "url", "payload")
    return dictionary_of([page_record(r.page_id, r.url, bytes(r.payload), None, "1970-01-01T00:00:00Z", "sample") for r in sorted(found.collect(), key=lambda r: r.payload)])


def write_archives(pages: DataFrame, least: int = 0, date: str = "1970-01-01T00:00:00Z", folder: str | None = None) -> DataFrame:
    """Write a record for each row of ``pages`` and return the table of archives: file (URI), records, bytes.

    Of rows with equal payloads of at least ``least`` bytes that with the largest page_id gives a response and the
    others revisit it; shorter payloads are all responses. Rows that repeat the largest page_id are responses too. A null
    html is empty. A null page_id counts as less than any other; where a payload has no other, all its rows are responses.
    A null or empty url is written as about:invalid; controls and spaces of a url are percent-encoded. An empty table
    gives no archive. Further columns are not read. ``date`` is the records' WARC-Date, a parameter so that a repeated task
    writes the same records. Archives go to ``folder`` (a URI that pyarrow and Spark both reach), by default to a folder
    of their own in the shared one, which is deleted with the driver's process. Equal payloads are told by SHA-256 and length. A hot payload is aggregated before it is
    shuffled, and the join that follows is one whose large partitions Spark can split.
    """
    spark = pages.sparkSession
    own = folder is None
    folder = folder or f"{shared_folder(spark)}/corpusmill/warc-{uuid.uuid4().hex}"
    rows = _rows(pages)
    with Scratch("warc") as stage:
        groups = stage(rows.groupBy("sha", "n").agg(F.max("page_id").alias("largest"), F.count("*").alias("copies")), "groups")
        dictionary = sample_dictionary(rows, groups)
        shared = groups.filter((F.col("copies") > 1) & (F.col("n") >= least)).select("sha", "n", "largest")
        refers = F.when(F.col("largest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("largest")), F.col("largest"))
        todo = rows.join(shared, ["sha", "n"], "left").select("page_id", "url", "payload", refers.alias("refers_to"))
        roll, folder = ARCHIVE_BYTES, _made(spark, folder)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            task = TaskContext.get()
            out = Archives(folder, f"pages-{task.partitionId():06d}-{uuid.uuid4().hex[:12]}", dictionary, date, roll)
            for batch in batches:
                for row in zip(*(_values(c) for c in batch.columns)):
                    out.add(page_record(*row, date, out.place()))
            out.close()
            names, records, sizes = zip(*out.written) if out.written else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{n}" for n in names], pa.string()), pa.array(records, pa.int64()), pa.array(sizes, pa.int64())], ["file", "records", "bytes"])

        archives = staged(todo.mapInArrow(run, "file string, records long, bytes long"), "warc-archives")
    if own:
        discard_later(folder)
    return archives


def _values(column: pa.Array) -> Iterator[object]:
    return (x.as_py() for x in column)


def _made(spark: SparkSession, folder: str) -> str:
    """Make the folder; its URI with the store that the cluster takes it to be in."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(path)
    scheme, rest = store.makeQualified(path).toString().split(":", 1)
    return f"{scheme}:{rest if rest.startswith('//') else '//' + rest}"


_READ = "file string, offset long, length long, record_type string, page_id long, url string, payload_bytes long, payload_digest string, refers_to long"


def read_archives(archives: DataFrame, payloads: bool = False) -> DataFrame:
    """The page records of the archives in ``archives`` (file), an archive a task: file, offset, length, record_type, page_id, url, payload_bytes, payload_digest, refers_to.

    The digest of a response is computed from the payload that was read, and must be the one that its header names; that
    and the size of a revisit's full payload come from its header. With ``payloads`` the payload follows, null for revisits.
    A damaged archive is an error.
    """
    names = [c.split(" ")[0] for c in _READ.split(", ")] + ["payload"] * payloads

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                held, size = [], 0
                files, path = fs.FileSystem.from_uri(uri)
                with files.open_input_stream(path, compression=None) as stream:
                    for offset, length, data in frames(stream):
                        one = Record.of(data)
                        if one.kind not in ("response", "revisit"):
                            continue
                        held.append((uri, offset, length, *_page(one), *([one.payload()[1] if one.kind == "response" else None] * payloads)))
                        size += len(data)
                        if size >= BATCH_BYTES:
                            yield _batch(held, names)
                            held, size = [], 0
                yield _batch(held, names)

    listed = archives.select("file")
    count = archives.count()
    return listed.repartition(max(1, count)).mapInArrow(run, _READ + ", payload binary" * payloads)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    types = [kinds[c.split(" ")[1]] for c in _READ.split(", ")] + [pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], types[k]) for k in range(len(names))], names)


def _page(one: Record) -> tuple[str, int | None, str | None, int, str, int | None]:
    number = lambda name: int(one.fields[name]) if name in one.fields else None
    head, body = one.payload()
    named = one.fields.get("warc-payload-digest", "").removeprefix("sha1:")
    if one.kind == "response" and digest_of(body) != named:
        raise ValueError("a payload differs from its digest")
    size = len(body) if one.kind == "response" else int(head.get("content-length", 0))
    return one.kind, number("x-page-id"), one.fields.get("warc-target-uri"), size, named, number("x-refers-to-page-id")


def stored_digests(pages: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of each row of ``pages``, from archives written and read back (see ``write_archives``)."""
    return read_archives(write_archives(pages)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: ``stored_digests`` for DuckDB; base 32 by five hexadecimal digits at a time.
ORACLE_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
g AS (SELECT h, max(page_id) AS largest FROM p GROUP BY h),
d AS (SELECT page_id, strlen(p.h)::BIGINT AS payload_bytes, sha1(p.h) AS x, CASE WHEN page_id IS DISTINCT FROM largest THEN largest END AS refers_to FROM p JOIN g ON p.h = g.h),
v AS (SELECT *, list_transform(range(0, 32), lambda i: (('0x' || substr(x, (5 * (i // 4) + 1)::INT, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31) AS v FROM d)
SELECT page_id, payload_bytes, array_to_string(list_transform(v, lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (k + 1)::INT, 1)), '') AS payload_digest,
CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to FROM v
"""
