"""Token-id files of directly addressable codes.

A segment stores a sequence of ids split into chunks of a few bits. Level 1 has the lowest
chunk of every id, level k the k-th chunk of the ids that need one; each level but the last has
a bitmap that says which ids go on, and a directory of ranks over it, so any id is read by
following its position through the levels, without decoding its neighbours. Chunk widths are
chosen for each segment from the bit lengths of its ids.

Files are Parquet tables of segments, written by Spark's committer (so a lost or repeated task
leaves no torn file, in any store that Spark writes), in ascending order of shard, segment and
document.
"""

from __future__ import annotations

import itertools
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import SPACED, Words, shared_folder, sliced, text_of, word_hashes

MAGIC = b"DAC1"
#: Bits of a bitmap between two entries of its rank directory.
RANK_BLOCK = 512
#: Ids after which a segment is closed at the next end of a document.
SEGMENT = 1 << 20
#: Encoded words that a worker keeps, about 40 bytes each.
MEMORY = 1_500_000
#: The id that ends each document.
END_ID = 1


def widths_for(ids: np.ndarray) -> tuple[int, ...]:
    """The chunk widths, of up to three levels, that store ``ids`` in the fewest bits."""
    bits = np.frexp(ids.astype(np.float64))[1] if len(ids) else np.zeros(1, int)
    counts = np.bincount(np.maximum(bits, 1), minlength=34)
    top = int(np.flatnonzero(counts).max()) if len(ids) else 1
    above = counts[::-1].cumsum()[::-1]  # above[b]: ids of at least b bits
    best, least = (top,), len(ids) * top
    for first, second in itertools.product(range(2, top), range(1, top)):
        done = first + second
        one = len(ids) * (first + 1) + int(above[first + 1]) * (second + (done < top)) + (
            int(above[done + 1]) * (top - done) if done < top else 0
        )
        if done <= top and one < least:
            best, least = (first, second, top - done)[: 2 + (done < top)], one
    return best


def _pack(values: np.ndarray, width: int) -> bytes:
    """Values of ``width`` bits each, most significant bit first, without gaps."""
    if width in (8, 16, 32):
        return values.astype(f">u{width // 8}").tobytes()
    shifts = np.arange(width - 1, -1, -1, dtype=np.uint32)
    return b"".join(np.packbits((values[i : i + 65_536, None] >> shifts & 1).astype(np.uint8)).tobytes() for i in range(0, len(values), 65_536))  # 65,536 values fill whole bytes


def _unpack(data: bytes, width: int, count: int) -> np.ndarray:
    if width in (8, 16, 32):
        return np.frombuffer(data, f">u{width // 8}", count).astype(np.uint32)
    out = np.empty(count, np.uint32)
    for i in range(0, count, 65_536):
        n = min(65_536, count - i)
        raw = np.frombuffer(data, np.uint8, (n * width + 7) // 8, i * width // 8)
        bits = np.unpackbits(raw, count=n * width).reshape(n, width)
        total = np.zeros(n, np.uint32)
        for k in range(width):
            total = total << np.uint32(1) | bits[:, k]
        out[i : i + n] = total
    return out


def encode(ids: np.ndarray, widths: tuple[int, ...] | None = None) -> bytes:
    """A segment: magic, number of levels, then for each level its width and count, and its chunks, bitmap and ranks."""
    ids = np.asarray(ids, np.uint32)
    widths = widths or widths_for(ids)
    if len(ids) and int(ids.max()) >> sum(widths):
        raise ValueError("widths are too small for these ids")
    heads, bodies = [], []
    rest = ids
    for level, width in enumerate(widths):
        heads.append(struct.pack("<BQ", width, len(rest)))
        bodies.append(_pack(rest & np.uint32((1 << width) - 1), width))
        if level < len(widths) - 1:
            more = rest >> np.uint32(width)
            flags = more > 0
            bitmap = np.packbits(flags)
            ones = np.add.reduceat(flags, np.arange(0, len(flags), RANK_BLOCK), dtype=np.int64) if len(flags) else np.zeros(0, np.int64)
            bodies += [bitmap.tobytes(), (np.cumsum(ones) - ones).astype("<u4").tobytes()]
            rest = more[flags]
    return MAGIC + bytes([len(widths)]) + b"".join(heads) + b"".join(bodies)


class Segment:
    """Reads a segment; ``segment[i]`` touches a few bytes of each level."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a segment")
        self.data = data
        levels = data[4]
        at = 5 + 9 * levels
        #: (width, count, first byte of the chunks, of the bitmap, of the ranks)
        self.levels = []
        for k in range(levels):
            width, count = struct.unpack_from("<BQ", data, 5 + 9 * k)
            chunks = at
            at += (count * width + 7) // 8
            bitmap = at
            ranks = bitmap + (count + 7) // 8
            if k < levels - 1:
                at = ranks + 4 * -(-count // RANK_BLOCK)
            self.levels.append((width, count, chunks, bitmap, ranks))

    def __len__(self) -> int:
        return self.levels[0][1]

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < len(self):
            raise IndexError(i)
        value = shift = 0
        for k, (width, _, chunks, bitmap, ranks) in enumerate(self.levels):
            start, end = i * width, (i + 1) * width
            raw = int.from_bytes(self.data[chunks + start // 8 : chunks + (end + 7) // 8], "big")
            value |= (raw >> (-end % 8) & (1 << width) - 1) << shift
            shift += width
            if k == len(self.levels) - 1 or not self.data[bitmap + i // 8] >> (7 - i % 8) & 1:
                return value
            block = i // RANK_BLOCK
            before = self.data[bitmap + block * RANK_BLOCK // 8 : bitmap + i // 8 + 1]
            inside = int.from_bytes(before, "big") >> (8 - i % 8)  # the bits before i
            i = struct.unpack_from("<I", self.data, ranks + 4 * block)[0] + inside.bit_count()
        return value

    def all(self) -> np.ndarray:
        """Every id, level by level."""
        out = None
        for width, count, chunks, bitmap, _ in reversed(self.levels):
            own = _unpack(self.data[chunks : chunks + (count * width + 7) // 8], width, count)
            if out is not None:
                flags = np.unpackbits(np.frombuffer(self.data, np.uint8, (count + 7) // 8, bitmap), count=count).astype(bool)
                own[flags] |= out << np.uint32(width)
            out = own
        return out


class WordEncoder:
    """A tokenizer whose pre-tokenisation drops white space and separates marks from letters and digits,
    applied to each different word once.

    The words of many texts are told apart by 64-bit hashes (two different words share one with probability
    about 2**-64), and the ids of known words are taken from one array, so nothing is done word by word but the
    encoding of new ones. A last stop or comma after an ASCII letter or digit is a pre-token of its own and counts as a
    word; ASCII words are lower-cased, as the normaliser does.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        #: Whether a token ends a word; if none is marked so, words are encoded one by one.
        self.ending = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
        self.ending[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        #: Known words: sorted hashes, where their ids begin in ``flat`` and how many they are, and the last slice that had them.
        self.hashes, self.at, self.count, self.used = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
        self.flat = np.empty(0, np.uint32)
        self.turn = 0
        self.marks = [np.array(self.tokenizer.encode(m, add_special_tokens=False).ids, np.uint32) for m in ".,"]

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def encoded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """An array of ids, and where in it those of each word begin and how many they are. Words of letters alone are
        encoded many in a call, told apart by the tokens that end a word."""
        at, count, parts, size = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64), [_NO_IDS], 0
        letters = np.fromiter(map(str.isalpha, words), bool, len(words))
        alone = np.flatnonzero(~letters).tolist()
        places = np.flatnonzero(letters)
        for start in range(0, len(places), 2_000):
            own = places[start : start + 2_000]
            found = self.tokenizer.encode_batch_fast([" ".join([words[k] for k in own.tolist()])], add_special_tokens=False)
            ids = np.array(found[0].ids, np.uint32)
            ends = np.flatnonzero(self.ending[ids]) + 1
            if len(ends) != len(own):  # a letter that lower-cases to more than letters
                alone += own.tolist()
                continue
            count[own] = np.diff(ends, prepend=0)
            at[own] = size + ends - count[own]
            parts.append(ids)
            size += len(ids)
        for start in range(0, len(alone), 10_000):
            own = alone[start : start + 10_000]
            listed = [x.ids for x in self.tokenizer.encode_batch_fast([words[k] for k in own], add_special_tokens=False)]
            ids = np.fromiter(itertools.chain.from_iterable(listed), np.uint32)
            count[own] = np.fromiter(map(len, listed), np.int64, len(listed))
            at[own] = size + np.cumsum(count[own]) - count[own]
            parts.append(ids)
            size += len(ids)
        return np.concatenate(parts), at, count

    def learn(self, hashes: np.ndarray, words: list[str]) -> None:
        """Encode words with these new hashes (sorted) and keep them; beyond MEMORY words the half unused for longest is forgotten."""
        if len(self.hashes) + len(hashes) > MEMORY and len(self.hashes):
            keep = self.used > np.partition(self.used, len(self.used) // 2)[len(self.used) // 2]
            self.flat = _taken(self.flat, self.at[keep], self.count[keep])
            self.hashes, self.count, self.used = self.hashes[keep], self.count[keep], self.used[keep]
            self.at = np.cumsum(self.count) - self.count
        ids, at, count = self.encoded(words)
        place = np.searchsorted(self.hashes, hashes)
        self.at = np.insert(self.at, place, len(self.flat) + at)
        self.hashes, self.count, self.used = np.insert(self.hashes, place, hashes), np.insert(self.count, place, count), np.insert(self.used, place, self.turn)
        self.flat = np.concatenate([self.flat, ids])

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each hash is or would be, and whether it is known."""
        place = np.searchsorted(self.hashes, hashes)
        known = place < len(self.hashes)
        known[known] = self.hashes[place[known]] == hashes[known]
        return place, known

    def ids(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text, as without special tokens. White space only separates."""
        odd = {k: self.whole(t) for k, t in enumerate(texts) if "<|" in t}  # could hold a special token, in that case only
        flat, ends = self.joined(["" if k in odd else t for k, t in enumerate(texts)])
        for k, end in enumerate(ends[1:].tolist()):
            yield odd[k] if k in odd else flat[ends[k] : end]

    def joined(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and where those of each begin."""
        self.turn += 1
        words = Words(texts, SPACED, " ".join(texts).encode("utf-8", "surrogatepass"))
        raw, starts, ends = words.raw, words.starts, words.ends
        if not len(starts):
            return _NO_IDS, np.zeros(len(texts) + 1, np.int64)
        last, before = raw[ends - 1], raw[np.maximum(ends - 2, 0)] | 0x20
        marked = ((last == 0x2E) | (last == 0x2C)) & (ends - starts > 1) & (
            ((before >= 0x61) & (before <= 0x7A)) | (
                (raw[np.maximum(ends - 2, 0)] >= 0x30) & (raw[np.maximum(ends - 2, 0)] <= 0x39)
            )
        )
        ends = ends - marked
        high = np.concatenate(([0], np.cumsum(raw >= 0x80, dtype=np.int64)))
        ascii_word = high[ends] == high[starts]
        lowered = np.frombuffer(raw.tobytes().lower(), np.uint8)
        if not ascii_word.all():  # the normaliser composes letters before it lower-cases them
            cover = np.zeros(len(raw) + 1, np.int32)
            cover[starts[~ascii_word]] += 1
            cover[ends[~ascii_word]] -= 1
            lowered = np.where(np.cumsum(cover[:-1]) > 0, raw, lowered)
        own, example, which = np.unique(word_hashes(lowered, starts, ends), return_index=True, return_inverse=True)
        place, known = self.find(own)
        if not known.all():
            data = lowered.tobytes()
            new = [data[a:b].decode("utf-8", "surrogatepass") for a, b in zip(starts[example[~known]].tolist(), ends[example[~known]].tolist())]
            self.used[place[known]] = self.turn
            self.learn(own[~known], new)
            place, known = self.find(own)
            if not known.all():  # forgotten just now
                new = [data[a:b].decode("utf-8", "surrogatepass") for a, b in zip(starts[example[~known]].tolist(), ends[example[~known]].tolist())]
                self.learn(own[~known], new)
                place, _ = self.find(own)
        self.used[place] = self.turn
        # each word is two pieces: its ids, and those of its mark or none
        flat = np.concatenate([self.flat, *self.marks])
        base = len(self.flat) + np.cumsum([0, len(self.marks[0])])
        at, count = np.zeros((len(starts), 2), np.int64), np.zeros((len(starts), 2), np.int64)
        at[:, 0], count[:, 0] = self.at[place][which], self.count[place][which]
        mark = (last[marked] == 0x2C).astype(np.int64)
        at[marked, 1], count[marked, 1] = base[mark], np.array([len(m) for m in self.marks])[mark]
        until = np.concatenate(([0], np.cumsum(count.sum(axis=1))))
        return _taken(flat, at.ravel(), count.ravel()), until[words.first]


_NO_IDS = np.empty(0, np.uint32)


def _taken(flat: np.ndarray, at: np.ndarray, count: np.ndarray) -> np.ndarray:
    """flat[at : at + count] of all pieces, one after the other."""
    done = np.cumsum(count)
    return flat[np.repeat(at - (done - count), count) + np.arange(done[-1] if len(done) else 0)]


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def _segments(documents: DataFrame, path: str, end_id: int) -> DataFrame:
    """Segments of the encoded texts: documents in ascending order, dealt out by ranges of doc_id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, shard = encoder(path), TaskContext.get().partitionId()
        docs, sizes, parts = [], [], []
        count = number = before = 0

        def close() -> pa.RecordBatch:
            ids = np.concatenate(parts)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([shard], pa.int32()), pa.array([number], pa.int32()), pa.array([before], pa.int64()),
                    pa.array([len(ids)], pa.int64()), pa.array([docs], pa.list_(pa.int64())),
                    pa.array([sizes], pa.list_(pa.int64())), pa.array([encode(ids)], pa.binary()),
                ],
                _NAMES,
            )

        for batch in batches:
            keys = batch.column(0).to_pylist()
            for a, b, texts in sliced(batch.column(1)):
                for key, ids in zip(keys[a:b], own.ids(texts)):
                    docs.append(key)
                    sizes.append(len(ids) + 1)
                    parts += [ids, np.array([end_id], np.uint32)]
                    count += len(ids) + 1
                    if count >= SEGMENT:
                        yield close()
                        before, number = before + count, number + 1
                        docs, sizes, parts, count = [], [], [], 0
        if docs:
            yield close()

    # equal ids keep one order: by the text's hash, then by the text
    rows = documents.select(
        documents["doc_id"].cast("long").alias("doc_id"), text_of(documents).alias("text"),
    ).withColumn("tie", F.xxhash64("text"))
    return rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text").select("doc_id", "text").mapInArrow(run, _SCHEMA)


_NAMES = ["shard", "segment", "before", "n_ids", "doc_ids", "sizes", "code"]
_SCHEMA = T.StructType(
    [
        T.StructField("shard", T.IntegerType()), T.StructField("segment", T.IntegerType()),
        T.StructField("before", T.LongType()), T.StructField("n_ids", T.LongType()),
        T.StructField("doc_ids", T.ArrayType(T.LongType())), T.StructField("sizes", T.ArrayType(T.LongType())),
        T.StructField("code", T.BinaryType()),
    ]
)


def write_ids(documents: DataFrame, target: str, tokenizer_path: str, end_id: int = END_ID) -> None:
    """Encode every whole text, append ``end_id``, and write the files under ``target``.

    Null and empty texts have the end id only. Rows with a null doc_id come first; rows that share a
    doc_id stand side by side, ordered by their text. The tokenizer file must be readable on every executor.
    """
    _segments(documents, tokenizer_path, end_id).write.parquet(target)


def read_segments(spark: SparkSession, target: str) -> DataFrame:
    """The segments with ``start``, the number of ids in all earlier ones."""
    files = spark.read.schema(_SCHEMA).parquet(target)
    # one total for each writing task
    totals = sorted(files.groupBy("shard").agg(F.sum("n_ids")).collect())
    starts = list(zip([s for s, _ in totals], itertools.accumulate([n for _, n in totals], initial=0)))
    base = spark.createDataFrame(starts, "shard int, base long")
    return files.join(F.broadcast(base), "shard").withColumn("start", F.col("base") + F.col("before")).drop("base")


def read_documents(spark: SparkSession, target: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document, read from the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                start, docs, sizes, code = (batch.column(k)[at].as_py() for k in range(4))
                ids = Segment(code).all().astype("<u4")
                ends = np.cumsum(np.array(sizes, np.int64))
                crc = [zlib.crc32(ids[e - n : e].tobytes()) for e, n in zip(ends.tolist(), sizes)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(docs, pa.int64()), pa.array(start + ends - np.array(sizes), pa.int64()),
                        pa.array(sizes, pa.int64()), pa.array(crc, pa.int64()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return read_segments(spark, target).select("start", "doc_ids", "sizes", "code").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long",
    )


def token_at(spark: SparkSession, target: str, position: int) -> int:
    """The id at a position of the whole sequence, from its one segment."""
    found = read_segments(spark, target).filter(
        (F.col("start") <= position) & (F.col("start") + F.col("n_ids") > position)
    ).select("start", "code").first()
    if found is None:
        raise IndexError(position)
    return Segment(bytes(found.code))[position - found.start]


def stored_digests(documents: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """Write the files of ``documents`` to the shared folder and read every document back."""
    import uuid

    spark = documents.sparkSession
    target = f"{shared_folder(spark)}/corpusmill/ids-{uuid.uuid4().hex}"
    write_ids(documents, target, tokenizer_path, end_id)
    return read_documents(spark, target)
