"""Byte-level BPE with a sentencepiece model serialised straight from a rank file.

Each token of the vocabulary becomes a piece whose characters stand for its bytes (byte b
is the character U+0100 + b), scored by its negative rank, so sentencepiece's merge order
(highest score first, leftmost on ties) is the merge order of the ranks. Normalisation is
the identity. The pre-tokens of a text are encoded one by one; ids decode by the inverse
of the byte mapping.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .shared import sliced, text_of

#: First character of the byte alphabet; 256 assigned letters follow it.
ALPHABET = 0x100
#: Entries of a table of encoded chunks; beyond it the table starts anew.
MEMORY = 400_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and rank of each line of a rank file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value: bytes | str | int | float) -> bytes:
    """One protocol-buffer field: int as varint, float as fixed 32 bits, the rest by length."""
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    value = value.encode() if isinstance(value, str) else value
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def mapped(data: bytes) -> str:
    """Bytes as characters of the alphabet."""
    return data.decode("latin-1").translate(_SHIFT)


_SHIFT = {b: chr(ALPHABET + b) for b in range(256)}
_BACK = {ALPHABET + b: chr(b) for b in range(256)}


def unmapped(piece: str) -> bytes:
    """The inverse of ``mapped``."""
    return piece.translate(_BACK).encode("latin-1")


def model_proto(ranks: dict[bytes, int]) -> bytes:
    """A serialised sentencepiece ModelProto: ids are the ranks; the id after the last is <unk>."""
    order = sorted(ranks, key=ranks.__getitem__)
    if [ranks[t] for t in order] != list(range(len(order))):
        raise ValueError("ranks must be 0 .. n-1 without gaps")
    pieces = b"".join(_field(1, _field(1, mapped(t)) + _field(2, float(-rank))) for rank, t in enumerate(order))
    pieces += _field(1, _field(1, "<unk>") + _field(2, 0.0) + _field(3, 2))
    trainer = _field(3, 2) + _field(4, len(order) + 1) + _field(24, 0) + _field(40, len(order)) + _signed(41) + _signed(42) + _signed(43)
    normalizer = _field(1, "identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return pieces + _field(2, trainer) + _field(3, normalizer)


def _signed(number: int) -> bytes:
    """The value -1: no bos, eos or pad piece."""
    return _varint(number << 3) + _varint((1 << 64) - 1)


class Codec:
    """Encodes and decodes single texts with one rank file."""

    def __init__(self, path: str, pattern: str):
        import sentencepiece

        ranks = read_ranks(path)
        self.ranks = ranks
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model_proto(ranks))
        self.pieces = [unmapped(self.processor.id_to_piece(i)) for i in range(len(ranks))]
        self.pattern = regex.compile(pattern)
        #: Where a run of white space could reach over a cut before a space.
        self.wide = re.compile(r"\s \s|\s \Z")
        #: Encoded chunks: those that follow a space (kept without it), and the others.
        self.spaced: dict[str, tuple[str, int, bytes]] = {}
        self.plain: dict[str, tuple[str, int, bytes]] = {}
        self.tokens: dict[str, list[int]] = {}

    def learn(self, tokens: set[str]) -> None:
        """Encode pre-tokens that aren't known, in one call."""
        rest = []
        for token in tokens:
            whole = self.ranks.get(token.encode("utf-8", "surrogatepass"))  # a whole pre-token of the vocabulary needs no merges
            if whole is None:
                rest.append(token)
            else:
                self.tokens[token] = [whole]
        if rest:
            self.tokens.update(
                zip(
                    rest,
                    self.processor.encode([mapped(t.encode("utf-8", "surrogatepass")) for t in rest], num_threads=1),
                    strict=True,
                )
            )

    def encode(self, text: str) -> list[int]:
        found = self.pattern.findall(text)
        self.learn({t for t in found if t not in self.tokens})
        return [i for t in found for i in self.tokens[t]]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ids))

    def fill(self, table: dict, chunks: set[str], before: str) -> None:
        """Encode the chunks that ``table`` lacks; ``before`` stands before each of them."""
        missing = [c for c in chunks if c not in table]
        split = [self.pattern.findall(before + c) for c in missing]
        self.learn({t for found in split for t in found if t not in self.tokens})
        known = self.tokens
        for chunk, found in zip(missing, split):
            ids = known[found[0]] if len(found) == 1 else [i for t in found for i in known[t]]
            table[chunk] = "".join([f"{i}," for i in ids]), len(ids), self.decode(ids)

    def digests(self, texts: list[str]) -> Iterator[tuple[str, int, bytes]]:
        """For each text its ids as decimal text, their number, and the bytes they decode to.

        A text is cut before each space, where no pre-token can cross (unless a run of white space
        forbids it: then between pre-tokens), and each different chunk is encoded once.
        """
        for table in (self.spaced, self.plain, self.tokens):
            if len(table) >= MEMORY:
                table.clear()
        cut = [None if self.wide.search(t) else t.split(" ") for t in texts]
        plain = {c[0] for c in cut if c}
        whole = [self.pattern.findall(t) if c is None else () for t, c in zip(texts, cut)]
        self.fill(self.plain, plain.union(*whole), "")
        self.fill(self.spaced, set().union(*[c for c in cut if c]), " ")
        spaced, alone = self.spaced, self.plain
        for chunks, tokens in zip(cut, whole):
            if chunks is None:
                found = [alone[t] for t in tokens]
            else:
                found = [spaced[c] for c in chunks]
                found[0] = alone[chunks[0]]
            yield "".join([f[0] for f in found])[:-1], sum([f[1] for f in found]), b"".join([f[2] for f in found])


_codecs: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """One codec for each rank file and worker process."""
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(path, pattern)
    return _codecs[path, pattern]


def encode_documents(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids array<int>, decoded binary: the whole text of each row encoded, then decoded from the ids.

    Null and empty texts have no ids. Repeated rows, repeated ids and null ids give a row each;
    further columns of the input are not read. ``path`` must be readable on every executor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            for a, b, texts in sliced(batch.column(1)):
                ids = [[int(i) for i in listed.split(",") if i] for listed, _, _ in own.digests(texts)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a), pa.array(ids, pa.list_(pa.int32())),
                        pa.array([own.decode(i) for i in ids], pa.binary()),
                    ],
                    ["doc_id", "ids", "decoded"],
                )

    kind = documents.schema["doc_id"].dataType
    schema = T.StructType(
        [
            T.StructField("doc_id", kind), T.StructField("ids", T.ArrayType(T.IntegerType())),
            T.StructField("decoded", T.BinaryType()),
        ]
    )
    return documents.select("doc_id", text_of(documents).alias("text")).mapInArrow(run, schema)


def encode_digests(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, n_bytes of each row, as ``encode_documents`` would give them, without shipping the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, sha = codec(path, pattern), hashlib.sha256
        for batch in batches:
            n, ids, decoded, size = [], [], [], []
            for _, _, texts in sliced(batch.column(1)):
                for listed, count, data in own.digests(texts):
                    n.append(count)
                    ids.append(sha(listed.encode()).hexdigest())
                    decoded.append(sha(data).hexdigest())
                    size.append(len(data))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()),
                    pa.array(decoded, pa.string()), pa.array(size, pa.int64()),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_bytes"],
            )

    kind = documents.schema["doc_id"].dataType
    schema = T.StructType(
        [
            T.StructField("doc_id", kind), T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType()),
            T.StructField("n_bytes", T.LongType()),
        ]
    )
    return documents.select("doc_id", text_of(documents).alias("text")).mapInArrow(run, schema)
