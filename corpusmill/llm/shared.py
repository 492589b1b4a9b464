"""What the operators of this subpackage share: staged tables and word hashing."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import Scratch, discard, discard_later, settings, shared_folder, staged

__all__ = ["Scratch", "discard", "discard_later", "settings", "shared_folder", "staged"]

#: Bytes of text that one vectorised step takes at once (a longer document is taken alone).
SLICE_BYTES = 1 << 20
#: Bytes whose words are hashed at once, and bytes from which on a word is hashed by itself.
CHUNK_BYTES, LONG_WORD = 1 << 17, 256


#: For jobs that hand whole texts to Python: fewer rows in an Arrow batch, which the JVM, the worker and what lies between hold at once.
SMALL_BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}


def text_of(df: DataFrame, column: str = "text"):
    """The text column with null read as the empty string."""
    return F.coalesce(df[column].cast("string"), F.lit(""))


def sliced(texts: pa.Array, budget: int = SLICE_BYTES) -> Iterator[tuple[int, int, list[str | None]]]:
    """Ranges of an Arrow array of about ``budget`` bytes each with their texts; only one range is held as Python strings at a time."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
    start = 0
    while start < len(texts):
        done = int(ends[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + budget, side="right")))
        yield start, stop, texts.slice(start, stop - start).to_pylist()
        start = stop


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift-multiply), vectorised."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=None)
def _byte_values() -> np.ndarray:
    return np.random.default_rng(20_240_501).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


@lru_cache(maxsize=4)
def _powers(base: int, count: int) -> np.ndarray:
    out = np.empty(count, np.uint64)
    out[0] = 1
    done = 1
    while done < count:  # doubling: base^(k+done) = base^k * base^done
        step = min(done, count - done)
        out[done : done + step] = out[:step] * np.uint64(pow(base, done, 1 << 64))
        done += step
    return out


def word_table(is_separator: bytes) -> np.ndarray:
    """A 256-entry table: true for bytes that belong to words."""
    table = np.ones(256, bool)
    table[list(is_separator)] = False
    return table


#: ASCII white space separates: space and 0x09-0x0D.
SPACED = word_table(bytes([0x20, *range(0x09, 0x0E)]))
#: Words are ASCII letters and digits and everything beyond ASCII.
ALNUM = word_table(bytes(b for b in range(128) if not chr(b).isalnum()))


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of raw[start:end] for each word; words lie in ascending order.

    Short words are hashed by one polynomial over chunks of the text, so that memory and powers stay small.
    A polynomial modulo 2**64 has collisions by construction between long strings (of 2,048 letters, say),
    so words of LONG_WORD bytes and more are hashed one by one with another function.
    """
    out = np.empty(len(starts), np.uint64)
    length = ends - starts
    at = 0
    while at < len(starts):
        first = int(starts[at])
        last = max(at + 1, int(np.searchsorted(ends, first + CHUNK_BYTES, side="right")))
        own = slice(at, last)
        if last - at > 1 or length[at] < LONG_WORD:
            piece = raw[first : int(ends[last - 1])]
            prefix = np.zeros(len(piece) + 1, np.uint64)
            np.cumsum(_byte_values()[piece] * _powers(_BASE, CHUNK_BYTES + 1)[: len(piece)], out=prefix[1:])
            begin = starts[own] - first
            out[own] = mix(
                (
                    prefix[ends[own] - first] - prefix[begin]
                ) * _powers(_BASE_INVERSE, CHUNK_BYTES + 1)[begin] + length[own].astype(np.uint64)
            )
        at = last
    for k in np.flatnonzero(length >= LONG_WORD).tolist():
        out[k] = xxhash.xxh3_64_intdigest(raw[starts[k] : ends[k]], seed=77)
    return out


class Words:
    """The words of a list of texts, ASCII lower-cased, with a 64-bit hash each.

    ``first[d] .. first[d + 1]`` are the words of text d; ``starts``/``ends`` are byte
    positions in ``data``. Two equal words have equal hashes; hashes of different words
    collide with probability about 2**-64 a pair. Memory is about four bytes for each byte of text
    and 32 for each word, beside the texts themselves.
    """

    def __init__(self, texts: list[str], table: np.ndarray, data: bytes | None = None):
        """``data`` is given by a caller who does the hashing: the texts joined by spaces, case kept."""
        self.data = " ".join(texts).encode("utf-8", "surrogatepass").lower() if data is None else data
        raw = self.raw = np.frombuffer(self.data, np.uint8)
        sizes = np.fromiter((len(t) if t.isascii() else len(t.encode("utf-8", "surrogatepass")) for t in texts), np.int64, len(texts))
        offsets = np.zeros(len(texts) + 1, np.int64)
        np.cumsum(sizes + 1, out=offsets[1:])
        inside = np.zeros(len(raw) + 2, bool)
        inside[1:-1] = table[raw]
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        self.starts, self.ends = edge[0::2], edge[1::2]
        self.hashes = word_hashes(raw, self.starts, self.ends) if data is None else None
        self.first = np.searchsorted(self.starts, offsets)

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of ``size`` words, and the first word of each; none crosses two texts."""
        count = len(self.hashes) - size + 1
        if count <= 0:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        total = np.zeros(count, np.uint64)
        for k in range(size):
            total += self.hashes[k : k + count] * np.uint64(pow(_BASE, k + 1, 1 << 64))
        at = np.arange(count)
        text = np.searchsorted(self.first, at, side="right") - 1
        whole = at + size <= self.first[text + 1]
        return mix(total[whole]), at[whole]

    def joined(self, start: int, size: int) -> bytes:
        """The words from ``start`` on, with a single space between."""
        return b" ".join(self.data[a:b] for a, b in zip(self.starts[start : start + size].tolist(), self.ends[start : start + size].tolist()))
