"""Benchmark decontamination: a hash set of normalised benchmark n-grams, scanned over every word window.

Words are runs of ASCII letters and digits and of anything beyond ASCII, with A-Z lower-cased.
A benchmark item gives one window for each run of ``size`` words; an item of fewer words, but
not none, gives a single window of all its words. Hash hits are verified on the words themselves.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import ALNUM, Words, sliced, staged, text_of

#: Words in a window.
SIZE = 10
#: Benchmark rows broadcast at once; a larger benchmark is scanned in several blocks of so many rows.
BLOCK_ROWS = 20_000
#: Characters of benchmark text broadcast at once.
BLOCK_CHARS = 16_000_000


class Grams:
    """The windows of a block of benchmark items, by length."""

    def __init__(self, items: list[tuple[int, str]], size: int):
        #: window text -> items it belongs to
        self.items: dict[bytes, list[int]] = defaultdict(list)
        by_length: dict[int, list[np.ndarray]] = defaultdict(list)
        words = Words([text or "" for _, text in items], ALNUM)
        for k, (item, _) in enumerate(items):
            first, last = int(words.first[k]), int(words.first[k + 1])
            length = min(size, last - first)
            if length:
                for at in range(first, last - length + 1):
                    own = self.items[words.joined(at, length)]
                    if item not in own:
                        own.append(item)
        for length in {w.count(b" ") + 1 for w in self.items}:
            hashes, _ = words.windows(length)
            by_length[length].append(hashes)
        self.hashes = {n: np.unique(np.concatenate(h)) for n, h in sorted(by_length.items())}
        #: One flag for each value of the low 20 bits: most windows are dismissed by it.
        self.flags = {}
        for n, h in self.hashes.items():
            flags = np.zeros(1 << 20, bool)
            flags[(h & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
            self.flags[n] = flags

    def scan(self, texts: list[str]) -> Iterator[tuple[int, np.ndarray, list[int]]]:
        """For each text: its number of words, the positions of hit words, and the items that occur."""
        words = Words(texts, ALNUM)
        hit = np.zeros(len(words.hashes) + 1, np.int64)
        found: dict[int, set[int]] = defaultdict(set)
        for length, known in self.hashes.items():
            hashes, at = words.windows(length)
            some = self.flags[length][(hashes & np.uint64((1 << 20) - 1)).astype(np.int64)]
            hashes, at = hashes[some], at[some]
            place = np.searchsorted(known, hashes)
            place[place == len(known)] = 0
            at = at[known[place] == hashes] if len(known) else at[:0]
            text = np.searchsorted(words.first, at, side="right") - 1
            for start, t in zip(at.tolist(), text.tolist()):
                items = self.items.get(words.joined(start, length))  # verified on the words
                if items:
                    hit[start] += 1
                    hit[start + length] -= 1
                    found[t].update(items)
        covered = np.cumsum(hit[:-1]) > 0
        for t in range(len(texts)):
            first, last = words.first[t], words.first[t + 1]
            yield int(last - first), np.flatnonzero(covered[first:last]) if t in found else _NONE, sorted(found.get(t, ()), key=str)


def without(text: str, positions: np.ndarray) -> str:
    """The text without the hit words and what stands between adjacent ones."""
    words = Words([text], ALNUM)
    data = text.encode("utf-8", "surrogatepass")
    out, done = [], 0
    for run in np.split(positions, np.flatnonzero(np.diff(positions) > 1) + 1):
        out.append(data[done : words.starts[run[0]]])
        done = int(words.ends[run[-1]])
    return b"".join([*out, data[done:]]).decode("utf-8", "surrogatepass")


_NONE = np.empty(0, np.int64)


def blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """Benchmark rows in blocks that are small enough to broadcast, whatever the benchmark's size."""
    block: list[tuple[int, str]] = []
    chars = 0
    for row in benchmark.select("item_id", text_of(benchmark).alias("text")).filter("item_id is not null").toLocalIterator(prefetchPartitions=True):
        if block and (len(block) >= BLOCK_ROWS or chars + len(row.text) > BLOCK_CHARS):
            yield block
            block, chars = [], 0
        block.append((row.item_id, row.text))
        chars += len(row.text)
    yield block


def scan_block(documents: DataFrame, grams: Broadcast, cut: bool) -> DataFrame:
    """n_words, hits array<int>, items array<long> and (with ``cut``) rest, the text without its hits or null where nothing is hit, of each row of ``documents``, beside its columns."""
    keep = documents.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Grams(*grams.value)
        for batch in batches:
            for a, b, texts in sliced(batch.column(batch.num_columns - 1)):
                found = list(known.scan(texts))
                columns = [c.slice(a, b - a) for c in batch.columns[:-1]]
                columns += [
                    pa.array([f[0] for f in found], pa.int64()),
                    pa.array([f[1].astype(np.int32) for f in found], pa.list_(pa.int32())),
                    pa.array([f[2] for f in found], pa.list_(pa.int64())),
                ]
                if cut:
                    columns.append(pa.array([without(t, f[1]) if len(f[1]) else None for t, f in zip(texts, found)], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, schema=_arrow(columns, [f"c{i}" for i in range(len(keep))] + _FOUND[: 3 + cut]))

    # positional names: columns of any name pass through
    schema = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(documents.schema.fields)] + [T.StructField(n, k) for n, k in zip(_FOUND, _KINDS)][: 3 + cut])
    renamed = documents.toDF(*[f"c{i}" for i in range(len(keep))])
    text = renamed[f"c{keep.index('text')}"]
    return renamed.withColumn("scanned_text", F.coalesce(text.cast("string"), F.lit(""))).mapInArrow(run, schema)


def scan(documents: DataFrame, benchmark: DataFrame, size: int, cut: bool) -> DataFrame:
    """The columns of ``documents`` as c0, c1, .. and those of ``scan_block`` for the whole benchmark.

    A benchmark of several blocks costs a scan of the documents each, one after the other, with one block
    broadcast at a time. Only rows that are hit leave a scan; their positions are united before anything is
    cut or counted, so the number of blocks changes no result.
    """
    context = documents.sparkSession.sparkContext
    todo = blocks(benchmark)
    items, more = next(todo), next(todo, None)
    if more is None:
        return scan_block(documents, context.broadcast((items, size)), cut)
    width = len(documents.columns)
    text = f"c{documents.columns.index('text')}"
    numbered = staged(documents.toDF(*[f"c{i}" for i in range(width)]).withColumn("row", F.monotonically_increasing_id()), "decontam-rows")
    parts = []
    for block in chain((items, more), todo):
        grams = context.broadcast((block, size))
        found = scan_block(numbered.select("row", F.col(text).alias("text")), grams, False)
        found = found if not parts else found.filter(F.size("hits") > 0)  # the first one counts the words of every row
        parts.append(staged(found.select(F.col("c0").alias("row"), "n_words", "hits", "items"), "decontam-hits"))
        grams.destroy()
    united = [F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c) for c in ("hits", "items")]
    merged = reduce(DataFrame.unionByName, parts).groupBy("row").agg(F.max("n_words").alias("n_words"), *united)
    rows = numbered.join(merged, "row").drop("row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(int(text[1:])).cast(pa.string()).to_pylist()
            hit = batch.column(width + 1).to_pylist()
            rest = pa.array([without(t or "", np.array(h)) if h else None for t, h in zip(texts, hit)], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, rest], schema=pa.schema([*batch.schema, pa.field("rest", pa.string())]))

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("rest", T.StringType())])) if cut else rows


_FOUND = ["n_words", "hits", "items", "rest"]
_KINDS = [T.LongType(), T.ArrayType(T.IntegerType()), T.ArrayType(T.LongType()), T.StringType()]


def _arrow(columns: list, names: list[str]) -> pa.Schema:
    return pa.schema([pa.field(n, c.type) for n, c in zip(names, columns)])


def hits(documents: DataFrame, benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of each row of ``documents``.

    Null and empty texts have no words and no hits; an empty benchmark hits nothing; benchmark rows
    without an item_id or without words are ignored; equal windows count for every item that has
    them. Repeated rows give a row each; further columns are not read.
    """
    found = scan(
        documents.select("doc_id", "text"), benchmark, size, False,
    ).withColumnRenamed("c0", "doc_id").withColumn("n_hit", F.size("hits").cast("long"))
    listed = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(listed, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def decontaminate(documents: DataFrame, benchmark: DataFrame, size: int = SIZE, most: float = 0.5) -> DataFrame:
    """``documents`` without benchmark passages: hit words are cut from the text; a document goes if more than ``most`` of its words are hit.

    All columns of the input are kept as they are (n_chars, where present as a number, follows the new
    text), in their order, whatever their names. Rows without hits, and null or empty texts, stay unchanged.
    Whole texts are scanned; the result does not depend on the blocks in which the benchmark is broadcast.
    """
    names, fields = documents.columns, documents.schema.fields
    found = scan(documents, benchmark, size, True).filter(F.size("hits") <= F.lit(most) * F.col("n_words"))
    text = F.coalesce("rest", f"c{names.index('text')}")
    out = []
    for i, f in enumerate(fields):
        own = F.col(f"c{i}")
        if f.name == "text":
            own = text
        elif f.name == "n_chars" and isinstance(f.dataType, T.NumericType):
            own = F.when(F.col("rest").isNotNull(), F.length(text)).otherwise(own).cast(f.dataType)
        out.append(own.alias(f.name))
    return found.select(*out)


_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

#: ``hits`` for DuckDB.
ORACLE_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, w, least({SIZE}, len(w)) AS k FROM (SELECT item_id, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL) WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, k, array_to_string(w[i : i + k - 1], ' ') AS g FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM b)),
dw AS (SELECT r, i, k, array_to_string(w[i : i + k - 1], ' ') AS g FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM bw) WHERE len(w) >= k)),
h AS (SELECT r, i, dw.k, item_id FROM dw JOIN bw ON dw.k = bw.k AND dw.g = bw.g),
p AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT r, i, k FROM h)) GROUP BY r),
t AS (SELECT r, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS items FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS x FROM h) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN p USING (r) LEFT JOIN t USING (r)
"""
