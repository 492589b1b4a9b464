"""Ranked lexical search as a blocked product of two sparse matrices.

The first matrix has a row for each query item and the multiplicity of each of its terms; the second one a row for each
term and, in the column of a document, the term's impact there, a 64-bit integer. A row of the product holds an item's
scores. It is made by merging the second matrix's rows of the item's terms (Gustavson's way), for one block of documents
at a time, and only the best documents of a block are kept. Blocks of one task are reduced to the best of the task, tasks
by groups, and groups to the best of all.

The documents are tokenised once for each block of items; what is kept of them are the occurrences of the items' terms.
Terms are told apart by 64-bit hashes, which different terms share with a probability of about 2**-64 a pair.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import ALNUM, Scratch, Words, sliced, text_of

#: Documents that are returned for an item.
BEST = 20
#: Items, and characters of their texts, that are broadcast at once; more are ranked in several blocks.
BLOCK_ROWS, BLOCK_CHARS = 20_000, 4_000_000
#: Documents, and occurrences in them, that a block of the product takes at most (a longer document is taken alone).
BLOCK_DOCUMENTS, BLOCK_ENTRIES = 1 << 14, 1 << 22


@dataclass(frozen=True)
class Items:
    """A block of query items: ``vocabulary`` (sorted term hashes), and the terms and multiplicities of item i at first[i] .. first[i + 1]."""

    ids: list[int | None]
    vocabulary: np.ndarray
    first: np.ndarray
    terms: np.ndarray
    times: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple[int | None, str]]) -> Items:
        words = Words([text for _, text in rows], ALNUM)
        vocabulary, place = np.unique(words.hashes, return_inverse=True)
        item = np.repeat(np.arange(len(rows)), np.diff(words.first))
        entries, times = np.unique(item * max(1, len(vocabulary)) + place, return_counts=True)
        item, terms = np.divmod(entries, max(1, len(vocabulary)))
        return cls([i for i, _ in rows], vocabulary, np.searchsorted(item, np.arange(len(rows) + 1)), terms, times.astype(np.int64))


def blocks(benchmark: DataFrame) -> Iterator[list[tuple[int | None, str]]]:
    """The items in blocks that are small enough to broadcast, whatever their number."""
    block: list[tuple[int | None, str]] = []
    chars = 0
    for row in benchmark.select(benchmark["item_id"].cast("long").alias("item_id"), text_of(benchmark).alias("text")).toLocalIterator(prefetchPartitions=True):
        if block and (len(block) >= BLOCK_ROWS or chars + len(row.text) > BLOCK_CHARS):
            yield block
            block, chars = [], 0
        block.append((row.item_id, row.text))
        chars += len(row.text)
    if block:
        yield block


def occurrences(documents: DataFrame, vocabulary: Broadcast) -> DataFrame:
    """doc_id, n (terms), terms, counts (its terms of the vocabulary, each with its number) of each document that has a term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for batch in batches:
            for a, b, texts in sliced(batch.column(1)):
                words = Words(texts, ALNUM)
                n = np.diff(words.first)
                place = np.searchsorted(known, words.hashes)
                place[place == len(known)] = 0
                hit = np.flatnonzero(known[place] == words.hashes)
                row = np.searchsorted(words.first, hit, side="right") - 1
                entries, counts = np.unique(row * len(known) + place[hit], return_counts=True)
                row, terms = np.divmod(entries, len(known))
                ends = np.searchsorted(row, np.arange(len(texts) + 1)).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x.astype(np.int32))) for x in (terms, counts)]
                found = pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(n.astype(np.int64)), *lists], ["doc_id", "n", "terms", "counts"])
                yield found.filter(pa.array(n > 0))

    rows = documents.select(documents["doc_id"].cast("long").alias("doc_id"), text_of(documents).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n long, terms array<int>, counts array<int>")


def statistics(found: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """Number of documents, of their terms, and of documents for each term of a vocabulary of ``size``.

    A task hands on one row for each term it has seen; the sums have one row for each term of the block's vocabulary.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        documents, length, df = 0, 0, np.zeros(size, np.int64)
        for batch in batches:
            documents += batch.num_rows
            length += int(batch.column(0).to_numpy().sum())
            df += np.bincount(batch.column(1).flatten().to_numpy(), minlength=size)
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([[-2, -1], some]), pa.int64()), pa.array(np.concatenate([[documents, length], df[some]]), pa.int64())], ["term", "df"])

    sums = found.select("n", "terms").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toPandas()
    counts = np.zeros(size + 2, np.int64)
    counts[sums["term"].to_numpy() + 2] = sums["df"].to_numpy()
    return int(counts[0]), int(counts[1]), counts[2:]


def weights(documents: int, df: np.ndarray) -> np.ndarray:
    """floor(1000 * ln((2 N + 2) / (2 df + 1))) of each term; terms in no document never count."""
    levels, place = np.unique(df, return_inverse=True)
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(d) + 1))) for d in levels], np.int64)[place]


def impacts(weight: np.ndarray, counts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """w * ((10**9 tf) div (1000 tf + 12 m)) of occurrences; ``lengths`` holds m."""
    return weight * (1_000_000_000 * counts // (1000 * counts + 12 * lengths))


def relative_lengths(n: np.ndarray, documents: int, total: int) -> np.ndarray:
    """m = 100 - 25 + (25 n N) div L, in integers of any size."""
    return np.array([75 + 25 * int(x) * documents // total for x in n], np.int64)


def product(items: Items, terms: np.ndarray, columns: np.ndarray, values: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """A row of scores of ``width`` documents for each item, from the impacts of a block (term, column, value); the row is used again for the next item."""
    order = np.argsort(terms, kind="stable")
    columns, values = columns[order], values[order]
    start = np.searchsorted(terms[order], np.arange(len(items.vocabulary) + 1)).tolist()
    first, own, times = items.first.tolist(), items.terms.tolist(), items.times.tolist()
    row = np.zeros(width, np.int64)
    for i in range(len(items.ids)):
        row[:] = 0
        for k in range(first[i], first[i + 1]):
            a, b = start[own[k]], start[own[k] + 1]
            if a < b:
                # a term's row names a document once, so that a plain indexed sum merges it
                row[columns[a:b]] += values[a:b] if times[k] == 1 else values[a:b] * times[k]
        yield row


def best(scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best scores above 0: higher ones first, equal ones by id, null ids last."""
    some = np.flatnonzero(scores > 0)
    if len(some) > k:
        least = np.partition(scores[some], len(some) - k)[len(some) - k]
        some = some[scores[some] >= least]
    return some[np.lexsort((ids[some], nulls[some], -scores[some]))][:k]


def _merged(own: tuple[np.ndarray, ...] | None, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    top = best(scores, ids, nulls, k)
    fresh = scores[top], ids[top], nulls[top]
    if own is None:
        return fresh
    both = [np.concatenate(x) for x in zip(own, fresh)]
    top = best(*both, k)
    return tuple(x[top] for x in both)


def _product_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of a task in blocks of BLOCK_DOCUMENTS rows and BLOCK_ENTRIES occurrences at most."""
    held, rows, entries = [], 0, 0
    for batch in batches:
        ends = batch.column(2).offsets.to_numpy().astype(np.int64)
        at = 0
        while at < batch.num_rows:
            fits = int(np.searchsorted(ends, ends[at] + BLOCK_ENTRIES - entries, side="right")) - 1
            stop = min(batch.num_rows, at + BLOCK_DOCUMENTS - rows, max(fits, at + (not rows)))
            if stop > at:
                held.append(batch.slice(at, stop - at))
                rows, entries = rows + stop - at, entries + int(ends[stop] - ends[at])
            at = stop
            if at < batch.num_rows:
                yield pa.Table.from_batches(held)
                held, rows, entries = [], 0, 0
    if held:
        yield pa.Table.from_batches(held)


def block_best(found: DataFrame, items: Broadcast, weight: Broadcast, documents: int, total: int, k: int) -> DataFrame:
    """item (its place in the block), item_id, doc_id, score: the k best documents of each task for each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, by_term = items.value, weight.value
        top: list[tuple[np.ndarray, ...] | None] = [None] * len(known.ids)
        for table in _product_blocks(batches):
            table = table.combine_chunks()
            sizes = table.column("terms").combine_chunks().value_lengths().to_numpy()
            terms, counts = (table.column(c).combine_chunks().flatten().to_numpy().astype(np.int64) for c in ("terms", "counts"))
            m = relative_lengths(table.column("n").to_numpy(), documents, total)
            columns = np.repeat(np.arange(table.num_rows), sizes)
            values = impacts(by_term[terms], counts, m[columns])
            ids = table.column("doc_id").combine_chunks()
            nulls, ids = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
            for i, scores in enumerate(product(known, terms, columns, values, table.num_rows)):
                top[i] = _merged(top[i], scores, ids, nulls, k)
        for a in range(0, len(top), 1024):
            some = [(i, t) for i, t in enumerate(top[a : a + 1024], a) if t is not None and len(t[0])]
            if some:
                item = np.repeat([i for i, _ in some], [len(t[0]) for _, t in some])
                scores, ids, nulls = (np.concatenate([t[j] for _, t in some]) for j in range(3))
                yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array([known.ids[i] for i in item.tolist()], pa.int64()), pa.array(ids, pa.int64(), mask=nulls), pa.array(scores)], ["item", "item_id", "doc_id", "score"])

    return found.mapInArrow(run, "item int, item_id long, doc_id long, score long")


def _reduced(tops: DataFrame, k: int, *keys: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return tops.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def rank(documents: DataFrame, benchmark: DataFrame, k: int = BEST) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents with a score above 0 for each row of ``benchmark``.

    Null and empty texts have no terms: such documents don't count and never rank, such items find nothing. Rows that repeat
    a doc_id are a document each, rows that repeat an item_id are ranked each by itself; null ids are ids like any other,
    after all others among equal scores. Empty tables give no rows. Texts are taken whole; further columns are not read. A
    benchmark of several blocks costs a pass over the documents each.
    """
    context = documents.sparkSession.sparkContext
    results = []
    with Scratch("lexical") as stage:
        for rows in blocks(benchmark):
            items = Items.of(rows)
            if not len(items.vocabulary):
                continue
            vocabulary = context.broadcast(items.vocabulary)
            found = stage(occurrences(documents, vocabulary), "occurrences")
            vocabulary.destroy()
            n, total, df = statistics(found, len(items.vocabulary))
            if n:
                weight, known = context.broadcast(weights(n, df)), context.broadcast(items)
                tops = stage(block_best(found, known, weight, n, total, k), "tops")
                weight.destroy()
                known.destroy()
                groups = max(1, math.isqrt(tops.rdd.getNumPartitions()))
                tops = _reduced(tops.withColumn("group", F.pmod(F.xxhash64("doc_id"), F.lit(groups))), k, "item", "group").drop("rank")
                results.append(stage.keep(stage(_reduced(tops, k, "item").select("item_id", "rank", "doc_id", "score"), "ranks")))
            stage.drop(found)
    if not results:
        return documents.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.unionByName, results)


_TERMS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

#: ``rank`` for DuckDB.
ORACLE_SQL = f"""
WITH d AS (SELECT r, doc_id, w, len(w)::HUGEINT AS n FROM (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents) WHERE len(w) > 0),
s AS MATERIALIZED (SELECT count(*)::HUGEINT AS n_docs, sum(n)::HUGEINT AS n_terms FROM d),
tf AS MATERIALIZED (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM d) GROUP BY r, t),
q AS MATERIALIZED (SELECT i, item_id, t, count(*) AS times FROM (SELECT i, item_id, unnest(w) AS t FROM (SELECT row_number() OVER () AS i, item_id, {_TERMS} AS w FROM benchmark)) GROUP BY i, item_id, t),
w AS MATERIALIZED (SELECT t, floor(1000 * ln((2 * n_docs::DOUBLE + 2) / (2 * df::DOUBLE + 1)))::BIGINT AS w FROM (SELECT t, count(*) AS df FROM tf GROUP BY t), s),
m AS MATERIALIZED (SELECT r, doc_id, (75 + (25 * n * n_docs) // n_terms)::BIGINT AS m FROM d, s),
p AS (SELECT r, m.doc_id, t, w.w * ((1000000000 * tf) // (1000 * tf + 12 * m)) AS v FROM tf JOIN w USING (t) JOIN m USING (r)),
z AS (SELECT i, item_id, r, doc_id, sum(times * v)::BIGINT AS score FROM q JOIN p USING (t) GROUP BY i, item_id, r, doc_id)
SELECT item_id, rank::INT AS rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS rank FROM z WHERE score > 0) WHERE rank <= {BEST}
"""
