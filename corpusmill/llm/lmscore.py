"""Language-model scores: stupid backoff over n-gram counts of the whole corpus.

N-grams are rows: each document is exploded into its distinct n-grams (context, n-gram, document, number
of occurrences), all by 64-bit hashes. Counts are tables over the same keys, partitioned by hash; rows are
joined to them, and the logarithms are summed for each document.

Where words back off, count tables hold the n-grams of every length that the corpus has at least ``least`` times, partitioned by
ranges of their hash (buckets). Documents are exploded by slices of about a megabyte of text: the different n-grams of a slice
that fall into a bucket are one row, a sorted array. These rows are summed for the count tables, and joined to them by bucket; the
counts go back to their slice, in which each word takes its longest n-gram that counts, ``alpha`` for each length that it lacks.
Buckets are taken in BACKOFF_PASSES passes, so that one part of the n-grams only is on disk.

If the scored documents are the corpus and every n-gram counts (``least`` 1), no word ever backs off but at the start of a
document, where the shorter n-grams' scores telescope. Then rows and counts have the same key, and one exchange by context
serves both: a partition counts its n-grams and joins the counts to its rows. Contexts whose hash slot holds much
more than its share of rows are taken apart and joined to their count tables by shuffled joins, whose skewed
keys Spark splits.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import SPACED, Scratch, Words, mix, settings, sliced, text_of

#: Longest n-gram, backoff factor, and count from which on an n-gram of two or more words is in the table.
ORDER, ALPHA, LEAST = 3, 0.4, 2
#: Passes over the hash values, and rows in a partition of one, about.
PASSES, PART_ROWS = 3, 1 << 21
#: Passes over the hash values and over the slices where words back off, n-grams in a bucket of hash values, at most about, and
#: buckets at least: a slice makes a row for each, so their number stays the same up to some gigabyte of text.
BACKOFF_PASSES, BUCKET_GRAMS, BUCKETS = 3, 1 << 21, 256
#: Bits of the hash slots of contexts in which rows are counted first, at least: there are so many that HOT average
#: slots have no more rows than a partition. A slot with more rows than a partition is hot.
SLOT_BITS, HOT = 16, 64

#: Where a row holds the words of many documents, few rows are taken at once.
_LONG_ROWS = {
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20), "spark.sql.parquet.columnarReaderBatchSize": "16",
    "parquet.block.size": str(32 << 20), "spark.sql.parquet.compression.codec": "zstd",
}

#: For the hash of an n-gram, a polynomial of the hashes of its words.
_FACTOR = 0x9E3779B97F4A7C15

_GRAMS = "ctx long, gram long, doc long, occ long"
#: Values of ``gram`` that are no hash: a context at the end of a document, and the one at its start.
_END, _START = 0, 1


def _hashes(words: Words, n: int) -> np.ndarray:
    """For each word the hash of the n words from it on, 0 where the text ends before."""
    out = np.zeros(len(words.hashes), np.uint64)
    hashes, at = words.windows(n)
    out[at] = mix(hashes + np.uint64(n)) | np.uint64(2)
    return out


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _mapped(df: DataFrame, schema: str | T.StructType, rows: Callable[[Words, np.ndarray], Iterator[list]]) -> DataFrame:
    """``rows(words, key)`` of the texts (second column) with their keys (first column), as columns of ``schema``."""
    names = [f.name for f in (schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)).fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            for a, b, texts in sliced(batch.column(1)):
                for columns in rows(Words(texts, SPACED), keys[a:b]):
                    yield pa.RecordBatch.from_arrays(columns, names)

    return df.mapInArrow(run, schema)


def exploded(texts: DataFrame, n: int, some: Callable[[np.ndarray], np.ndarray] | None = None, ends: bool = False) -> DataFrame:
    """ctx, gram, doc, occ: the distinct n-grams of each document of ``texts`` (row, text) with the hash of their first n - 1 words.

    With ``ends`` also a row for the last n - 1 words of each document, which no word follows (gram _END), and
    one for its first n - 1 words (gram _START). ``some`` picks rows by the hashes of their contexts.
    """

    def rows(words: Words, keys: np.ndarray) -> Iterator[list]:
        text = np.repeat(np.arange(len(keys)), np.diff(words.first))
        gram = _hashes(words, n)
        ctx = _hashes(words, n - 1) if n > 1 else np.zeros(len(gram), np.uint64)
        whole = np.flatnonzero(gram)
        parts = [(ctx[whole], gram[whole], text[whole])]
        if ends:
            last = np.flatnonzero((ctx > 0) & (gram == 0))  # a context fits, a further word does not
            long = np.diff(words.first) >= n - 1
            first = words.first[:-1][long]
            parts += [(ctx[at], np.full(len(at), kind, np.uint64), text[at]) for at, kind in ((last, _END), (first, _START))]
        ctx, gram, text = (np.concatenate(p) for p in zip(*parts))
        if some:
            own = some(ctx)
            ctx, gram, text = ctx[own], gram[own], text[own]
        # kinds other than n-grams stand once for each document and context
        order = np.argsort(gram, kind="stable")
        ctx, gram, text = ctx[order], gram[order], text[order]
        fresh = np.ones(len(gram), bool)
        fresh[1:] = (gram[1:] != gram[:-1]) | (text[1:] != text[:-1])
        at = np.flatnonzero(fresh)
        yield [
            _signed(ctx[at]), _signed(gram[at]), pa.array(keys[text[at]], pa.int64()),
            pa.array(np.diff(at, append=len(gram)), pa.int64()),
        ]

    return _mapped(texts, _GRAMS, rows)


def _slot(ctx: np.ndarray, bits: int) -> np.ndarray:
    return (ctx >> np.uint64(64 - bits)).astype(np.int64)


def _numbered(documents: DataFrame, stage: Scratch) -> DataFrame:
    """row, text, doc_id: the documents with a number each, staged so that all passes see the same numbers."""
    rows = documents.select(
        F.monotonically_increasing_id().alias("row"), text_of(documents).alias("text"),
        documents["doc_id"].alias("doc_id"),
    )
    with settings(documents.sparkSession, {"spark.sql.parquet.compression.codec": "zstd"}):
        return stage(rows, "rows")


def _sizes(texts: DataFrame, order: int, bits: int) -> DataFrame:
    """row, n_words and whole (hash of a text of fewer than order - 1 words) of each document; and, with a null row, the number (n_words) of contexts in each hash slot."""

    def rows(words: Words, keys: np.ndarray) -> Iterator[list]:
        n = np.diff(words.first)
        whole = np.zeros(len(keys), np.uint64)
        for m in range(1, order - 1):
            whole[n == m] = _hashes(words, m)[words.first[:-1][n == m]]
        yield [pa.array(keys, pa.int64()), pa.array(n, pa.int64()), _signed(whole), pa.array(np.full(len(keys), -1), pa.int64())]
        ctx = _hashes(words, order - 1)
        slots, count = np.unique(_slot(ctx[ctx > 0], bits), return_counts=True)
        yield [pa.nulls(len(slots), pa.int64()), pa.array(count, pa.int64()), pa.nulls(len(slots), pa.int64()), pa.array(slots, pa.int64())]

    return _mapped(texts.select("row", "text"), "row long, n_words long, whole long, slot long", rows)


def _partition_scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc, part, shared of the rows of a hash partition, which holds all rows of each of its contexts; those that add nothing to a score (an n-gram that always follows its context, or stands once) are left out."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    table = pa.Table.from_batches(held)
    ctx, gram, doc, occ = (c.to_numpy() for c in table.columns)
    del table, held
    counted = np.where(gram == _START, 0, occ)
    _, place = np.unique(ctx, return_inverse=True)
    base = np.bincount(place, counted)[place]
    _, place = np.unique(gram, return_inverse=True)
    own = np.bincount(place, occ)[place]
    value = np.where(gram == _START, np.log(base), np.where(gram == _END, 0.0, occ * (np.log(own) - np.log(base))))
    shared = np.where(gram == _START, 0, np.where((gram != _END) & (own > 1), occ, 0))
    some = (value != 0) | (shared > 0)
    yield pa.RecordBatch.from_arrays([pa.array(doc[some]), pa.array(value[some]), pa.array(shared[some])], ["doc", "part", "shared"])


def _joined_scores(rows: DataFrame, stage: Scratch) -> DataFrame:
    """doc, part, shared like ``_partition_scores``, by joins to count tables that are partitioned by their own keys."""
    rows = stage(rows, "hot-rows")
    grams = stage(rows.filter(F.col("gram") != _START).groupBy("ctx", "gram").agg(F.sum("occ").alias("own")), "hot-grams")
    contexts = stage(grams.groupBy("ctx").agg(F.sum("own").alias("base")), "hot-contexts")
    each = rows.join(grams, ["ctx", "gram"], "left").join(contexts, "ctx")
    start, end = F.col("gram") == _START, F.col("gram") == _END
    value = F.when(start, F.log("base")).when(end, 0.0).otherwise(F.col("occ") * (F.log("own") - F.log("base")))
    shared = F.when(~start & ~end & (F.col("own") > 1), F.col("occ")).otherwise(0)
    return each.groupBy("doc").agg(F.sum(value).alias("part"), F.sum(shared).alias("shared"))


_SUMS = ("part", "shared")


def _own_scores(texts: DataFrame, order: int, passes: int, part_rows: int, stage: Scratch) -> DataFrame:
    """row, n_words, n_backoff, n_shared, log_score of documents that are the corpus themselves, every n-gram counted."""
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]  # words are half of it at most
    bits = max(SLOT_BITS, math.ceil(math.log2(max(1.0, HOT * size / 2 / part_rows))))
    sizes = stage(_sizes(texts, order, bits), "sizes")
    slots = sizes.filter("row is null").groupBy("slot").agg(F.sum("n_words").alias("n"))
    rows = sizes.filter("row is not null").select("row", "n_words", "whole")
    totals = rows.agg(
        F.coalesce(F.sum("n_words"), F.lit(0)).alias("words"),
        F.coalesce(F.sum(F.when(F.col("whole") != 0, 1)), F.lit(0)).alias("short"),
    ).first()
    crowded = slots.filter(F.col("n") > part_rows).select("slot").collect()  # at most words / part_rows of them
    hot = np.sort(np.array([r.slot for r in crowded], np.int64))

    def is_hot(ctx: np.ndarray) -> np.ndarray:
        slot = _slot(ctx, bits)
        return hot[np.searchsorted(hot, slot) % len(hot)] == slot if len(hot) else np.zeros(len(ctx), bool)

    def of_pass(k: int) -> Callable[[np.ndarray], np.ndarray]:
        return lambda ctx: ~is_hot(ctx) & ((ctx >> np.uint64(32)) % np.uint64(passes) == k)

    parts = max(1, math.ceil(totals.words / passes / part_rows))
    numbered = texts.select("row", "text")
    found = []
    for k in range(passes):
        dealt = exploded(numbered, order, of_pass(k), ends=True).repartition(parts, "ctx")
        scored = dealt.mapInArrow(_partition_scores, "doc long, part double, shared long")
        found.append(stage(scored.groupBy("doc").agg(*[F.sum(c).alias(c) for c in _SUMS]), f"pass{k}"))
    if len(hot):
        found.append(stage(_joined_scores(exploded(numbered, order, is_hot, ends=True), stage), "hot"))
    if totals.short:  # texts of fewer than order - 1 words: the count of the whole text among the n-grams of its length
        for m in range(1, order - 1):
            own = rows.filter((F.col("n_words") == m) & (F.col("whole") != 0))
            asked = own.select(F.col("whole").alias("gram")).distinct()
            counts = exploded(numbered, m).join(asked, "gram", "left_semi").groupBy("gram").agg(F.sum("occ").alias("own"))
            found.append(
                stage(
                    own.join(counts, own["whole"] == counts["gram"]).select(
                        F.col("row").alias("doc"), F.log("own").alias("part"), F.lit(0).cast("long").alias("shared"),
                    ),
                    f"short{m}",
                )
            )
    every = found[0]
    for part in found[1:]:
        every = every.unionByName(part)
    sums = every.groupBy("doc").agg(*[F.sum(c).alias(c) for c in _SUMS])
    some = F.col("n_words") > 0
    out = rows.join(sums, F.col("row") == F.col("doc"), "left")
    score = F.when(some, F.coalesce("part", F.lit(0.0)) - math.log(max(1, totals.words))).otherwise(0.0)
    return out.select(
        "row", "n_words", some.cast("long").alias("n_backoff"), F.coalesce("shared", F.lit(0)).alias("n_shared"),
        score.alias("log_score"),
    )


def _slices(documents: DataFrame, stage: Scratch, label: str) -> DataFrame:
    """slice, docs, sizes, words: the hashed words of some documents in a row (eight bytes each), staged, with the documents' ids and numbers of words."""
    ids = documents["doc_id"] if "doc_id" in documents.columns else F.lit(None).cast("long")
    texts = documents.select(ids.alias("doc_id"), text_of(documents).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, own in sliced(batch.column(1)):
                words = Words(own, SPACED)
                lists = [pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for c in (batch.column(0).slice(a, b - a), pa.array(np.diff(words.first), pa.int32()))]
                yield pa.RecordBatch.from_arrays([*lists, _packed(np.array([len(words.hashes)]), words.hashes)], ["docs", "sizes", "words"])

    kinds = {"docs": T.ArrayType(texts.schema["doc_id"].dataType), "sizes": T.ArrayType(T.IntegerType()), "words": T.BinaryType()}
    found = texts.mapInArrow(run, T.StructType([T.StructField(name, kind) for name, kind in kinds.items()]))
    return stage(found.select(F.monotonically_increasing_id().alias("slice"), "*"), label)


def _grams(sizes: np.ndarray, words: np.ndarray, order: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For n from 1 to ``order`` the hashes of the n-grams of a slice and their first words; none crosses two documents."""
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(words))  # words of the document from this one on
    total = np.zeros(len(words), np.uint64)
    for n in range(1, order + 1):
        total = total[: len(words) - n + 1] + words[n - 1 :] * np.uint64(pow(_FACTOR, n, 1 << 64))
        at = np.flatnonzero(left[: len(total)] >= n)
        yield mix(mix(total[at]) + np.uint64(n)), at


def _bucket(grams: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each hash: equal ranges of the hash values, in their order."""
    return ((grams >> np.uint64(40)) * np.uint64(buckets) >> np.uint64(24)).astype(np.int64)


def _lists(sizes: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), values)


def _packed(sizes: np.ndarray, values: np.ndarray) -> pa.Array:
    """``values`` as rows of so many each, in bytes: what the JVM copies at once, where it takes the elements of a list one by one."""
    ends = (np.concatenate([[0], np.cumsum(sizes)]) * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(values))])


def _unpacked(table: pa.Table, name: str, kind: type) -> np.ndarray:
    """The values of all rows of a column of ``_packed``, one after the other."""
    parts = [np.empty(0, kind)]
    for rows in table.column(name).cast(pa.large_binary()).chunks:
        if len(rows):
            _, ends, data = rows.buffers()
            first, last = np.frombuffer(ends, np.int64)[[rows.offset, rows.offset + len(rows)]]
            parts += [np.frombuffer(data, np.uint8)[first:last].view(kind)] if last > first else []
    return np.concatenate(parts)


def _blocks(slices: DataFrame, order: int, buckets: int, some: range, counted: bool) -> DataFrame:
    """bucket, slice, grams, own: the different n-grams of all lengths up to ``order`` of each slice, in ascending order of their hashes (eight bytes each), with their numbers in the slice (four; ``counted``, else none); a row for each slice and bucket of ``some``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                sizes, words = batch.column(1)[k].values.to_numpy(), np.frombuffer(batch.column(2)[k].as_buffer(), np.uint64)
                grams = [g for g, _ in _grams(sizes, words, order)]
                every = np.sort(np.concatenate([g[(b >= some.start) & (b < some.stop)] for g in grams for b in [_bucket(g, buckets)]]))
                first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]])[: len(every)])
                own = np.diff(first, append=len(every)).astype(np.uint32)
                every = every[first]
                sizes = np.bincount(_bucket(every, buckets) - some.start, minlength=len(some))
                found = np.flatnonzero(sizes)
                sizes = sizes[found]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(found + some.start, pa.int32()), pa.array(np.full(len(found), batch.column(0)[k].as_py()), pa.int64()), _packed(sizes, every),
                        _packed(sizes, own) if counted else pa.nulls(len(found), pa.binary()),
                    ],
                    ["bucket", "slice", "grams", "own"],
                )

    return slices.select("slice", "sizes", "words").mapInArrow(run, "bucket int, slice long, grams binary, own binary")


def _flat(table: pa.Table, name: str) -> np.ndarray:
    return pc.list_flatten(table.column(name)).to_numpy()


def count_table(corpus: DataFrame, order: int, least: int, buckets: int, some: range) -> DataFrame:
    """bucket, grams, own: the n-grams of all lengths that the slices have ``least`` times or twice, and their counts, by ranges of their hash values: a row for each bucket of ``some``."""
    return _counts(_blocks(corpus, order, buckets, some, True), least)


def _counts(blocks: DataFrame, least: int) -> DataFrame:
    """``count_table`` of blocks with numbers."""

    def summed(table: pa.Table) -> pa.Table:
        grams, own = _unpacked(table, "grams", np.uint64), _unpacked(table, "own", np.uint32).astype(np.int64)
        by = np.argsort(grams)
        grams = grams[by]
        first = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
        own = np.add.reduceat(own[by], first)
        kept = own >= min(least, 2)
        return pa.Table.from_arrays([table.column("bucket")[:1], *(_lists(np.array([kept.sum()]), x) for x in (_signed(grams[first][kept]), pa.array(own[kept])))], ["bucket", "grams", "own"])

    return blocks.groupBy("bucket").applyInArrow(summed, "bucket int, grams array<long>, own array<long>")


def _answers(blocks: DataFrame, table: DataFrame) -> DataFrame:
    """slice, bucket, known, own: whether the count table has each n-gram of a block (a byte each), and the counts of those that it has, by a join on the bucket."""

    def joined(asked: pa.Table, table: pa.Table) -> pa.Table:
        grams, known, own = _unpacked(asked, "grams", np.uint64), _flat(table, "grams").view(np.uint64), _flat(table, "own")
        place = np.searchsorted(known, grams)
        there = place < len(known)
        there[there] = known[place[there]] == grams[there]
        sizes = pc.binary_length(asked.column("grams")).to_numpy() // 8
        ends = np.concatenate([[0], np.cumsum(there)])[np.cumsum(sizes)]
        return pa.Table.from_arrays([asked.column("slice"), asked.column("bucket"), _packed(sizes, there), _lists(np.diff(ends, prepend=0), pa.array(own[place[there]], pa.int64()))], ["slice", "bucket", "known", "own"])

    return blocks.groupBy("bucket").cogroup(table.groupBy("bucket")).applyInArrow(joined, "slice long, bucket int, known binary, own array<long>")


def _slice_scores(slices: DataFrame, answers: DataFrame, words: int, order: int, alpha: float, least: int) -> DataFrame:
    """doc_id, n_words, n_backoff, n_shared, log_score of the documents of each slice, from the counts of its n-grams."""

    def scored(own: pa.Table, answers: pa.Table) -> pa.Table:
        sizes, hashes = _flat(own, "sizes"), _unpacked(own, "words", np.uint64)
        answers = answers.sort_by("bucket")
        known = _unpacked(answers, "known", np.bool_)
        counts = np.zeros(len(known), np.int64)
        counts[known] = _flat(answers, "own")
        grams = list(_grams(sizes, hashes, order))
        _, place = np.unique(np.concatenate([g for g, _ in grams]), return_inverse=True)
        by_start, done = [np.full(len(hashes), words)], 0  # counts of n words from each one on, of none: all words
        for g, at in grams:
            by_start.append(np.zeros(len(hashes), np.int64))
            by_start[-1][at] = counts[place[done : done + len(g)]]
            done += len(g)
        text = np.repeat(np.arange(len(sizes)), sizes)
        reach = np.minimum(np.arange(len(hashes)) - (np.cumsum(sizes) - sizes)[text] + 1, order)
        value = np.log(np.maximum(by_start[1], 1)) - math.log(max(1, words))  # a word that the corpus lacks has the value of a single one
        used = np.ones(len(hashes), np.int64)
        for n in range(2, order + 1):
            end = np.flatnonzero(reach >= n)
            end = end[by_start[n][end - n + 1] >= least]
            value[end] = np.log(by_start[n][end - n + 1]) - np.log(by_start[n - 1][end - n + 1])
            used[end] = n
        value += (reach - used) * math.log(alpha)
        whole = np.flatnonzero(reach == order)
        shared = text[whole[by_start[order][whole - order + 1] > 1]]
        single, shared = (np.bincount(x, minlength=len(sizes)) for x in (text[used == 1], shared))
        score = np.bincount(text, value, len(sizes))
        docs = pc.list_flatten(own.column("docs"))
        return pa.Table.from_arrays([docs, *(pa.array(x.astype(np.int64)) for x in (sizes, single, shared)), pa.array(score.astype(np.float64))], ["doc_id", *_SCORES])

    kinds = [T.StructField("doc_id", slices.schema["docs"].dataType.elementType), *(T.StructField(c, T.DoubleType() if c == "log_score" else T.LongType()) for c in _SCORES)]
    return slices.groupBy("slice").cogroup(answers.groupBy("slice")).applyInArrow(scored, T.StructType(kinds))


_SCORES = ("n_words", "n_backoff", "n_shared", "log_score")


def _backing_off(documents: DataFrame, corpus: DataFrame | None, order: int, alpha: float, least: int, passes: int, stage: Scratch) -> DataFrame:
    """doc_id, n_words, n_backoff, n_shared, log_score: exploded n-grams of all lengths joined to the count tables by ranges of hash values; each slice of documents then takes for each word the longest that counts.

    Ranges are taken in passes, and slices after them, so that what one part of them shuffles only is on disk at a time.
    """
    with settings(documents.sparkSession, _LONG_ROWS):
        slices = _slices(documents, stage, "slices")
        counted = slices if corpus is None else _slices(corpus, stage, "corpus")
        total = F.coalesce(F.sum(F.expr("length(words) div 8")), F.lit(0))
        words = counted.agg(total).first()[0]
        most = max(words, words if corpus is None else slices.agg(total).first()[0])
        buckets = min(1 << 24, max(BUCKETS, math.ceil(order * most / BUCKET_GRAMS)))
        answers = []
        for k in range(passes):
            some = range(k * buckets // passes, (k + 1) * buckets // passes)
            if corpus is None:  # one exchange of the blocks serves the count table and the join to it
                blocks = _blocks(slices, order, buckets, some, True)
                answers.append(stage(_answers(blocks, _counts(blocks, least)), f"answers{k}"))
                continue
            table = stage(count_table(counted, order, least, buckets, some), f"counts{k}")
            answers.append(stage(_answers(_blocks(slices, order, buckets, some, False).drop("own"), table), f"answers{k}"))
            stage.drop(table)
        every, scores = reduce(DataFrame.unionByName, answers), []
        for k in range(passes):
            own = F.pmod(F.xxhash64("slice"), F.lit(passes)) == k
            scores.append(stage.keep(stage(_slice_scores(slices.filter(own), every.filter(own), words, order, alpha, least), f"scores{k}")))
        return reduce(DataFrame.unionByName, scores)


def score(documents: DataFrame, order: int = ORDER, alpha: float = ALPHA, least: int = LEAST, corpus: DataFrame | None = None, passes: int | None = None, part_rows: int = PART_ROWS) -> DataFrame:
    """doc_id, n_words, n_backoff (words scored by their single-word count), n_shared (words whose n-gram of ``order`` words the corpus has more than once), log_score (natural log, summed).

    Words are runs of other than ASCII white space, A-Z lower-cased; n-grams don't cross documents. A word
    whose longest n-gram (of at most ``order`` words, as far as the text goes back) has a count of at least
    ``least`` in ``corpus`` (the documents themselves, if none is given) scores that count over its context's; else
    it backs off by ``alpha`` to the next shorter one, at last to its own count (1 if it has none) over all words.
    Null and empty texts have no words and score 0. Repeated rows count as often as they stand and give a row each; an
    empty table gives no rows; further columns are not read. A very long text is taken whole, by itself.
    """
    if order < 1:
        raise ValueError("order must be at least 1")
    with Scratch("lm") as stage:
        if corpus is None and least <= 1 and order > 1:
            rows = _numbered(documents, stage)
            found = _own_scores(rows, order, passes or PASSES, part_rows, stage)
        else:
            return _backing_off(documents, corpus, order, alpha, least, passes or BACKOFF_PASSES, stage)
        return stage.keep(stage(rows.select("row", "doc_id").join(found, "row").drop("row"), "scores"))


def rounded(documents: DataFrame, order: int = ORDER, least: int = LEAST) -> DataFrame:
    """``score`` with log_score to four decimals, as SQL can reproduce it."""
    return score(documents, order, least=least).withColumn("log_score", F.round(F.col("log_score") + 1e-9, 4))


#: Order 3 for DuckDB.
ORACLE_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '') AS words FROM documents),
w AS (SELECT r, generate_subscripts(words, 1) AS i, unnest(words) AS w FROM d),
p AS (SELECT r, i, w, lag(w) OVER (PARTITION BY r ORDER BY i) AS v, lag(w, 2) OVER (PARTITION BY r ORDER BY i) AS u FROM w),
c1 AS (SELECT w, count(*) AS c FROM p GROUP BY w),
c2 AS (SELECT v, w, count(*) AS c FROM p WHERE v IS NOT NULL GROUP BY v, w),
c3 AS (SELECT u, v, w, count(*) AS c FROM p WHERE u IS NOT NULL GROUP BY u, v, w),
s AS (SELECT r, coalesce(c3.c, 0) >= {LEAST} OR coalesce(c2.c, 0) >= {LEAST} AS hit, p.u IS NOT NULL AND coalesce(c3.c, 0) > 1 AS often,
             CASE WHEN c3.c >= {LEAST} THEN ln(c3.c) - ln(e.c)
                  WHEN c2.c >= {LEAST} THEN ln(c2.c) - ln(b.c) + CASE WHEN p.u IS NULL THEN 0 ELSE ln({ALPHA}) END
                  ELSE ln(a.c) - ln((SELECT count(*) FROM p)) + (CASE WHEN p.u IS NULL THEN 0 ELSE 1 END + CASE WHEN p.v IS NULL THEN 0 ELSE 1 END) * ln({ALPHA}) END AS value
      FROM p JOIN c1 a ON p.w = a.w LEFT JOIN c1 b ON p.v = b.w LEFT JOIN c2 ON p.v = c2.v AND p.w = c2.w
           LEFT JOIN c2 e ON p.u = e.v AND p.v = e.w LEFT JOIN c3 ON p.u = c3.u AND p.v = c3.v AND p.w = c3.w),
g AS (SELECT r, count(*) AS n_words, count(*) FILTER (hit IS NOT TRUE) AS n_backoff, count(*) FILTER (often) AS n_shared, sum(value) AS log_score FROM s GROUP BY r)
SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_backoff, 0)::BIGINT AS n_backoff, coalesce(n_shared, 0)::BIGINT AS n_shared, round(coalesce(log_score, 0) + 1e-9, 4) AS log_score
FROM d LEFT JOIN g USING (r)
"""
