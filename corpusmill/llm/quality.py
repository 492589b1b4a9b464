"""Document quality by co-training.

Two classifiers look at different views of a document: its text content (character classes, statistics of
words, repetition and lines) and its page metadata (language, source, the stated number of characters), which
is read from no text. Each is a logistic regression on binned features. Over several rounds each labels all unlabelled documents
of which it is confident, for the other one to learn from. Both are then calibrated on
labelled documents held out from training, and their calibrated log-odds are combined into the
score of every document.

The labelled sample is bounded: at most MOST_LABELLED documents, chosen by hash of doc_id. All
unlabelled documents take part in every round: their binned features are written once, 25 bytes
a document, and a step of the regression sums gradients and Hessians of fixed width over them.
Scoring reads every whole text.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import SMALL_BATCHES, SPACED, Words, settings, sliced, staged

#: Labelled documents that a fit takes at most.
MOST_LABELLED = 20_000
#: Rounds of exchange, and the confidence from which on a view labels a document for the other one.
ROUNDS, CONFIDENT = 4, 0.95
#: Largest change of a weight in a step of a round.
LONGEST = 1.0
#: Unlabelled documents in a task of a round, about, and in a step of it.
TASK_ROWS, STEP_ROWS = 32_768, 1_024
#: Share of labelled documents held out for calibration, and L2 penalty.
HELD_OUT, PENALTY = 0.3, 1.0
#: Quantiles of a text feature between its bins: finer in the tails, where odd documents are.
QUANTILES = (0.01, 0.03, 0.08, 0.2, 0.4, 0.6, 0.8, 0.92, 0.97, 0.99)
BINS = len(QUANTILES) + 1
#: Score (probability of good quality) from which on a document is kept.
KEEP = 0.5

_CLASSES = [b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", bytes(range(128, 256)), b".,;:'\"-?", b"!", b"#$%&*|<>{}[]=+@/\\^~`_", b"\n", b" "]
TEXT_FEATURES = 9 + 13
#: One-hot slots of the metadata view: language, source, stated number of characters (by its bit length).
_META = (17, 65, 34)


def _classes() -> np.ndarray:
    table = np.zeros((len(_CLASSES), 256), np.float32)
    for k, members in enumerate(_CLASSES):
        table[k, list(members)] = 1
    return table


_TABLE = _classes()


def text_features(texts: list[str]) -> np.ndarray:
    """One row for each text: shares of character classes, and statistics of words, repetition and lines."""
    words = Words(texts, SPACED)
    raw = np.frombuffer(words.data, np.uint8)
    original = np.frombuffer(" ".join(texts).encode("utf-8", "surrogatepass"), np.uint8)
    sizes = np.fromiter((len(t.encode("utf-8", "surrogatepass")) for t in texts), np.int64, len(texts))
    starts = np.concatenate(([0], np.cumsum(sizes + 1)))[:-1]
    out = np.zeros((len(texts), TEXT_FEATURES))
    length = (words.ends - words.starts).astype(np.float64)
    symbol = np.concatenate(([0], np.cumsum(_TABLE[6][raw]))) if len(raw) else np.zeros(1)
    marked = (symbol[words.ends] - symbol[words.starts]) > 0
    same = np.concatenate(([False], words.hashes[1:] == words.hashes[:-1])) if len(words.hashes) else np.zeros(0, bool)
    same[words.first[:-1][words.first[:-1] < len(same)]] = False  # a text's first word follows none
    for t, (a, n) in enumerate(zip(starts.tolist(), sizes.tolist())):
        if not n:
            continue
        counts = np.bincount(original[a : a + n], minlength=256)
        out[t, :9] = _TABLE @ counts / n
        first, last = int(words.first[t]), int(words.first[t + 1])
        m = last - first
        if not m:
            continue
        _, each = np.unique(words.hashes[first:last], return_counts=True)
        share = each / m
        own = length[first:last]
        lines = texts[t].split("\n")
        out[t, 9:] = (
            own.mean(), own.std(), len(each) / m, len(each) / np.sqrt(m), share.max(), -(share * np.log(share)).sum(),
            same[first:last].mean(), marked[first:last].mean(), (own <= 3).mean(), 1 - len(set(lines)) / len(lines),
            m / len(lines), math.log2(len(lines)), len(texts[t]) / len(lines),
        )
    return out


def meta_features(langs: list, sources: list, counts: list) -> np.ndarray:
    """One-hot slots of the metadata view, one for each field; what is null has a slot of its own."""
    out = np.zeros((len(langs), len(_META)), np.int64)
    for i, (lang, source, n) in enumerate(zip(langs, sources, counts)):
        out[i] = (
            16 if lang is None else zlib.crc32(str(lang).encode()) % 16,
            64 if source is None else zlib.crc32(str(source).encode()) % 64,
            33 if n is None else min(32, max(0, int(n)).bit_length()),
        )
    return out + np.concatenate(([0], np.cumsum(_META)[:-1]))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """Weights (the last is the bias) by iterated weighted least squares with an L2 penalty on all but the bias."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-6
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = x.T @ (x * (weight * p * (1 - p) + 1e-9)[:, None]) + np.diag(ridge)
        step = np.linalg.solve(h, x.T @ (weight * (y - p)) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _apply(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return x @ w[:-1] + w[-1]


@dataclass
class Model:
    """Bin edges, weights of both views, their calibrations and the combination."""

    edges: np.ndarray
    text: np.ndarray
    meta: np.ndarray
    text_scale: np.ndarray
    meta_scale: np.ndarray
    combine: np.ndarray

    def hot(self, features: np.ndarray) -> np.ndarray:
        return _hot_text(features, self.edges)

    def scores(self, features: np.ndarray, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Calibrated log-odds of good quality by text and by metadata, and the combined probability."""
        a = _apply(_apply(self.hot(features), self.text)[:, None], self.text_scale)
        b = _apply(_apply(_hot_meta(slots), self.meta)[:, None], self.meta_scale)
        return a, b, 1 / (1 + np.exp(-np.clip(_apply(np.stack([a, b], 1), self.combine), -30, 30)))


def _hot_text(features: np.ndarray, edges: np.ndarray) -> np.ndarray:
    out = np.zeros((len(features), features.shape[1] * BINS))
    for k in range(features.shape[1]):
        out[np.arange(len(features)), k * BINS + np.searchsorted(edges[k], features[:, k], side="right")] = 1
    return out


def _hot_meta(slots: np.ndarray) -> np.ndarray:
    out = np.zeros((len(slots), sum(_META)))
    out[np.arange(len(slots))[:, None], slots] = 1
    return out


#: Weights of both views, the teachers' weights and their scales -> for each view and class the number of documents, gradient and Hessian.
Sums = Callable[[list, list, list], list]
_WIDTHS = [TEXT_FEATURES * BINS + 1, sum(_META) + 1]


def _codes(features: np.ndarray, slots: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """One byte for the bin of each text feature and one for each metadata slot."""
    bins = [np.searchsorted(e, features[:, k], side="right") for k, e in enumerate(edges)]
    return np.hstack([np.stack(bins, 1), slots]).astype(np.uint8)


def _hot_codes(codes: np.ndarray) -> list[np.ndarray]:
    text = np.zeros((len(codes), TEXT_FEATURES * BINS))
    text[np.arange(len(codes))[:, None], codes[:, :TEXT_FEATURES] + np.arange(TEXT_FEATURES) * BINS] = 1
    return [text, _hot_meta(codes[:, TEXT_FEATURES:])]


def _taught(codes: np.ndarray, weights: list, teachers: list, scales: list) -> np.ndarray:
    """For each view and class (0, 1) the number of documents that the other view is sure of, their gradient and Hessian, in one array."""
    out = [np.zeros((2, w + 2, w)) for w in _WIDTHS]
    for a in range(0, len(codes), STEP_ROWS):
        views = _hot_codes(codes[a : a + STEP_ROWS])
        for k in (0, 1):
            z = _apply(views[1 - k], teachers[1 - k]) * scales[1 - k][0] + scales[1 - k][1]
            sure = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            for y, rows in ((0, 1 - sure >= CONFIDENT), (1, sure >= CONFIDENT)):
                x = np.hstack([views[k][rows], np.ones((int(rows.sum()), 1))])
                p = 1 / (1 + np.exp(-np.clip(x @ weights[k], -30, 30)))
                out[k][y, 0, 0] += len(x)
                out[k][y, 1] += x.T @ (y - p)
                out[k][y, 2:] += x.T @ (x * (p * (1 - p))[:, None])
    return np.concatenate([o.ravel() for o in out])


def _split(sums: np.ndarray) -> list[np.ndarray]:
    first = 2 * _WIDTHS[0] * (_WIDTHS[0] + 2)
    return [sums[:first].reshape(2, -1, _WIDTHS[0]), sums[first:].reshape(2, -1, _WIDTHS[1])]


def cotrain(features: np.ndarray, slots: np.ndarray, label: np.ndarray, order: np.ndarray, pool: Callable[[np.ndarray], Sums | None] | None = None) -> Model | None:
    """Fit on rows with labels 1 and 0. ``order`` (a hash) deals them to the held-out part. ``pool`` makes of the bin
    edges the sums over the unlabelled documents; without it these are the rows labelled -1.

    None without rows of both classes in the training and in the held-out part.
    """
    labelled = label >= 0
    held = labelled & (order % 1000 < HELD_OUT * 1000)
    train = labelled & ~held
    if any(len(set(label[part].tolist())) < 2 for part in (train, held)):
        return None
    edges = np.quantile(features[train], QUANTILES, axis=0).T
    views = [_hot_text(features, edges), _hot_meta(slots)]
    if pool:
        sums = pool(edges)
    else:
        codes = _codes(features[~labelled], slots[~labelled], edges)
        sums = (lambda *state: _split(_taught(codes, *state))) if len(codes) else None
    y = label[train].astype(float)
    weights = [_logistic(v[train], y, np.ones(len(y))) for v in views]
    known = [np.hstack([v[train], np.ones((len(y), 1))]) for v in views]
    for _ in range(ROUNDS if sums else 0):
        teachers = [w.copy() for w in weights]
        scales = [_logistic(_apply(v[held], w)[:, None], label[held].astype(float), np.ones(held.sum()), 1e-3) for v, w in zip(views, teachers)]
        for _ in range(25):
            most = 0.0
            for k, taught in enumerate(sums(weights, teachers, scales)):
                x, w = known[k], weights[k]
                # the taught documents of a class weigh as much as its labelled ones together, however many they are
                taught = sum(t[1:] * min(1.0, (y == c).sum() / max(1.0, t[0, 0])) for c, t in enumerate(taught))
                ridge = np.full(len(w), PENALTY)
                ridge[-1] = 1e-6
                p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
                h = x.T @ (x * (p * (1 - p) + 1e-9)[:, None]) + taught[1:] + np.diag(ridge)
                step = np.linalg.solve(h, x.T @ (y - p) + taught[0] - ridge * w)
                step *= min(1.0, LONGEST / max(LONGEST, np.abs(step).max()))  # a full one can overshoot for good where most rows are certain
                weights[k] = w + step
                most = max(most, np.abs(step).max())
            if most < 1e-3:  # the next step would be of the order of its square
                break
    y = label[held].astype(float)
    scales = [_logistic(_apply(v[held], w)[:, None], y, np.ones(len(y)), 1e-3) for v, w in zip(views, weights)]
    odds = np.stack([_apply(_apply(v[held], w)[:, None], s) for v, w, s in zip(views, weights, scales)], 1)
    return Model(edges, *weights, *scales, _logistic(odds, y, np.ones(len(y)), 1e-3))


_INPUT = ["text", "lang", "source", "n_chars"]


def _view_columns(documents: DataFrame) -> list:
    """The four columns that the views read, absent ones as nulls."""
    kinds = {"n_chars": "long"}
    return [(documents[c] if c in documents.columns else F.lit(None)).cast(kinds.get(c, "string")).alias(f"view_{c}") for c in _INPUT]


def fit(documents: DataFrame, labels: DataFrame, target: str = "quality") -> Model | None:
    """The model learnt from ``labels`` (doc_id, 0 or 1 in column ``target``) and all documents without one.

    Rows with null ids or labels don't count; a document with labels of both kinds equally often is not labelled. Of rows
    that repeat a labelled doc_id one is learnt from, so at most MOST_LABELLED rows come to the driver. Only doc_id and the
    columns that the views read are taken, by names of their own; further columns may be called anything.
    """
    votes = labels.filter(
        F.col("doc_id").isNotNull() & F.col(target).isin(0, 1)
    ).groupBy("doc_id").agg(F.avg(target).alias("vote")).filter("vote <> 0.5")
    rank = F.xxhash64("doc_id", F.lit("cotrain"))
    known = votes.select("doc_id", (F.col("vote") > 0.5).cast("int").alias("own_label")).orderBy(rank, "doc_id").limit(MOST_LABELLED)
    chosen = known.select(
        F.col("doc_id").alias("chosen_id"), "own_label",
        F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)).alias("own_order"),
    )
    # one row of each chosen id, that of the least hash, however many rows repeat it
    rows = documents.select(documents["doc_id"].alias("chosen_id"), *_view_columns(documents)).join(F.broadcast(chosen), "chosen_id")
    views = [f"view_{c}" for c in _INPUT]
    picked = rows.groupBy("chosen_id", "own_label", "own_order").agg(F.min_by(F.struct(*views), F.xxhash64(*views)).alias("views"))
    picked = picked.select("chosen_id", "own_label", "own_order", "views.*")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rest = [batch.column(k).to_pylist() for k in (4, 5, 6)]
            for a, b, texts in sliced(batch.column(3)):
                found = text_features([t or "" for t in texts])
                slots = meta_features(*[r[a:b] for r in rest])
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(k).slice(a, b - a) for k in range(3)),
                        pa.array(found.tolist(), pa.list_(pa.float64())),
                        pa.array(slots.tolist(), pa.list_(pa.int64())),
                    ],
                    ["doc_id", "label", "ordering", "text", "meta"],
                )

    with settings(documents.sparkSession, SMALL_BATCHES):
        rows = picked.mapInArrow(run, "doc_id long, label int, ordering long, text array<double>, meta array<long>").toPandas()
    if not len(rows):
        return None
    rows = rows.sort_values(["ordering", "doc_id"], kind="stable")
    return cotrain(
        np.stack(rows.text), np.stack(rows.meta), rows.label.to_numpy(), rows.ordering.to_numpy(),
        lambda edges: _pool(documents, votes, edges),
    )


def _pool(documents: DataFrame, votes: DataFrame, edges: np.ndarray) -> Sums | None:
    """The sums over all documents that have no vote. None where there are none."""
    spark = documents.sparkSession

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rest = [batch.column(k).to_pylist() for k in (2, 3, 4)]
            for a, b, texts in sliced(batch.column(1)):
                codes = _codes(text_features([t or "" for t in texts]), meta_features(*[r[a:b] for r in rest]), edges)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array([c.tobytes() for c in codes], pa.binary())],
                    ["doc_id", "codes"],
                )

    with settings(spark, SMALL_BATCHES):
        coded = staged(
            documents.select(documents["doc_id"], *_view_columns(documents)).mapInArrow(
                encode,
                T.StructType(
                    [T.StructField("doc_id", documents.schema["doc_id"].dataType), T.StructField("codes", T.BinaryType())]
                ),
            ),
            "quality-codes",
        )
    free = coded.filter("doc_id is not null").join(votes.select("doc_id"), "doc_id", "left_anti").select("codes")
    pool = staged(free.unionByName(coded.filter("doc_id is null").select("codes")), "quality-pool")
    tasks = math.ceil(pool.count() / TASK_ROWS)
    if not tasks:
        return None
    pool = pool.coalesce(tasks)

    def sums(weights: list, teachers: list, scales: list) -> list[np.ndarray]:
        state = spark.sparkContext.broadcast((weights, teachers, scales))

        def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = 0.0
            for batch in batches:
                codes = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint8).reshape(-1, TEXT_FEATURES + len(_META))
                total = total + _taught(codes, *state.value)
            if np.ndim(total):
                yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = 0.0
            for batch in batches:
                for part in batch.column(0):
                    total = total + np.frombuffer(part.as_buffer())
            if np.ndim(total):
                yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

        parts = pool.mapInArrow(one, "sums binary")
        if tasks > 16:  # a second level, so that the driver gets the square root of the number of tasks
            parts = parts.repartition(math.isqrt(tasks)).mapInArrow(add, "sums binary")
        out = sum(np.frombuffer(r.sums) for r in parts.collect())
        state.destroy()
        return _split(out)

    return sums


def with_scores(documents: DataFrame, model: Model | None) -> DataFrame:
    """``documents``, its columns renamed c0, c1, .., with text_score, meta_score, score and keep.

    Null texts are scored as empty ones. Without a model every score is neutral and every row is kept.
    """
    width = len(documents.columns)
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            rest = [batch.column(width + k).to_pylist() for k in (1, 2, 3)]
            for a, b, texts in sliced(batch.column(width)):
                if own is None:
                    found = np.zeros(b - a), np.zeros(b - a), np.full(b - a, 0.5)
                else:
                    found = own.scores(text_features([t or "" for t in texts]), meta_features(*[r[a:b] for r in rest]))
                columns = [c.slice(a, b - a) for c in batch.columns[:width]] + [pa.array(f, pa.float64()) for f in found]
                yield pa.RecordBatch.from_arrays(columns, [f"c{i}" for i in range(width)] + _SCORES)

    views = _view_columns(documents)
    rows = documents.select("*", *views)
    rows = rows.toDF(*[f"c{i}" for i in range(width)], *[f"view_{c}" for c in _INPUT])
    schema = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(documents.schema.fields)] + [T.StructField(n, T.DoubleType()) for n in _SCORES])
    return rows.mapInArrow(run, schema).withColumn("keep", F.col("score") >= KEEP)


_SCORES = ["text_score", "meta_score", "score"]


def score_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text_score, meta_score, score, keep of each row. Repeated rows give a row each; an empty table none."""
    slim = documents.select("doc_id", *[c for c in _INPUT if c in documents.columns])
    return with_scores(slim, fit(slim, labels)).select(F.col("c0").alias("doc_id"), *_SCORES, "keep")


def keep_good(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``documents``, all columns, that are kept."""
    scored = with_scores(documents, fit(documents, labels)).filter("keep")
    return scored.select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(documents.columns)])
