"""Centroid clustering by exponion search, exact over integer vectors.

Every vector keeps an upper bound on the distance to its centroid and a lower bound on that to any other one. While
the upper bound is the smaller one the centroid stays as it is. Otherwise the distance is computed, and if that does
not settle it, only the centroids in a ball around the vector's own centroid are scanned: those within twice the
vector's distance plus the distance from that centroid to its nearest neighbour, a prefix of that centroid's list of
others, sorted by distance. The ball's edge belongs to it and a vector stays only by a strict comparison, so
centroids at equal distances are all seen, and the smallest number wins.

Bounds are doubles, rounded away from each other; whatever is decided between centroids is decided on exact integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import Scratch, settings

#: Components of a vector, centroids, and rounds of assignment and replacement before the last assignment.
DIMENSIONS, CENTROIDS, ROUNDS = 64, 16, 3
#: Steps in a unit of a component.
SCALE = 64
#: Components of this size and more are refused: squared distances of 64 of them would not fit a long.
LARGEST = 1 << 27
#: Components up to which products are exact in doubles, so that BLAS may multiply.
EXACT = 1 << 22
#: Relative room that a bound is given for the rounding of roots, sums and differences.
ROOM = 1e-12
#: Vectors taken at once.
ROWS = 1 << 14


@dataclass(frozen=True)
class Centroids:
    """Centroids as rows of integers, and how far each moved in the last round (an upper bound)."""

    rows: np.ndarray
    moved: np.ndarray

    def lists(self) -> tuple[np.ndarray, np.ndarray]:
        """For each centroid all of them, sorted by distance from it (itself first), and these distances, rounded down."""
        gaps = self.rows[:, None, :] - self.rows[None, :, :]
        apart = np.sqrt((gaps.astype(object) ** 2).sum(axis=2).astype(np.float64)) * (1 - ROOM)
        np.fill_diagonal(apart, -1.0)
        order = np.argsort(apart, axis=1, kind="stable")
        apart = np.take_along_axis(apart, order, axis=1)
        apart[:, 0] = 0.0
        return order, apart


def moves(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """An upper bound on the distance between each centroid and what replaces it."""
    return np.sqrt(((after - before).astype(object) ** 2).sum(axis=1).astype(np.float64)) * (1 + ROOM)


def squares(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of all vectors to all given centroids."""
    largest = max(int(np.abs(vectors).max(initial=0)), int(np.abs(centroids).max(initial=0)))
    if largest <= EXACT:
        x, c = vectors.astype(np.float64), centroids.astype(np.float64)
        return ((x * x).sum(axis=1)[:, None] - 2.0 * (x @ c.T) + (c * c).sum(axis=1)[None, :]).astype(np.int64)
    out = np.empty((len(vectors), len(centroids)), np.int64)
    for j, c in enumerate(centroids):
        gap = vectors - c
        out[:, j] = (gap * gap).sum(axis=1)
    return out


def _nearest(found: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The least distance (ties: smaller number; ``numbers`` ascend), its centroid, and the second least distance."""
    best = found.argmin(axis=1)
    least = found[np.arange(len(found)), best]
    if found.shape[1] == 1:
        return least, numbers[best], np.full(len(found), -1, np.int64)
    return least, numbers[best], np.partition(found, 1, axis=1)[:, 1]


def _above(square: np.ndarray) -> np.ndarray:
    return np.sqrt(square.astype(np.float64)) * (1 + ROOM)


def _below(square: np.ndarray) -> np.ndarray:
    return np.where(square < 0, np.inf, np.sqrt(np.maximum(square, 0).astype(np.float64)) * (1 - ROOM))


def first_search(vectors: np.ndarray, known: Centroids) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Centroid, upper and lower bound of each vector, from all distances."""
    least, own, second = _nearest(squares(vectors, known.rows), np.arange(len(known.rows)))
    return own, _above(least), _below(second)


def search(vectors: np.ndarray, own: np.ndarray, upper: np.ndarray, lower: np.ndarray, known: Centroids) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Centroid, upper and lower bound of each vector after the centroids moved, and how many distances that took."""
    own, k = own.copy(), len(known.rows)
    if k == 1:
        return own, upper + known.moved[own], lower, 0
    order, apart = known.lists()
    farthest = np.argmax(known.moved)
    others = np.full(k, known.moved[farthest])
    others[farthest] = np.delete(known.moved, farthest).max(initial=0.0)
    upper = (upper + known.moved[own]) * (1 + ROOM)
    lower = (lower - others[own]) * np.where(lower > others[own], 1 - ROOM, 1 + ROOM)
    near = apart[:, 1]  # from each centroid to its nearest neighbour
    enough = np.maximum(lower, near[own] / 2)
    open_ = np.flatnonzero(upper >= enough)
    if not len(open_):
        return own, upper, lower, 0
    gap = vectors[open_] - known.rows[own[open_]]
    upper[open_] = _above((gap * gap).sum(axis=1))
    scanned = len(open_)
    open_ = open_[upper[open_] >= enough[open_]]
    radius = (2 * upper[open_] + near[own[open_]] * (1 + 3 * ROOM)) * (1 + ROOM)
    reach = np.empty(len(open_), np.int64)
    for c in np.unique(own[open_]):
        here = own[open_] == c
        reach[here] = np.searchsorted(apart[c], radius[here], side="right")  # the edge belongs to the ball
    for c, count in {*zip(own[open_].tolist(), reach.tolist())}:
        rows = open_[(own[open_] == c) & (reach == count)]
        ball = np.sort(order[c, :count])
        least, nearest, second = _nearest(squares(vectors[rows], known.rows[ball]), ball)
        own[rows], upper[rows], lower[rows] = nearest, _above(least), _below(second)
        scanned += len(rows) * count
    return own, upper, lower, scanned


def _steps(column: Column) -> Column:
    """The vector in steps, or null where it is not kept; no arithmetic is done on what is not."""
    x = F.transform(column, lambda v: v.cast("double"))
    whole = (F.size(x) == DIMENSIONS) & F.forall(x, lambda v: v.isNotNull() & (F.abs(v) * SCALE < float(LARGEST)))
    return F.when(whole, F.transform(x, lambda v: F.floor(v * SCALE).cast("int")))


def kept(embeddings: DataFrame) -> DataFrame:
    """vec_id, steps (array<int>) of the vectors that take part; a NaN compares as larger than any number in Spark."""
    rows = embeddings.select(embeddings["vec_id"].cast("long").alias("vec_id"), _steps(embeddings["embedding"]).alias("steps"))
    return rows.filter(F.col("steps").isNotNull())


def _stack(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i4").reshape(-1, DIMENSIONS).astype(np.int64)


def _taken(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


_STATE = "vec_id long, vector binary, cluster int, upper double, lower double"


def _state(part: pa.RecordBatch, packed: pa.Array, own: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([part.column(0), packed, pa.array(own, pa.int32()), pa.array(upper), pa.array(lower)], ["vec_id", "vector", "cluster", "upper", "lower"])


def begin(rows: DataFrame, known: Centroids) -> DataFrame:
    """The state of ``rows`` (vec_id, steps) after the first assignment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _taken(batches):
            flat = part.column(1).flatten().to_numpy(zero_copy_only=False).astype("<i4")
            vectors = flat.reshape(-1, DIMENSIONS)
            packed = pa.array([v.tobytes() for v in vectors], pa.binary())
            yield _state(part, packed, *first_search(vectors.astype(np.int64), known))

    return rows.mapInArrow(run, _STATE)


def advance(state: DataFrame, known: Centroids) -> DataFrame:
    """The state after the centroids moved to ``known``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _taken(batches):
            own, upper, lower = (part.column(k).to_numpy() for k in (2, 3, 4))
            yield _state(part, part.column(1), *search(_stack(part.column(1)), own, upper, lower, known)[:3])

    return state.mapInArrow(run, _STATE)


def means(state: DataFrame, before: np.ndarray) -> np.ndarray:
    """The floored means of the clusters; those without vectors stay. A task hands on one row for each cluster."""
    names = [f"s{i}" for i in range(DIMENSIONS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((len(before), DIMENSIONS), np.int64), np.zeros(len(before), np.int64)
        for part in _taken(batches):
            own, vectors = part.column(0).to_numpy(), _stack(part.column(1))
            count += np.bincount(own, minlength=len(before))
            for c in np.unique(own):
                total[c] += vectors[own == c].sum(axis=0)
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(count[some]), *(pa.array(total[some, i]) for i in range(DIMENSIONS))], ["cluster", "n", *names])

    parts = state.select("cluster", "vector").mapInArrow(run, "cluster int, n long, " + ", ".join(f"{n} long" for n in names))
    sums = parts.groupBy("cluster").agg(*[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ["n", *names]])
    after = before.copy()
    for row in sums.collect():  # a row for each centroid
        after[row.cluster] = [int(row[n]) // int(row.n) for n in names]
    return after


def starts(rows: DataFrame, k: int = CENTROIDS) -> np.ndarray:
    """The k vectors of the least hash of their number, in its order; of rows that share a number, by their components."""
    ranked = rows.filter("vec_id is not null").withColumn("hash", F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256))
    found = ranked.select("hash", "steps").orderBy("hash", "steps").limit(k).collect()
    return np.array([r.steps for r in found], np.int64).reshape(-1, DIMENSIONS)


def cluster(embeddings: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """vec_id, vector, cluster, upper, lower of each vector that takes part, and the centroids.

    The state is written once a round, as the vectors with their bounds, and the round before it is deleted; what goes to
    the driver is a row for each centroid.
    """
    with Scratch("exponion") as stage, settings(embeddings.sparkSession, {"spark.sql.parquet.compression.codec": "zstd"}):
        rows = kept(embeddings)
        first = starts(rows, k)
        if not len(first):  # no vector at all, or none with a number
            nothing = rows.limit(0).select("vec_id", F.lit(b"").alias("vector"), F.lit(0).alias("cluster"), F.lit(0.0).alias("upper"), F.lit(0.0).alias("lower"))
            return nothing, first
        known = Centroids(first, np.zeros(len(first)))
        state = stage(begin(rows, known), "state")
        for _ in range(rounds):
            after = means(state, known.rows)
            known = Centroids(after, moves(known.rows, after))
            before, state = state, stage(advance(state, known), "state")
            stage.drop(before)
        return stage.keep(state), known.rows


def clusters(embeddings: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of each vector that takes part.

    Vectors with other than 64 components, or with one that is null, no finite number or of 2**21 and more (its squared
    distances would not fit a long), are left out. Repeated rows count each by itself. Rows without a vec_id are clustered
    but never a first centroid; with no other rows there are no centroids and no result. With fewer than ``k`` vectors
    there are so many centroids. An inertia that does not fit a long is null. An empty table gives no rows. Further columns
    are not read.
    """
    state, centroids = cluster(embeddings, k, rounds)
    with Scratch("exponion") as stage:

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in _taken(batches):
                gap = _stack(part.column(1)) - centroids[part.column(2).to_numpy()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array((gap * gap).sum(axis=1))], ["vec_id", "cluster", "distance"])

        rows = stage.keep(stage(state.select("vec_id", "vector", "cluster").mapInArrow(run, "vec_id long, cluster int, distance long"), "found"))
    sums = {r.cluster: int(r.total) for r in rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    table = [(c, _long(total), _long(sum(sums.values())), shas[c]) for c, total in sorted(sums.items())]  # a row for each centroid
    facts = rows.sparkSession.createDataFrame(table, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _long(total: int) -> int | None:
    return total if total < 1 << 63 else None


def _sql() -> str:
    """``clusters`` for DuckDB, the rounds written out."""
    assigned = """a{r} AS MATERIALIZED (SELECT i, c, s FROM (SELECT v.i, c.c, list_sum(list_transform(range(1, {d1}), lambda j: ((v.x[j] - c.x[j]) * (v.x[j] - c.x[j]))::HUGEINT))::BIGINT AS s FROM v CROSS JOIN c{r} c) QUALIFY row_number() OVER (PARTITION BY i ORDER BY s, c) = 1)"""
    replaced = """m{r} AS MATERIALIZED (SELECT c, list(m ORDER BY j) AS x FROM (SELECT c, j, ((t - ((t % n) + n) % n) // n)::BIGINT AS m FROM (SELECT c, j, sum(x)::HUGEINT AS t, count(*)::HUGEINT AS n FROM (SELECT a.c, unnest(v.x) AS x, unnest(range(1, {d1})) AS j FROM v JOIN a{r} a USING (i)) GROUP BY c, j)) GROUP BY c),
c{s} AS MATERIALIZED (SELECT o.c, coalesce(m.x, o.x) AS x FROM c{r} o LEFT JOIN m{r} m USING (c))"""
    parts = [
        f"k AS (SELECT vec_id, embedding FROM embeddings WHERE len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIMENSIONS})",
        f"v AS MATERIALIZED (SELECT row_number() OVER () AS i, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS x FROM k)",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, x) - 1 AS c, x FROM (SELECT sha256('1:' || vec_id) AS h, x FROM v ORDER BY h, x LIMIT {CENTROIDS}))",
    ]
    for r in range(ROUNDS):
        parts += [assigned.format(r=r, d1=DIMENSIONS + 1), replaced.format(r=r, s=r + 1, d1=DIMENSIONS + 1)]
    parts.append(assigned.format(r=ROUNDS, d1=DIMENSIONS + 1))
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, a.c::INT AS cluster, s AS distance, (sum(s) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia, (sum(s) OVER ())::BIGINT AS inertia, sha256(array_to_string(o.x, ',')) AS centroid_sha256
FROM a{ROUNDS} a JOIN v USING (i) JOIN c{ROUNDS} o ON o.c = a.c"""


ORACLE_SQL = _sql()
