"""Near-duplicate documents by a chosen-path set similarity join.

Documents are sets of hashed word shingles. Equal sets fall into classes by a 128-bit set hash and their
size; the join runs over one representative of each class. Independent trees branch the
representatives by selected minwise tokens: a tree's root has one branch for each value of its
own minwise token. A node whose members could need more than WIDE * LEAF comparisons branches again on two
further tokens that the node chooses; smaller nodes are compared exhaustively, on 1024-bit
sketches (a bit each of 1024 minwise hashes), and what these cannot dismiss is confirmed on full sets.

A group of thousands of near copies stays together in every node, so all its pairs must not be
listed. Before the recursion, each node of more than LEAF comparisons compares its members with one pivot a round; confirmed
links are contracted to components, and later comparisons only concern members of different
components. Rounds go on for the nodes that gain links by them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import SMALL_BATCHES, SPACED, Scratch, Words, mix, settings, sliced, text_of

#: Words in a shingle.
SHINGLE = 5
#: Trees; a pair of similarity s is missed by all roots with probability (1 - s) ** TREES.
TREES = 8
#: Minwise tokens for branching below the roots.
BRANCHES = 24
#: Sketch bits, in words of 64.
SKETCH_WORDS = 16
LANES = 64 * SKETCH_WORDS
#: Comparisons up to which a node is compared without pivots, how many times as many without branching (which doubles a node's
#: rows, and costs more than some hundred comparisons for each), and levels below the roots at most.
LEAF, WIDE, DEPTH = 1 << 13, 16, 8
#: Comparisons that a task makes in a node that is compared although it is larger.
TASK = 1 << 22
#: Rounds of pivots at most.
ROUNDS = 4
#: Edges up to which a graph of links is finished by one task (16 bytes each).
SMALL = 1 << 18
#: Shingles in a bucket of the table of full sets, about (8 bytes each), and parts in which its texts are exchanged.
BUCKET, PARTS = 1 << 20, 2
#: Standard deviations that a sketch may fall short of the threshold.
SLACK = 4.5

_BITS = [f"b{i}" for i in range(SKETCH_WORDS)]
_random = np.random.default_rng(77)
_ROOTS = _random.integers(0, 2**63, TREES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LANES = (_random.integers(0, 2**31, LANES, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[None, :]


def shingle_sets(texts: list[str]) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a text of fewer words has one shingle, of no words none."""
    words = Words(texts, SPACED)
    hashes, at = words.windows(SHINGLE)
    cuts = np.searchsorted(at, words.first)
    for t in range(len(texts)):
        first, last = words.first[t], words.first[t + 1]
        if 0 < last - first < SHINGLE:
            own = Words([texts[t]], SPACED).windows(int(last - first))[0]
            yield mix(own + np.uint64(int(last - first)))  # unlike any whole shingle
        else:
            yield np.unique(hashes[cuts[t] : cuts[t + 1]])


def set_key(own: np.ndarray) -> tuple[int, int]:
    """A 128-bit hash of a set."""
    return int(mix(own).sum(dtype=np.uint64).astype(np.int64)), int(
        mix(own ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).astype(np.int64)
    )


def roots(own: np.ndarray) -> np.ndarray:
    """The minwise token of each tree, of a set that isn't empty."""
    return np.array([(own * a).min() for a in _ROOTS]).view(np.int64)


def sketch(own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Minwise tokens for branching (BRANCHES) and the sketch (SKETCH_WORDS) of a set that isn't empty."""
    least = np.full(LANES, 0xFFFFFFFF, np.uint32)
    low = (own >> np.uint64(32)).astype(np.uint32)
    room = np.empty((min(64, len(low)), LANES), np.uint32)
    for i in range(0, len(low), 64):
        part = low[i : i + 64, None]
        np.minimum(least, np.minimum.reduce(np.multiply(part, _LANES, out=room[: len(part)]), axis=0), out=least)
    bits = np.packbits((least * np.uint32(0x9E3779B1) >> np.uint32(31)).astype(np.uint8))
    return least[:BRANCHES].view(np.int32), bits.view(np.int64)


def text_key(documents: DataFrame) -> Column:
    """Hash of the text; null counts as empty."""
    return F.xxhash64(text_of(documents))


def _lists(rows: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """Arrays of different lengths as one Arrow list array, without Python objects for their elements."""
    ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(rows) if rows else np.empty(0, np.int64), kind))


def features(documents: DataFrame) -> DataFrame:
    """doc, text_key (hash of the text), n (set size), k1, k2 (set hash), roots (minwise tokens) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in sliced(batch.column(2)):
                sets = list(shingle_sets(texts))
                keys = [set_key(own) for own in sets]
                tokens = _lists([roots(own) if len(own) else np.empty(0, np.int64) for own in sets], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a),
                        pa.array([len(own) for own in sets], pa.int64()), pa.array([k for k, _ in keys], pa.int64()),
                        pa.array([k for _, k in keys], pa.int64()), tokens,
                    ],
                    ["doc", "text_key", "n", "k1", "k2", "roots"],
                )

    rows = documents.select(
        documents["doc_id"].cast("long").alias("doc"), text_key(documents).alias("text_key"),
        text_of(documents).alias("text"),
    )
    return rows.mapInArrow(run, "doc long, text_key long, n long, k1 long, k2 long, roots array<long>")


def _place() -> Column:
    """The number of a representative: a hash of its id and text, so that rows of documents are dealt like it."""
    return F.xxhash64("doc", "text_key")


def points(documents: DataFrame, wanted: DataFrame, buckets: int, part: int = 0, parts: int = 1) -> DataFrame:
    """rep, n, shingles, paths (minwise tokens), b0.. (sketch) of the representatives in ``wanted`` (rep, doc, text_key), or of one of ``parts`` parts of them.

    Rows are dealt by ``_place`` to ``buckets`` tasks. Those that repeat an id and text give a row for each task that
    they lie in, if Spark splits a task; see ``unique_points``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            reps = batch.column(0).to_pylist()
            first = [k for k, rep in enumerate(reps) if not (rep in seen or seen.add(rep))]
            reps = [reps[k] for k in first]
            for a, b, texts in sliced(batch.column(1).take(pa.array(first, pa.int64()))):
                sets = list(shingle_sets(texts))
                found = [sketch(own) for own in sets]
                bits = np.stack([x for _, x in found])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(reps[a:b], pa.int64()), pa.array([len(own) for own in sets], pa.int64()),
                        _lists([own.view(np.int64) for own in sets], pa.int64()),
                        _lists([x for x, _ in found], pa.int32()),
                        *(pa.array(bits[:, k]) for k in range(SKETCH_WORDS)),
                    ],
                    ["rep", "n", "shingles", "paths", *_BITS],
                )

    rows = documents.select(
        documents["doc_id"].cast("long").alias("doc"), text_key(documents).alias("text_key"),
        text_of(documents).alias("text"),
    )
    of_part = lambda df: df.withColumn("place", _place()).filter(F.pmod("place", F.lit(parts)) == part).repartition(buckets, "place")
    asked = of_part(wanted.select("rep", "doc", "text_key")).withColumnsRenamed({"doc": "own_doc", "text_key": "own_key"})
    rows = of_part(rows).join(asked.hint("shuffle_hash"), "place").filter("(doc ^ own_doc) = 0 and (text_key ^ own_key) = 0").select("rep", "text")  # no keys, by which Spark would deal
    return rows.mapInArrow(run, "rep long, n long, shingles array<long>, paths array<int>, " + ", ".join(f"{b} long" for b in _BITS))


def unique_points(documents: DataFrame, wanted: DataFrame, stage: Scratch, buckets: int = 4) -> DataFrame:
    """``points`` in buckets of rep, a row for each representative, however many rows repeat it and wherever they lie.

    Texts are exchanged in PARTS parts, so that one of them only is on disk beside the sets. Where rep is ``_place``, a
    task's rows are one bucket.
    """
    with settings(documents.sparkSession, {"spark.sql.shuffle.partitions": str(buckets)}):  # else a join may deal to more tasks
        found = stage.by([points(documents, wanted, buckets, k, PARTS) for k in range(PARTS)], "points", "rep", buckets)
    if found.count() == wanted.select("rep").count():
        return found
    return stage.by([found.dropDuplicates(["rep"])], "unique-points", "rep", buckets)


def most_distance(percent: int, slack: float = SLACK) -> int:
    """Sketch bits in which a pair at the threshold may differ."""
    p = (1 - percent / 100) / 2
    return math.ceil(LANES * p + slack * math.sqrt(LANES * p * (1 - p)))


def _alike(a: str, b: str, percent: int, slack: float = SLACK) -> Column:
    """Whether sketches and set sizes (structs ``a`` and ``b``) allow the threshold."""
    distance = reduce(Column.__add__, [F.bit_count(F.col(f"{a}.{w}").bitwiseXOR(F.col(f"{b}.{w}"))) for w in _BITS])
    return (distance <= most_distance(percent, slack)) & (F.least(f"{a}.n", f"{b}.n") * 100 >= F.greatest(f"{a}.n", f"{b}.n") * percent)


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets (rep, shingles) reach the threshold."""
    a, b = (sets.select(F.col("rep").alias(x), F.col("shingles").alias(f"s{x}")) for x in "ab")
    both = pairs.join(a, "a").join(b, "b")
    shared = F.size(F.array_intersect("sa", "sb"))
    counted = both.select("a", "b", shared.cast("long").alias("inter"), (F.size("sa") + F.size("sb") - shared).cast("long").alias("total"))
    return counted.filter(F.col("inter") * 100 >= F.col("total") * percent).select("a", "b")


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """at, to (smallest id of its component) of the ids in the edges (a, b) of one task."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    table = pa.Table.from_batches(held)
    ids, place = np.unique(np.concatenate([table.column(k).to_numpy() for k in (0, 1)]), return_inverse=True)
    u, v = place[: table.num_rows], place[table.num_rows :]
    label = np.arange(len(ids))
    while (label[u] != label[v]).any():
        least = np.minimum(label[u], label[v])
        for end in (u, v):
            np.minimum.at(label, label[end], least)
        while (label != label[label]).any():
            label = label[label]
    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(ids[label])], ["at", "to"])


def components(links: DataFrame) -> DataFrame:
    """rep, component (its smallest member) of every id in ``links`` (a, b), by repeated contraction.

    In each round every vertex moves to its neighbour of the least hash, if less than its own; the
    hash differs from round to round, so the graph shrinks by a constant share in expectation. A graph of at
    most SMALL edges is finished by one task.
    """
    with Scratch("components") as stage:
        edges = stage(links.select("a", "b").distinct(), "edges")
        moved = None
        turn = 0
        while edges.count() > SMALL:
            turn += 1
            both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
            h = F.xxhash64("v", F.lit(turn))
            step = both.groupBy("u").agg(F.min(h).alias("h"), F.min_by("v", h).alias("v"))
            step = stage(
                step.select(
                    F.col("u").alias("at"),
                    F.when(F.col("h") < F.xxhash64("u", F.lit(turn)), F.col("v")).otherwise(F.col("u")).alias("to"),
                ),
                "steps",
            )
            moved = step.withColumnsRenamed({"at": "rep", "to": "at"}) if moved is None else stage(
                moved.join(step, "at", "left").select("rep", F.coalesce("to", "at").alias("at")), "labels",
            )
            a, b = (step.select(F.col("at").alias(x), F.col("to").alias(f"to_{x}")) for x in "ab")
            edges = stage(
                edges.join(a, "a").join(b, "b").filter("to_a <> to_b").select(
                    F.col("to_a").alias("a"), F.col("to_b").alias("b"),
                ).distinct(),
                "edges",
            )
        last = stage(edges.coalesce(1).mapInArrow(_united, "at long, to long"), "last")
        if moved is None:
            return stage.keep(last).withColumnsRenamed({"at": "rep", "to": "component"})
        moved = moved.join(last, "at", "left").select("rep", F.coalesce("to", "at").alias("at"))
        least = moved.groupBy("at").agg(F.min("rep").alias("component"))
        return stage.keep(stage(moved.join(least, "at").select("rep", "component"), "found"))


def _mixed(rows: DataFrame) -> DataFrame:
    """node, size, most, major (its largest component) of the nodes with members (rep, component) of several components."""
    shares = rows.groupBy("node", "component").agg(F.count("*").alias("share"))
    mixed = shares.groupBy("node").agg(
        F.sum("share").alias("size"), F.max("share").alias("most"),
        F.max_by("component", F.struct("share", "component")).alias("major"), F.count("*").alias("kinds"),
    )
    return mixed.filter("kinds > 1").drop("kinds")


def _work() -> Column:
    """Comparisons of a node: of each member outside its largest component with all."""
    return (F.col("size") - F.col("most")) * F.col("size")


def _point(df: DataFrame, key: str, sketches: DataFrame, name: str) -> DataFrame:
    """Add the sketch and set size of the representative in column ``key``."""
    return df.join(sketches.select(F.col("rep").alias(key), F.struct("n", *_BITS).alias(name)), key)


def _pivot_links(nodes: DataFrame, sketches: DataFrame, percent: int, stage: Scratch) -> tuple[DataFrame, DataFrame]:
    """Confirmed links of the members of large nodes with one pivot a round, and the component of each linked representative.

    A round's pivot is a member of the node's largest component so far; members of that component
    need no comparison with it. So a round makes at most a row for each member and node.
    """
    links = nodes.select(F.col("rep").alias("a"), F.col("rep").alias("b")).filter(F.lit(False))
    joined = nodes.select("rep", F.col("rep").alias("component")).filter(F.lit(False))
    alive = nodes
    for turn in range(ROUNDS):
        rows = alive.join(joined, "rep", "left").select("node", "rep", F.coalesce("component", "rep").alias("component"))
        large = _mixed(rows).filter(_work() > LEAF).select("node", "major", "most")
        rows = stage(rows.join(large, "node"), "large")
        chosen = F.col("component") == F.col("major") if turn else F.lit(True)
        pivots = rows.filter(chosen).groupBy("node").agg(
            F.min_by("rep", F.xxhash64("rep", "node", F.lit(turn))).alias("b"), F.first("component").alias("home"),
        )
        near = rows.join(pivots, "node").filter((F.col("rep") != F.col("b")) & (F.lit(turn == 0) | (F.col("component") != F.col("home"))))
        near = _point(
            _point(near.select("node", "rep", "b"), "rep", sketches, "x"), "b", sketches, "y",
        ).filter(_alike("x", "y", percent, 0.0))
        near = stage(near.select("node", F.col("rep").alias("a"), "b"), "near")
        fresh = stage(confirm(near.select("a", "b").distinct(), sketches, percent), "pivot-links")
        if fresh.isEmpty():
            break
        links = links.union(fresh)
        joined = components(links)
        if turn == ROUNDS - 1:
            break
        alive = rows.select("node", "rep").join(near.join(fresh, ["a", "b"], "left_semi").select("node").distinct(), "node", "left_semi")
    return links, joined


def linked(nodes: DataFrame, sketches: DataFrame, percent: int, stage: Scratch) -> DataFrame:
    """rep, component of the members of ``nodes`` (node, rep) that confirmed links connect with others."""
    links, joined = _pivot_links(nodes, sketches, percent, stage)
    rows = nodes.join(joined, "rep", "left").select(
        "node", "rep", F.coalesce("component", "rep").alias("component"), F.lit(None).cast("long").alias("parent"),
    )
    small = []
    for level in range(DEPTH + 1):
        rows = stage(rows.join(_mixed(rows), "node").withColumn("work", _work()), f"level{level}")
        # dense: a branch hardly smaller than its parent would not get small by further ones
        leaf = (F.col("work") <= WIDE * LEAF) | F.coalesce(F.col("work") * 2 > F.col("parent"), F.lit(False)) | F.lit(level == DEPTH)
        small.append(rows.filter(leaf).select("node", "rep"))
        large = rows.filter(~leaf)
        if level == DEPTH or large.isEmpty():
            break
        large = large.select("node", "rep", "component", "work").join(sketches.select("rep", "paths"), "rep")
        branch = F.explode(
            F.transform(
                F.array(F.lit(0), F.lit(1)),
                lambda j: F.xxhash64(
                    "node", j,
                    F.element_at(
                        "paths", (F.pmod(F.xxhash64("node", j), F.lit(BRANCHES // 2)) * 2 + j + 1).cast("int"),
                    ),
                ),
            )
        )
        rows = large.select(branch.alias("node"), "rep", "component", F.col("work").alias("parent"))
    leaves = reduce(DataFrame.union, small)
    # first the pairs that look linked: what they contract needs no further comparison
    for slack in (0.0, SLACK):
        rows = leaves.join(joined, "rep", "left").select("node", "rep", F.coalesce("component", "rep").alias("component"))
        pairs = stage(_leaf_pairs(stage(rows.join(_mixed(rows), "node"), "leaves"), sketches, percent, slack), f"candidates{slack:.0f}")
        links = links.union(stage(confirm(pairs, sketches, percent), "links"))
        joined = components(links)
    return joined


def _leaf_pairs(members: DataFrame, sketches: DataFrame, percent: int, slack: float) -> DataFrame:
    """a, b: pairs of different components that a leaf has in common and whose sketches allow the threshold, each once."""
    leaves = members.groupBy("rep").agg(F.collect_list("node").alias("leaves"))  # at most TREES * 2 ** DEPTH
    salts = F.when(_work() <= TASK, 1).otherwise(F.ceil(F.sqrt(_work()) / math.isqrt(TASK))).cast("int")
    known = sketches.select("rep", F.struct("n", *_BITS).alias("y")).join(leaves, "rep")
    members = members.withColumn("salts", salts).join(known, "rep")
    minor = members.filter("component <> major").select(
        "node", F.col("rep").alias("a"), F.col("component").alias("own"), F.col("y").alias("x"),
        F.col("leaves").alias("a_leaves"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"),
    )
    dealt = members.withColumn("salt", F.pmod(F.xxhash64("rep"), F.col("salts")).cast("int"))
    once = (F.col("component") == F.col("major")) | (F.col("a") < F.col("rep"))
    first = F.col("node") == F.array_min(F.array_intersect("a_leaves", "leaves"))  # each pair in one of its common nodes
    pairs = minor.join(dealt, ["node", "salt"]).filter(
        (F.col("own") != F.col("component")) & once & _alike("x", "y", percent, slack) & first
    )
    return pairs.select(F.least("a", "rep").alias("a"), F.greatest("a", "rep").alias("b"))


def near_duplicates(documents: DataFrame, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of each row: documents linked where 100 * |A & B| >= percent * |A | B|.

    Null and empty texts, and texts without words, have an empty set and are linked with nothing, as are
    rows with a null doc_id (their component is null; they are kept). Rows with equal sets are linked; rows
    that share a doc_id give a row each, whose component is that of their own text. Further columns are not read.
    An empty table gives no rows. A very long text is taken whole: its set is one array, of eight bytes for each
    different shingle.
    """
    return judged_rows(documents, percent).drop("text_key")


def judged_rows(documents: DataFrame, percent: int) -> DataFrame:
    """``near_duplicates`` with ``text_key``, which tells rows of one doc_id and different texts apart."""
    with Scratch("near") as stage, settings(documents.sparkSession, SMALL_BATCHES):
        every = stage.keep(stage(features(documents), "features"))
        whole = every.filter("n > 0 and doc is not null")
        own = F.min(F.struct("doc", "text_key")).alias("own")
        classes = whole.groupBy("k1", "k2", "n").agg(own, F.first("roots").alias("roots"))  # equal sets, equal roots
        reps = stage(classes.select("k1", "k2", "n", "own.*", "roots").withColumn("rep", _place()), "classes")
        tokens = reps.select("rep", F.posexplode("roots").alias("tree", "token")).select(F.xxhash64("tree", "token").alias("node"), "rep")
        several = tokens.groupBy("node").agg(F.count("*").alias("members")).filter("members > 1").select("node")
        nodes = stage(tokens.join(several, "node"), "nodes")
        wanted = reps.select("rep", "doc", "text_key", "n").join(nodes.select("rep").distinct(), "rep", "left_semi")
        wanted = stage(wanted, "wanted")
        sizes = wanted.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        sketches = unique_points(documents, wanted, stage, max(4, math.ceil(sizes / BUCKET)))
        joined = linked(nodes, sketches, percent, stage)
        known = reps.select("k1", "k2", "n", "doc", "rep").join(joined, "rep", "left").withColumn(
            "component", F.coalesce("component", "rep"),
        )
        least = known.groupBy("component").agg(F.min("doc").alias("smallest"))
        known = stage.keep(stage(known.join(least, "component").select("k1", "k2", "n", "smallest"), "known"))
    rows = every.select("doc", "text_key", "n", "k1", "k2").join(known, ["k1", "k2", "n"], "left")
    own = F.when(F.col("doc").isNull(), F.lit(None)).otherwise(F.when(F.col("n") > 0, F.col("smallest")).otherwise(F.col("doc")))
    return rows.select(
        F.col("doc").alias("doc_id"), "text_key", F.col("n").alias("n_shingles"),
        own.cast("long").alias("component_id"), F.coalesce(F.col("doc") == own, F.lit(True)).alias("kept"),
    )


#: ``near_duplicates`` at 85 percent for DuckDB, by all pairs that share a shingle.
ORACLE_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(w[i : i + {SHINGLE - 1}], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {SHINGLE - 2}, 2))) AS i FROM d WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS MATERIALIZED (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
e AS MATERIALIZED (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS other FROM n UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.other = e.a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(m.c, d.doc_id) AS component_id, coalesce(m.c, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN (SELECT doc_id, min(other) AS c FROM r GROUP BY doc_id) m ON m.doc_id = d.doc_id
"""
