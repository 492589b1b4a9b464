import random
import re
from collections import Counter

import numpy as np
import pytest
from corpusmill.llm import neardup
from corpusmill.llm.queries import table
from pyspark.sql import functions as F

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = SPACE.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(docs, percent):
    """Components by comparing every pair that shares a shingle."""
    sets = [(d, shingles(t)) for d, t in docs]
    parent = list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    places, seen = {}, set()
    for i, (d, s) in enumerate(sets):
        for x in s if d is not None else ():
            for j in places.setdefault(x, []):
                if (j, i) not in seen:
                    seen.add((j, i))
                    inter = len(s & sets[j][1])
                    if 100 * inter >= percent * (len(s) + len(sets[j][1]) - inter):
                        parent[root(i)] = root(j)
            places[x].append(i)
    least = {}
    for i, (d, _) in enumerate(sets):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    out = []
    for i, (d, s) in enumerate(sets):
        c = None if d is None else least[root(i)] if s else d
        out.append((d, len(s), c, d is None or d == c))
    return sorted(out, key=str)


def found(docs, percent):
    return sorted(map(tuple, neardup.near_duplicates(docs, percent).collect()), key=str)


def test_given_documents(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = found(docs, 85)
    assert got == brute(rows, 85) and any(not r[3] for r in got)


def edited(base, edits, rnd):
    words = list(base)
    for _ in range(edits):
        words[rnd.randrange(len(words))] = f"w{rnd.randrange(10**6)}"
    return " ".join(words)


def test_edges(spark):
    docs = [(5, "One two\tthree"), (4, "one TWO  three"), (9, "one two three four"), (1, None), (2, ""), (3, " \n"), (7, "a b c d e"), (7, "a b c d e"), (8, "a b c d e f"), (None, "a b c d e"), (6, "x " * 40_000), (11, "x x x x x"), (12, "p q r s t"), (12, "a b c d e")]
    df = spark.createDataFrame([(*d, 0) for d in docs], "doc_id long, text string, n long")
    assert found(df, 85) == brute(docs, 85)
    assert neardup.near_duplicates(df.limit(0)).count() == 0


def test_large_group_branches_and_loses_no_link(spark, monkeypatch):
    """Near copies and a shared passage make nodes that branch; the levels that were reached are recorded."""
    rnd = random.Random(4)
    base = [f"t{rnd.randrange(5000)}" for _ in range(160)]
    passage = [f"p{i}" for i in range(80)]
    docs = [(i, edited(base, rnd.choice([1, 2, 3, 5, 8]), rnd)) for i in range(150)]
    docs += [(500 + i, " ".join(passage) + " " + " ".join(f"u{rnd.randrange(10**6)}" for _ in range(60))) for i in range(120)]
    docs += [(900 + i, t) for i, (_, t) in enumerate(docs[::9])]
    rnd.shuffle(docs)
    monkeypatch.setattr(neardup, "LEAF", 200)
    monkeypatch.setattr(neardup, "TASK", 900)
    tables = Counter()
    stage = neardup.Scratch.__call__

    def recorded(self, df, label):
        out = stage(self, df, label)
        tables[label] += out.count()
        return out

    monkeypatch.setattr(neardup.Scratch, "__call__", recorded)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for percent in (80, 85):
        tables.clear()
        assert found(df, percent) == brute(docs, percent)
        assert tables["level1"] and tables["pivot-links"]
        # pairs stay below the members of all nodes, far from all pairs of the group
        assert tables["near"] <= tables["nodes"] and tables["candidates0"] + tables["candidates4"] <= 3 * tables["nodes"]


def test_default_limits_branch_on_a_shared_passage(spark):
    """With the limits that are shipped, nodes of a passage that 400 documents share branch, and the result is exact."""
    rnd = random.Random(6)
    passage = [f"p{i}" for i in range(100)]
    docs = [(i, " ".join(passage) + " " + " ".join(f"u{rnd.randrange(10**6)}" for _ in range(rnd.choice([2, 5, 20, 60])))) for i in range(400)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert found(df, 85) == brute(docs, 85)


def test_node_of_some_hundred_members_does_not_branch(spark, monkeypatch):
    """A passage of 200 documents without links: compared at once, where branches would double the rows at each level."""
    rnd = random.Random(8)
    passage = [f"p{i}" for i in range(100)]
    docs = [(i, " ".join(passage) + " " + " ".join(f"u{rnd.randrange(10**6)}" for _ in range(60))) for i in range(200)]
    tables = Counter()
    stage = neardup.Scratch.__call__

    def recorded(self, df, label):
        out = stage(self, df, label)
        tables[label] += out.count()
        return out

    monkeypatch.setattr(neardup.Scratch, "__call__", recorded)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert found(df, 85) == brute(docs, 85)
    assert tables["level0"] > 200 and not tables["level1"]


def test_sketch_estimates_similarity():
    rnd = np.random.default_rng(1)
    common = rnd.integers(0, 2**63, 900, dtype=np.uint64)
    a, b = (np.unique(np.concatenate([common, rnd.integers(0, 2**63, 50, dtype=np.uint64)])) for _ in range(2))
    bits = [np.unpackbits(neardup.sketch(x)[1].view(np.uint8)) for x in (a, b)]
    assert abs((1 - 2 * (bits[0] != bits[1]).mean()) - 0.9) < 0.08


@pytest.mark.parametrize("small", [neardup.SMALL, 10, 0])
def test_components(spark, monkeypatch, small):
    monkeypatch.setattr(neardup, "SMALL", small)
    chain = [(i, i + 1) for i in range(60)] + [(100, 101), (100, 102), (300, 200)]
    got = {r.rep: r.component for r in neardup.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(61), 0), 100: 100, 101: 100, 102: 100, 200: 200, 300: 200}
    assert neardup.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_repeated_rows_over_many_partitions_make_one_point_and_one_link(spark):
    """Two near copies, each repeated in every partition, beside their classes of one."""
    words = [f"w{i}" for i in range(200)]
    a, b = " ".join(words), " ".join([*words[:-3], "x", "y", "z"])
    for parts in (8, 64):
        docs = spark.createDataFrame([(k % 2, (a, b)[k % 2]) for k in range(20 * parts)] + [(7, "alone it stands")], "doc_id long, text string").repartition(parts)
        wanted = spark.createDataFrame([(100, 0), (101, 1)], "rep long, doc long").join(docs.select("doc_id", neardup.text_key(docs).alias("text_key")).distinct(), F.col("doc") == F.col("doc_id")).select("rep", "doc", "text_key")
        with neardup.Scratch("test") as stage:
            found = neardup.unique_points(docs, wanted, stage)
            assert sorted(r.rep for r in found.collect()) == [100, 101]
            nodes = spark.createDataFrame([(n, r) for n in range(8) for r in (100, 101)], "node long, rep long")
            members = nodes.withColumn("component", F.col("rep")).join(neardup._mixed(nodes.withColumn("component", F.col("rep"))), "node")
            pairs = neardup._leaf_pairs(members, found, 85, 0.0)
            assert [tuple(r) for r in pairs.collect()] == [(100, 101)]
        got = {tuple(r) for r in neardup.near_duplicates(docs, 85).collect()}
        assert got == {(0, 196, 0, True), (1, 196, 0, False), (7, 1, 7, True)}


def test_joins_read_full_sets_where_they_lie(spark):
    """Full sets are in buckets of their representatives, a file of each part in each bucket; confirming exchanges the pairs only."""
    docs = spark.createDataFrame([(k, " ".join(f"w{k % 50 * 100 + i}" for i in range(40))) for k in range(300)], "doc_id long, text string").repartition(7)
    wanted = docs.select(F.col("doc_id").alias("doc"), neardup.text_key(docs).alias("text_key")).withColumn("rep", neardup._place())
    with neardup.Scratch("test") as stage, neardup.settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        sets = neardup.unique_points(docs, stage(wanted, "wanted"), stage, 5)
        assert sets.count() == 300 and len(sets.inputFiles()) <= 5 * neardup.PARTS
        reps = sets.select("rep", F.element_at("shingles", 1).alias("least"))
        a, b = (reps.withColumnRenamed("rep", x) for x in "ab")
        links = neardup.confirm(stage(a.join(b, "least").filter("a < b").select("a", "b"), "pairs"), sets, 85)
        assert links._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2
        assert links.count() == 50 * 15  # six equal sets of each kind
