import math
import re

import numpy as np
from corpusmill.llm import lexical
from corpusmill.llm.queries import table
from hypothesis import given, settings
from hypothesis import strategies as st

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(text or "")]


def brute(docs, items, k=20):
    """(item_id, rank, doc_id, score) by plain dictionaries."""
    own = [(doc, terms(text)) for doc, text in docs]
    own = [(doc, t) for doc, t in own if t]
    n_docs, total = len(own), sum(len(t) for _, t in own)
    df = {}
    for _, t in own:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    out = []
    for item, text in items:
        scored = []
        for doc, t in own:
            m = 75 + (25 * len(t) * n_docs) // total
            score = 0
            for x in terms(text):
                if tf := t.count(x):
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * (10**9 * tf // (1000 * tf + 12 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scored, key=lambda s: s[:3])[:k])]
    return sorted(out, key=str)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


DOCS = [(k, f"common word{k % 7} Tail{k}") for k in range(60)] + [(k, "equal copies here") for k in range(90, 60, -1)] + [(5, "equal copies here"), (None, "equal copies here"), (100, None), (101, ""), (102, "... !!"), (103, "é" * 70_000 + " Word3 " + "filler " * 30_000 + "TAIL9"), (104, "a_b@c[d{e"), (105, "common " * 400)]
ITEMS = [(1, "COMMON word3"), (2, "equal equal copies"), (2, "tail9 nowhere"), (3, None), (4, "!?"), (5, "unknownterm"), (None, "word1 word2 common é"), (6, "é" * 70_000), (7, "a b c d e")]


def frames(spark, docs, items):
    return (spark.createDataFrame([(*d, 7, "q") for d in docs], "doc_id long, text string, n long, terms string"), spark.createDataFrame([(*i, 3) for i in items], "item_id long, text string, score int"))


def test_matches_brute_force_on_given_tables(spark):
    docs, items = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    assert rows(lexical.rank(docs, items)) == brute([(r.doc_id, r.text) for r in docs.collect()], [tuple(r) for r in items.collect()])


def test_edge_cases_blocks_and_partitions(spark, monkeypatch):
    docs, items = frames(spark, DOCS, ITEMS)
    expected = brute(DOCS, ITEMS)
    assert rows(lexical.rank(docs, items)) == expected
    assert rows(lexical.rank(docs.repartition(11), items)) == expected
    monkeypatch.setattr(lexical, "BLOCK_ROWS", 2)
    assert rows(lexical.rank(docs.repartition(3), items)) == expected


def test_ties_are_broken_by_id(spark):
    docs, items = frames(spark, DOCS, [(2, "equal equal copies")])
    assert [r.doc_id for r in lexical.rank(docs, items).orderBy("rank").collect()] == [5, *range(61, 80)]


def test_empty_tables(spark):
    docs, items = frames(spark, DOCS, ITEMS)
    assert rows(lexical.rank(docs.limit(0), items)) == rows(lexical.rank(docs, items.limit(0))) == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(0, 9), st.integers(1, 5)), max_size=6, unique_by=lambda e: e[0]), max_size=12), st.lists(st.text("abcdefghij ", max_size=12), min_size=1, max_size=5))
def test_product_equals_a_dense_one(documents, texts):
    items = lexical.Items.of(list(enumerate(texts)))
    size = len(items.vocabulary)
    entries = [(t, d, v) for d, doc in enumerate(documents) for t, v in doc if t < size]
    a, q = np.zeros((size, len(documents)), np.int64), np.zeros((len(texts), size), np.int64)
    for t, d, v in entries:
        a[t, d] = v
    for i in range(len(texts)):
        for x in range(items.first[i], items.first[i + 1]):
            q[i, items.terms[x]] += items.times[x]
    columns = [np.array([e[k] for e in entries], np.int64) for k in range(3)]
    got = [r.copy() for r in lexical.product(items, *columns, len(documents))]
    assert (np.array(got).reshape(len(texts), len(documents)) == q @ a).all()
