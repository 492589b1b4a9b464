import math
import sys
from collections import Counter
from pathlib import Path

import pytest
from corpusmill.llm import lmscore
from corpusmill.llm.queries import table

sys.path.insert(0, str(Path(__file__).parent))
from llm_oracle import compare

SF = "/root/testdata/sf0.001"


def words(text):
    return [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ") if w]


def brute(texts, order, alpha=lmscore.ALPHA, least=lmscore.LEAST, corpus=None):
    lists = [words(t) for t in texts]
    counted = lists if corpus is None else [words(t) for t in corpus]
    counts = Counter(tuple(x[i : i + n]) for x in counted for n in range(1, order + 1) for i in range(len(x) - n + 1))
    total = max(1, sum(map(len, counted)))
    out = []
    for x in lists:
        score, single, shared = 0.0, 0, 0
        for i in range(len(x)):
            n = longest = min(order, i + 1)
            shared += longest == order and counts[tuple(x[i - order + 1 : i + 1])] > 1
            while n > 1 and counts[tuple(x[i - n + 1 : i + 1])] < least:
                n -= 1
            context = counts[tuple(x[i - n + 1 : i])] if n > 1 else total
            single += n == 1
            score += math.log(alpha) * (longest - n) + math.log(max(1, counts[tuple(x[i - n + 1 : i + 1])]) / context)
        out.append((len(x), single, shared, score))
    return out


def check(df, docs, got, *more, **options):
    got = sorted(map(tuple, got.collect()), key=str)
    want = sorted(((d, *s) for (d, _), s in zip(docs, brute([t for _, t in docs], *more, **options))), key=str)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert all(math.isclose(g[4], w[4], rel_tol=1e-9, abs_tol=1e-9) for g, w in zip(got, want))


def test_matches_sql(spark):
    got = compare(lmscore.rounded(table(spark, SF, "documents")), lmscore.ORACLE_SQL, SF)
    assert len(got) == 200 and any(r[3] for r in got)
    assert sum(r[2] for r in got) > 10 * len(got)  # n_backoff: many a word has no longer n-gram that counts


DOCS = [(1, "the cat sat on the mat the cat"), (2, "The cat\tsat\n on  a mat"), (3, None), (4, ""), (5, "x"), (5, "x"), (5, "the cat"), (None, "the cat sat on the mat the cat"), (6, "a b " * 20_000), (7, "cat sat"), (8, "mat"), (9, "cat")]


@pytest.mark.parametrize("order", [2, 3, 4])
@pytest.mark.parametrize("hot", [lmscore.HOT, 0])
def test_own_corpus_matches_brute_force(spark, monkeypatch, order, hot):
    """Each n-gram counts; with HOT 0 and small partitions frequent contexts take the way of shuffled joins."""
    monkeypatch.setattr(lmscore, "HOT", hot)
    df = spark.createDataFrame([(*d, 1) for d in DOCS], "doc_id long, text string, row int")
    check(df, DOCS, lmscore.score(df, order, least=1, passes=2, part_rows=lmscore.PART_ROWS if hot else 5_000), order, least=1)


@pytest.mark.parametrize(("order", "least"), [(1, 1), (2, 2), (3, 2), (4, 3)])
def test_backing_off_matches_brute_force(spark, order, least):
    df = spark.createDataFrame([(*d, 1) for d in DOCS], "doc_id long, text string, occ int")
    check(df, DOCS, lmscore.score(df, order, least=least), order, least=least)


def test_another_corpus_and_both_ways_agree(spark):
    other = ["the cat sat", "a mat on the floor", None, ""]
    df = spark.createDataFrame(DOCS, "doc_id long, text string")
    corpus = spark.createDataFrame([(t,) for t in other], "text string")
    for least in (1, 2):
        check(df, DOCS, lmscore.score(df, 3, least=least, corpus=corpus), 3, least=least, corpus=other)
        check(df, DOCS, lmscore.score(df, 3, least=least, corpus=df), 3, least=least)


def test_small_slices_and_buckets_agree(spark, monkeypatch):
    """Documents over many slices, n-grams over many buckets of hash values, and passes that don't divide them evenly."""
    monkeypatch.setattr(lmscore, "BUCKET_GRAMS", 1_000)
    monkeypatch.setattr(lmscore, "BUCKETS", 7)
    df = spark.createDataFrame(DOCS, "doc_id long, text string").repartition(5)
    for least in (2, 3):
        check(df, DOCS, lmscore.score(df, 3, least=least, passes=3), 3, least=least)


def test_ngrams_are_shuffled_by_blocks(spark):
    """A slice gives a row for each bucket, not for each n-gram; its counts come back as a row for each bucket."""
    df = spark.createDataFrame([(k, " ".join(f"w{k * i % 997}" for i in range(2_000))) for k in range(1, 20)], "doc_id long, text string").coalesce(1)
    with lmscore.Scratch("test") as stage:
        slices = lmscore._slices(df, stage, "slices")
        assert slices.count() == 1
        blocks = lmscore._blocks(slices, 3, 16, range(16), True)
        assert blocks.count() == 16
        table = lmscore.count_table(slices, 3, 2, 16, range(16))
        assert [r.n for r in lmscore._answers(blocks.drop("own"), table).selectExpr("size(own) AS n").collect()].count(0) == 0
        grams = Counter(tuple(x[i : i + n]) for _, t in df.collect() for x in [words(t)] for n in (1, 2, 3) for i in range(len(x) - n + 1))
        assert table.selectExpr("sum(size(grams))").first()[0] == sum(c > 1 for c in grams.values())


def test_empty_table(spark):
    df = spark.createDataFrame(DOCS, "doc_id long, text string")
    assert lmscore.score(df.limit(0)).count() == 0
    assert lmscore.score(df.limit(0), least=1).count() == 0


def test_own_corpus_exchanges_its_blocks_once_a_pass(spark):
    """The count table and the join to it read the same exchange; no n-gram's row is a list that the JVM copies one by one."""
    df = spark.createDataFrame(DOCS, "doc_id long, text string").repartition(3)
    with lmscore.Scratch("test") as stage:
        blocks = lmscore._blocks(lmscore._slices(df, stage, "slices"), 3, 16, range(16), True)
        assert {"grams": "binary", "own": "binary"}.items() <= dict(blocks.dtypes).items()
        answers = lmscore._answers(blocks, lmscore._counts(blocks, 2))
        plan = answers._jdf.queryExecution().executedPlan()
        plan.execute().count()
        shown = plan.toString().split("Initial Plan")[0]
        assert "ReusedExchange" in shown and shown.count("MapInArrow run") == 1
