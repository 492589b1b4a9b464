import contextlib
import io
from collections import Counter
from hashlib import sha256

import pytest
from corpusmill.operators import draw
from pyspark.sql import functions as F


def ranks(keys, seed):
    return sorted((sha256(f"{'null' if k is None else k}|draw {seed}".encode()).hexdigest(), k is not None, k or 0, k) for k in keys)


@pytest.mark.parametrize("few", [draw.FEW, 1])
def test_exact_numbers_whatever_the_partitions(spark, monkeypatch, few):
    monkeypatch.setattr(draw, "FEW", few)
    monkeypatch.setattr(draw, "DIGITS", 1 if few == 1 else draw.DIGITS)
    rows = spark.range(300).withColumn("x", F.col("id") * 2)
    want = [k for *_, k in ranks(range(300), 5)]
    for n in (0, 1, 37, 299, 300, 400):
        got = draw.uniform(rows.repartition(n % 5 + 1), "id", n, 5)
        assert sorted(r.id for r in got.collect()) == sorted(want[:n]) and got.columns == ["id", "x"]


def test_repeated_and_null_keys(spark):
    keys = [1] * 50 + [2] * 30 + [None] * 20 + [3]
    rows = spark.createDataFrame([(k,) for k in keys], "id long").repartition(4)
    want = [k for *_, k in ranks(keys, 1)]
    for n in (1, 25, 50, 77, 101):
        assert Counter(r.id for r in draw.uniform(rows, "id", n, 1).collect()) == Counter(want[:n])
    assert draw.uniform(rows.limit(0), "id", 5).count() == 0


def test_every_row_is_as_likely(spark):
    rows = spark.range(60).cache()
    drawn = Counter(r.id for seed in range(40) for r in draw.uniform(rows, "id", 15, seed).collect())
    assert sum(drawn.values()) == 600
    spread = sum((drawn[i] - 10) ** 2 / 10 for i in range(60))  # chi-square, 59 degrees of freedom
    assert 25 < spread < 100
    assert draw.uniform(rows, "id", 15).count() == 15


def test_no_task_sees_all_rows(spark):
    told = io.StringIO()
    with contextlib.redirect_stdout(told):
        draw.uniform(spark.range(10_000).repartition(6), "id", 500, 2).explain()
    assert not any(x in told.getvalue() for x in ("SinglePartition", "TakeOrdered", "GlobalLimit", "CollectLimit"))
