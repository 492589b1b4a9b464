import random

import numpy as np
import pytest
from corpusmill.schemas import _struct
from corpusmill.sources import buckets
from corpusmill.sources.buckets import BucketTable
from hypothesis import given
from hypothesis import strategies as st

SCHEMA = _struct("id bigint, x, n int")


@given(st.sets(st.integers(-(1 << 63), (1 << 63) - 1), max_size=200), st.lists(st.integers(-(1 << 63), (1 << 63) - 1), max_size=50))
def test_a_filter_passes_what_it_was_made_of(keys, others):
    made = buckets.bloom(np.array(sorted(keys), np.int64))
    assert buckets.passes(np.array(sorted(keys), np.int64), made).all()
    assert len(buckets.passes(np.array(others, np.int64), made)) == len(others)


def test_a_filter_stops_most_others():
    made = buckets.bloom(np.arange(0, 200_000, 2))
    assert buckets.passes(np.arange(1, 200_000, 2), made).mean() < 0.02


def table(spark, tmp_path):
    return BucketTable(spark, f"file://{tmp_path}/t", SCHEMA, "id", [])


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def written(tmp_path):
    return sum(p.stat().st_size for p in (tmp_path / "t").rglob("*.parquet"))


def test_random_batches_equal_a_dictionary(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(buckets, "BUCKET_ROWS", 50)
    rng, model, t = random.Random(4), {}, table(spark, tmp_path)
    for turn in range(7):
        keys = {rng.randrange(-300, 300) for _ in range(rng.choice((1, 40, 150)))}
        gone = {rng.randrange(-300, 300) for _ in range(rng.choice((0, 3, 60)))}
        batch = [(k, f"v{turn}", turn) for k in keys]
        t = t.upsert(frame(spark, batch), frame(spark, [(k, "", 0) for k in gone] + [(None, "", 0)]).select("id") if gone else None)
        for k in gone:
            model.pop(k, None)
        model |= {k: (k, x, n) for k, x, n in batch}
        assert sorted(map(tuple, t.read().collect())) == sorted(model.values())
        assert sum(b.rows for b in t.buckets) == len(model)
        some = [rng.randrange(-300, 300) for _ in range(20)]
        found = t.lookup(spark.createDataFrame([(k,) for k in [*some, some[0]]], "k long"))
        assert sorted(map(tuple, found.collect())) == sorted(model[k] for k in set(some) & set(model))
        t = BucketTable.load(spark, t.folder, SCHEMA, "id", t.manifest())


def test_what_is_written_grows_with_the_batch(spark, tmp_path, monkeypatch):
    """A batch of neighbours, as a crawl brings it, writes as much into a table of 40 buckets as into one of 4."""
    monkeypatch.setattr(buckets, "BUCKET_ROWS", 500)
    grown = {}
    for size in (2_000, 20_000):
        folder = tmp_path / str(size)
        folder.mkdir()
        t = table(spark, folder).upsert(spark.range(size).selectExpr("id", "repeat(md5(cast(id AS string)), 5) AS x", "1 AS n"))
        assert len(t.buckets) >= size // 500
        before, files = written(folder), {b.file for b in t.buckets}
        t = t.upsert(frame(spark, [(k, "new", 2) for k in range(size - 100, size + 100)]))
        grown[size] = written(folder) - before
        assert len(files - {b.file for b in t.buckets}) <= 2 and t.read().filter("n = 2").count() == 200
        assert sum(b.rows for b in t.buckets) == size + 100
    assert grown[20_000] < 1.5 * grown[2_000]


def test_small_batches_do_not_leave_a_bucket_each(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(buckets, "BUCKET_ROWS", 100)
    t = table(spark, tmp_path)
    for k in range(12):
        t = t.upsert(frame(spark, [(2 * k, "a", k), (1000 - k, "b", k)]))
    assert len(t.buckets) <= 4 and t.read().count() == 24


def test_keys_that_are_not_there_change_nothing(spark, tmp_path):
    t = table(spark, tmp_path).upsert(frame(spark, [(k, "a", 1) for k in range(0, 1000, 2)]))
    assert t.upsert(frame(spark, []), frame(spark, [(k, "", 0) for k in range(1, 1000, 2)]).select("id")).buckets == t.buckets
    assert table(spark, tmp_path / "none").lookup(spark.range(3)).count() == 0
    with pytest.raises(TypeError):
        BucketTable.load(spark, t.folder, SCHEMA, "id", '[{"file": "x"}]')
