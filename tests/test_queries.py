import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
from corpusmill.plans.queries import LIMIT, ORACLE_SQL, QUERIES
from oracle import duck

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_sql(spark, name):
    df = QUERIES[name](spark, SF)
    names, rows = duck(ORACLE_SQL[name], SF)
    assert sorted(df.columns) == sorted(names)
    order = sorted(names)
    got = sorted((tuple(r[n] for n in order) for r in df.collect()), key=str)
    want = sorted((tuple(r[names.index(n)] for n in order) for r in rows), key=str)
    assert got == want and got


def test_random_sample_has_distinct_rows(spark):
    rows = [r.doc_id for r in QUERIES["sample_random"](spark, SF).collect()]
    assert len(rows) == len(set(rows)) == LIMIT


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 189
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_every_odd_event_reaches_the_batch(spark):
    last = {}
    for r in spark.read.parquet(f"{SF}/events.parquet").filter("event_id % 2 = 1").collect():
        last[r.user_id] = max(r.event_id, last.get(r.user_id, r.event_id))
    got = {r.user_id: r.event_id for r in QUERIES["upsert_latest"](spark, SF).collect()}
    assert last and all(got[u] == e for u, e in last.items())
