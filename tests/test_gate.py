import time

import pytest
from corpusmill.operators import review
from corpusmill.plans import translate
from corpusmill.sources import fetch
from corpusmill.sources.gate import Gate, Pass
from test_answers import house_of
from test_review import SOURCE, Steady


def test_requests_of_all_partitions_keep_the_interval(spark):
    with Gate(spark, 0.05) as gate:
        ticket = gate.ticket

        def run(batches):
            import pandas as pd

            class Reply:
                headers = None
                __enter__, __exit__ = (lambda self: self), (lambda *_: None)

                def read(self):
                    return repr(time.time()).encode()

            client = fetch.HttpClient(pace=ticket.turn, opener=lambda *_, **__: Reply())
            for batch in batches:
                yield pd.DataFrame({"at": [float(client.get("http://x")) for _ in range(len(batch))]})

        at = sorted(r["at"] for r in spark.range(40).repartition(8).mapInPandas(run, "at double").collect())
    gaps = [b - a for a, b in zip(at, at[1:])]
    # a turn begins on time; it may reach its worker some milliseconds late
    assert at[-1] - at[0] > 39 * 0.05 - 0.05 and min(gaps) > 0.01


class Counting(Steady):
    """Notes in a file when a review begins and ends."""

    log = ""

    async def propose(self, source, previous, feedback):
        import asyncio

        with open(self.log, "a") as log:
            log.write(f"{time.time()} 1\n")
        await asyncio.sleep(0.1)
        with open(self.log, "a") as log:
            log.write(f"{time.time()} -1\n")
        return await super().propose(source, previous, feedback)


@pytest.mark.parametrize("leases", [1, 3])
def test_reviews_of_all_partitions_share_the_leases(spark, tmp_path, leases):
    log = str(tmp_path / "log")

    class Own(Counting):
        pass

    Own.log = log
    rows = spark.createDataFrame([{k: "x" for k in review.SOURCE} | {"question_id": i} for i in range(20) if i % 3])
    with Gate(spark, leases=leases) as gate:
        done = review.run_reviews(rows.select(*review.SOURCE), Own, concurrency=50, partitions=8, gate_pass=gate.ticket).collect()
    with open(log) as lines:
        events = sorted((float(a), int(b)) for a, b in (line.split() for line in lines))
    under_way = peak = 0
    for _, step in events:
        under_way += step
        peak = max(peak, under_way)
    assert len(done) == 13 and peak == leases


def test_a_lease_of_a_lost_worker_is_free_again_and_strangers_get_nothing(spark):
    with Gate(spark, leases=1) as gate:
        import asyncio

        async def lost():
            async with gate.ticket.lease():
                raise OSError("lost")

        async def next_one():
            async with asyncio.timeout(5), gate.ticket.lease():
                return True

        with pytest.raises(OSError):
            asyncio.run(lost())
        assert asyncio.run(next_one())
        with pytest.raises(ConnectionError):
            Pass(gate.ticket.host, gate.ticket.port, "guess").turn()


class Fatal(Steady):
    async def propose(self, source, previous, feedback):
        import asyncio

        if source["question_id"] == 3:
            raise RuntimeError("out of credit")
        await asyncio.sleep(30)


def test_the_first_failure_cancels_the_batch(spark, tmp_path):
    house, ids = house_of(spark, tmp_path, 6)
    assert 3 in ids and SOURCE
    start = time.monotonic()
    with pytest.raises(RuntimeError, match="out of credit"):
        translate.run(house, Fatal, fail_fast=True, partitions=4)
    assert time.monotonic() - start < 25
    assert spark.range(3).count() == 3  # jobs after it belong to no group
