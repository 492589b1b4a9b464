"""The review run: draw pending records, review them, store what completed, report the spend."""

from __future__ import annotations

import argparse
import functools
import importlib
import sys
import time
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..functions import values
from ..operators import funnel, merge, review
from ..progress import Reporter, reporting
from ..schemas import TRANSLATIONS, USAGE
from ..sources import answers
from ..sources.gate import Gate
from ..sources.site import Store
from ..sources.warehouse import Warehouse


#: Records that are reviewed together; parts of a batch; where in the warehouse answers wait, and single calls.
BATCH, WORKERS, ANSWERS, CALLS = 2_000, 8, "answers", "calls"


def save(house: Warehouse, results: DataFrame) -> None:
    """Upsert the completed rows of a run, of each record the last one; failures stay pending."""
    done = merge.last_rows(results.filter("failure is null"), "question_id", ["completed_at"], TRANSLATIONS.fieldNames())
    house.point({"translations": house.upsert("translations", done)})


def _answered(house: Warehouse) -> list[str]:
    """Folders of answers that are not in the table of translations yet, oldest first; those of a job that failed too."""
    folder = house._hadoop(f"{house.path}/{ANSWERS}")
    found = [s.getPath() for s in house._fs.listStatus(folder)] if house._fs.exists(folder) else []
    folders = [f"{house.path}/{ANSWERS}/{p.getName()}" for p in sorted(found, key=lambda p: p.getName())]
    return [f for f in folders if answers.recorded(house.uri(f))]


def _settle(house: Warehouse, folders: list[str]) -> None:
    """Take written answers into the table, in one step, then delete their folders and what was remembered of their reviews."""
    if folders:
        rows = house.spark.read.schema(review.RESULT).parquet(*folders)
        save(house, rows)
        done, calls = rows.filter("failure is null").select(*answers.KEY), house.uri(f"{house.path}/{CALLS}")

        def forget(keys: Iterator[Row]) -> None:
            Store(calls).drop(*[f"{ident}-{content}.json" for ident, content in keys])

        done.foreachPartition(forget)
        for folder in folders:
            house.drop(folder)


def run(house: Warehouse, make_client: Callable[[], review.ReviewClient], limit: int | None = None, refresh: bool = False, concurrency: int = 1000, partitions: int | None = None, seed: int | None = None, fail_fast: bool = False, told: Reporter | None = None, max_revisions: int = review.MAX_REVISIONS) -> dict[str, int]:
    """Review up to ``limit`` records; selected, completed, errors and the usage of the completed.

    Records are drawn once, then reviewed BATCH at a time. Each answer of the client is written before it is used, and
    each review's result is a record of its own: a lost task, and the run after one that broke off, repeat at most one call
    of each review that was under way, and take what they find written. ``told`` hears of each batch. At most ``concurrency``
    reviews are under way at once, over all workers. With ``fail_fast`` the first failure cancels the batch.
    """
    context, group = house.spark.sparkContext, f"reviews-{uuid.uuid4().hex}"
    with Gate(house.spark, leases=concurrency, on_stop=lambda: context.cancelJobGroup(group)) as gate:
        context.setJobGroup(group, "reviews", True)
        try:
            return _run(house, make_client, gate, limit, refresh, concurrency, partitions, seed, fail_fast, told, max_revisions)
        except Exception as error:
            if gate.stopped:
                raise RuntimeError(gate.stopped) from error
            raise
        finally:
            for name in ("spark.jobGroup.id", "spark.job.description", "spark.job.interruptOnCancel"):
                context.setLocalProperty(name, None)


def _run(house: Warehouse, make_client: Callable[[], review.ReviewClient], gate: Gate, limit: int | None, refresh: bool, concurrency: int, partitions: int | None, seed: int | None, fail_fast: bool, told: Reporter | None, max_revisions: int) -> dict[str, int]:
    house.spark.dataSource.register(answers.ReviewAnswers)
    _settle(house, _answered(house))
    inputs = review.pending_inputs(
        house.read("questions_canonical"), house.read("translations"), house.read("packages"), limit, refresh, seed,
    )
    drawn = house.work()
    inputs.write.parquet(drawn)
    inputs = house.spark.read.schema(inputs.schema).parquet(drawn)
    total, begun = inputs.count(), time.time_ns()
    batches = max(1, -(-total // BATCH))
    mine: list[str] = []
    for k in range(batches if total else 0):
        part = inputs.filter(F.pmod(F.xxhash64("question_id"), F.lit(batches)) == k)
        folder = f"{house.path}/{ANSWERS}/{begun:020d}-{k:08d}"
        done = review.run_reviews(part, make_client, concurrency, partitions or WORKERS, fail_fast, max_revisions, house.uri(f"{house.path}/{CALLS}"), gate.ticket)
        done.write.format(answers.NAME).mode("append").save(house.uri(folder))
        mine += [folder] if answers.recorded(house.uri(folder)) else []
        if told:
            told(min(total, (k + 1) * BATCH), total, "reviewed")
    results = house.spark.read.schema(review.RESULT).parquet(*mine) if mine else house.spark.createDataFrame([], review.RESULT)
    done = review.run_report(results).first().asDict()
    _settle(house, mine)
    house.drop(drawn)
    return done


def statistics(house: Warehouse) -> tuple[DataFrame, DataFrame, int]:
    """Rows by status, totals of usage, and the number of pending records."""
    t = house.read("translations")
    return funnel.status_counts(t), funnel.usage_totals(t), funnel.pending(house.read("questions_canonical"), t).count()


def report(spark: SparkSession, done: dict[str, int], rates: values.Rates = values.Rates()) -> list[str]:
    """Lines of a run's report; averages are over the completed."""
    tokens = {u: F.lit(done[u]) for u in USAGE}
    spent = spark.range(1).select(
        values.cost(
            tokens["input_tokens"], tokens["cached_input_tokens"], tokens["cache_write_input_tokens"],
            tokens["output_tokens"], rates,
        )
    ).first()[0]
    lines = [f"{k}: {done[k]:,}" for k in ("selected", "completed", "errors")] + [f"cost: ${spent:.4f}"]
    return lines + (
        [
            f"per question: ${spent / done['completed']:.4f}, {done['output_tokens'] / done['completed']:.0f} output tokens"
        ] if done["completed"] else []
    )


def main(args: list[str] | None = None, make_client: Callable[[], review.ReviewClient] | None = None) -> int:
    parser = argparse.ArgumentParser(description="Review pending records.")
    parser.add_argument("warehouse")
    parser.add_argument("count", type=int)
    parser.add_argument("--client", help="module:factory of the client")
    parser.add_argument("--policy", help="JSON file of instructions and limits; the client's factory is called with it")
    parser.add_argument("--refresh", action="store_true")
    parser.add_argument("--concurrency", type=int, default=1000, help="reviews under way at once, over all workers")
    parser.add_argument("--fail-fast", action="store_true", help="end the run at the first failure")
    chosen = parser.parse_args(args)
    if chosen.count < 1:
        parser.error("count must be at least 1")
    if make_client is None:
        module, _, name = (chosen.client or parser.error("--client is needed")).partition(":")
        make_client = getattr(importlib.import_module(module), name)
    policy = review.Policy()
    if chosen.policy:
        policy = review.Policy.load(chosen.policy)
        make_client = functools.partial(make_client, policy)
    spark = SparkSession.builder.getOrCreate()
    with reporting("review") as told:
        done = run(
            Warehouse(spark, chosen.warehouse), make_client, chosen.count, chosen.refresh,
            chosen.concurrency, fail_fast=chosen.fail_fast, told=told,
            max_revisions=policy.max_revisions,
        )
    print("\n".join(report(spark, done)))
    return 1 if done["errors"] else 0


if __name__ == "__main__":
    sys.exit(main())
