"""The incremental corpus build: fetch, parse, store, exclude, merge reprints, prune, report."""

from __future__ import annotations

import argparse
import sys
from collections.abc import Callable
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators import curate, delta, funnel, merge
from ..progress import Reporter, reporting
from ..schemas import CHANGES, QUESTIONS
from ..sources import fetch, pages
from ..sources.gate import Gate
from ..sources.warehouse import Warehouse
from ..staging import Scratch


#: Pages that are fetched before they are stored.
BATCH = 10_000


def store_pages(house: Warehouse, fetched: DataFrame, refresh: bool = False, patterns: text.Patterns = text.DEFAULT) -> DataFrame:
    """Apply fetched pages (id, position, html, error) to packages and questions; returns outcome counts.

    Unchanged pages are told by their hash before anything is parsed. Packages are looked up and written, and questions
    written, by the buckets that the pages touch; which questions were stored is noted for ``catch_up``.
    """
    spark = house.spark
    work = house.work()
    fetched.write.parquet(f"{work}/fetched")  # a fetch is never repeated by a later plan
    rows = spark.read.schema(fetched.schema).parquet(f"{work}/fetched")
    packages = house.lookup("packages", rows.select("id"))
    known = packages.select("id", F.col("status").alias("old_status"), F.col("page_hash").alias("old_hash"))
    hashed = rows.join(known, "id", "left").withColumn("new_hash", text.page_hash(F.col("html")))
    same = F.lit(False) if refresh else F.coalesce(F.col("new_hash") == F.col("old_hash"), F.lit(False))
    fresh = pages.parse(hashed.filter(F.col("error").isNull() & ~same), patterns)
    skipped = hashed.filter(F.col("error").isNotNull() | same).withColumn("page_hash", F.col("new_hash"))
    every = fresh.unionByName(skipped.drop("html"), allowMissingColumns=True)
    count = F.coalesce(F.size("questions"), F.lit(0))
    outcome = merge.outcome(
        F.col("page_hash"), F.col("old_hash"), F.col("old_status"), F.col("error"), F.col("parse_error"), count,
        refresh,
    )
    every.withColumn("outcome", outcome).write.parquet(f"{work}/outcomes")
    every = spark.read.parquet(f"{work}/outcomes")

    now = F.lit(datetime.now(timezone.utc)).cast("timestamp")
    ok = F.col("outcome").isin("new", "updated")
    status = F.when(F.col("outcome") == "fetch_error", "http_error").when(
        F.col("outcome").isin("parse_error", "empty"), F.col("outcome"),
    ).otherwise("ok")
    error = F.when(F.col("outcome") == "empty", "").otherwise(
        F.substring(F.coalesce("error", "parse_error", F.lit("")), 1, merge.ERROR_LENGTH)
    )
    empty = {"title": "", "slug": ""}
    part = lambda c: F.when(ok, F.col(f"package.{c}"))
    batch = every.select(
        "id",
        *[F.coalesce(part(c), F.lit(empty[c])).alias(c) for c in empty],
        part("played_at_start").alias("played_at_start"),
        part("played_at_end").alias("played_at_end"),
        F.coalesce(part("editor_ids"), F.array().cast("array<bigint>")).alias("editor_ids"),
        F.coalesce(part("editor_names"), F.array().cast("array<string>")).alias("editor_names"),
        F.concat(F.lit(pages.BASE_URL + "/pack/"), F.col("id").cast("string")).alias("url"),
        status.alias("status"),
        F.when(ok, 200).alias("http_status"),
        F.when(ok, F.col("page_hash")).alias("page_hash"),
        F.when(ok, F.size("questions")).otherwise(0).alias("questions_found"),
        now.alias("first_seen_at"),
        now.alias("fetched_at"),
        error.alias("error"),
        "outcome",
    )
    taken = pages.question_rows(
        every.filter(ok).select(
            "id", F.col("position").alias("target"), "page_hash", "parse_error", "package", "questions",
        ),
        patterns,
    )
    merge.last_rows(taken, "id", ["target", "position"], QUESTIONS.fieldNames()).write.parquet(f"{work}/questions")
    taken = spark.read.schema(QUESTIONS).parquet(f"{work}/questions")
    changes = {
        "packages": (merge.merge_packages(packages, batch).dropDuplicates(["id"]), None),
        "questions": (taken, None),
        "question_changes": (taken.select(F.col("id").alias("question_id")), None),
    }
    house.point(house.upserts(changes))
    counts = merge.outcome_counts(every.select("outcome", F.coalesce(F.size("questions"), F.lit(0)).alias("questions")))
    done = spark.createDataFrame(counts.collect(), counts.schema)  # a row for each kind of outcome
    house.drop(work)
    return done


def rebuild(house: Warehouse, patterns: text.Patterns = text.DEFAULT) -> DataFrame:
    """Exclusions, canonical records and printings anew, stale translations dropped; all made current by one step.

    Returns questions, merged, reprints and dropped (translations) as one row.
    """
    questions, stored = house.read("questions"), house.read("translations")
    folders = {"question_exclusions": house.write("question_exclusions", curate.exclusions(questions, patterns))}
    kept = curate.clean(questions, house.at("question_exclusions", folders["question_exclusions"]))
    with Scratch("rebuild") as stage:
        kept = stage(curate.with_key(kept), "keyed")  # texts are folded once for all that follows
        folders["questions_canonical"] = house.write("questions_canonical", curate.merge_printings(kept))
        folders["question_printings"] = house.write("question_printings", curate.printing_map(kept))
        folders["question_groups"] = house.write("question_groups", delta.groups(kept))
    folders["question_changes"] = house.write("question_changes", house.spark.createDataFrame([], CHANGES))
    fresh, gone = merge.prune(stored, house.at("questions_canonical", folders["questions_canonical"]))
    dropped = gone.count()
    if dropped:
        folders["translations"] = house.write("translations", fresh)
    house.point(folders)
    return curate.summary(house.read("question_printings")).withColumn("dropped", F.lit(dropped).cast("long"))


def catch_up(house: Warehouse, patterns: text.Patterns = text.DEFAULT) -> DataFrame:
    """The later stages brought up to date with the questions that were stored since; the same as ``rebuild``, which see.

    Only groups that a stored question was in or comes to are looked at, and only buckets with their rows are written.
    Without groups to go on from, as in a new warehouse, everything is built. ``patterns`` must be those of the last build.
    """
    changed = house.read("question_changes")
    if house.read("question_groups").isEmpty():
        return rebuild(house, patterns)
    dropped = 0
    if not changed.isEmpty():
        with Scratch("delta") as stage:
            done = delta.change(changed, house.lookup, house.read("question_printings"), stage, patterns)
            changes = {
                "question_exclusions": (done.exclusions, done.changed),
                "questions_canonical": (done.canonical, done.records_gone),
                "question_printings": (done.printings, done.changed),
                "question_groups": (done.groups, done.groups_gone),
            }
            folders = house.upserts(changes) | {"question_changes": house.write("question_changes", house.spark.createDataFrame([], CHANGES))}
            touched = done.canonical.select("id").union(done.records_gone).distinct()
            stored = house.lookup("translations", touched)
            _, gone = merge.prune(stored, done.canonical)
            gone = stage(gone, "gone")
            dropped = gone.count()
            if dropped:
                folders["translations"] = house.upsert("translations", stored.limit(0), gone.select("question_id"))
            house.point(folders)
    return delta.summary(house.read("question_groups")).withColumn("dropped", F.lit(dropped).cast("long"))


def build(house: Warehouse, make_fetcher: Callable[[], fetch.Fetcher], pack_ids: list[int] | None = None, limit: int | None = None, refresh: bool = False, workers: int = 8, today: date | None = None, patterns: text.Patterns = text.DEFAULT, told: Reporter | None = None, whole: bool = False) -> dict[str, int]:
    """One incremental run; outcome counts by name, with ``skipped`` and ``questions``, and merged, reprints and dropped of the later stages.

    These are brought up to date with what was stored, or built as a ``whole``, as is due after a change of patterns. Pages are fetched and stored ``BATCH`` at a time; ``told`` hears of each such step.
    """
    spark = house.spark
    done = merge.settled(house.read("packages"), F.lit(today or datetime.now(timezone.utc).date())).select("id")
    if pack_ids is None:
        known = frozenset() if refresh else frozenset(r.id for r in done.collect())
        pack_ids = fetch.discover(make_fetcher(), known, limit)
    found = spark.createDataFrame(list(zip(pack_ids, range(len(pack_ids)))), "id bigint, position bigint")
    wanted = merge.targets(found, done, refresh)
    wanted = spark.createDataFrame(wanted.collect(), wanted.schema)  # ids that an index lists: the driver walked it
    n = wanted.count()
    counts = {"skipped": len(pack_ids) - n, "questions": 0}
    for done in range(0, n, BATCH):
        part = wanted.orderBy("position").offset(done).limit(BATCH)
        for row in store_pages(house, fetch.fetch_pages(part, make_fetcher, workers), refresh, patterns).collect():
            counts[row.outcome] = counts.get(row.outcome, 0) + row.n
            counts["questions"] += row.n_questions
        if told:
            told(min(n, done + BATCH), n, "pages stored")
    summary = (rebuild if whole else catch_up)(house, patterns).first()
    return counts | {c: summary[c] for c in ("merged", "reprints", "dropped")}


def corpus_funnel(house: Warehouse) -> DataFrame:
    t = house.tables()
    return funnel.funnel(t["questions"], t["question_exclusions"], t["questions_canonical"], t["translations"])


#: How the report calls what a rebuild counts.
NAMES = {"merged": "merged records", "dropped": "translations dropped"}


def report(house: Warehouse, counts: dict[str, int]) -> list[str]:
    """Lines of a build report: counters that aren't zero, the funnel, exclusions by number."""
    lines = [f"{NAMES.get(name, name)}: {n:,}" for name, n in counts.items() if n]
    lines += [f"{name}: {n:,}" for name, n in corpus_funnel(house).first().asDict().items()]
    excluded = curate.exclusion_counts(house.read("question_exclusions")).orderBy(F.desc("n"), "reason").collect()
    return lines + [f"  {r.reason}: {r.n:,}" for r in excluded]


def main(args: list[str] | None = None, make_fetcher: Callable[[], fetch.Fetcher] | None = None) -> int:
    parser = argparse.ArgumentParser(description="Build or update the corpus.")
    parser.add_argument("warehouse")
    parser.add_argument("--pages", type=int)
    parser.add_argument("--refresh", action="store_true")
    parser.add_argument("--rebuild", action="store_true", help="build the later stages as a whole")
    parser.add_argument("--workers", type=int, default=8)
    parser.add_argument("--delay", type=float, default=0.0)
    chosen = parser.parse_args(args)
    spark = SparkSession.builder.getOrCreate()
    try:
        with reporting("build") as told, Gate(spark, chosen.delay) as gate:
            house = Warehouse(spark, chosen.warehouse)
            ticket = gate.ticket  # each worker has a client of its own; the gate keeps the delay between all their requests
            counts = build(
                house, make_fetcher or (lambda: fetch.HttpClient(pace=ticket.turn if chosen.delay else None)), limit=chosen.pages,
                refresh=chosen.refresh, workers=chosen.workers, told=told, whole=chosen.rebuild,
            )
    except fetch.IndexUnavailable as error:
        print(error, file=sys.stderr)
        return 1
    print("\n".join(report(house, counts)))
    return 0


if __name__ == "__main__":
    sys.exit(main())
