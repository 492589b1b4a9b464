"""Upserts and prunes as functions of (stored, batch) -> new relation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import values
from ..schemas import SETTLED

#: Columns that a package keeps from its first success, and those that a failure replaces.
KEPT = ("first_seen_at", "url")
FAILURE = ("status", "fetched_at", "error")
#: Characters of an error that are stored.
ERROR_LENGTH = 500


def last_rows(batch: DataFrame, key: str, order: list[str], columns: list[str]) -> DataFrame:
    """Of several rows of a key the greatest by ``order`` (then nothing else), by an aggregation, which combines before the shuffle."""
    return batch.groupBy(key).agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("row")).select("row.*")


def upsert(stored: DataFrame, batch: DataFrame, key: str, order: list[str] | None = None) -> DataFrame:
    """Rows of the batch replace stored rows of the same key; nothing is deleted.

    Of several batch rows of a key the last one counts (``last_rows``); stored rows meet the batch in an anti join.
    """
    columns = stored.columns
    if order:
        batch = last_rows(batch, key, order, columns)
    batch = batch.select(*columns)
    return stored.join(batch.select(key), key, "left_anti").unionByName(batch)


def merge_packages(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """Apply the outcomes of a fetch (``batch``: the package columns and ``outcome``).

    A success replaces all but ``KEPT``; a failure replaces ``FAILURE`` only, and adds a row for an unknown
    package; an unchanged page of a package whose last status was not ok is set to ok again. Unchanged and
    recovered pages of an unknown package, which no fetch gives, add nothing.
    """
    old, new = stored.alias("o"), batch.alias("n")
    outcome = F.col("n.outcome")
    failed = outcome.isin("fetch_error", "parse_error", "empty")
    recovered = outcome == "recovered"
    known, touched = F.col("o.id").isNotNull(), F.col("n.id").isNotNull()

    def pick(c: str) -> Column:
        o, n = F.col(f"o.{c}"), F.col(f"n.{c}")
        if c == "id":
            return F.coalesce(o, n)
        if c in KEPT:
            return F.when(known, o).otherwise(n)
        after_failure = n if c in FAILURE else F.when(known, o).otherwise(n)
        after_recovery = {"status": F.lit("ok"), "http_status": F.lit(200), "error": F.lit(""), "fetched_at": n}.get(c, o)
        return F.when(~touched | (outcome == "unchanged"), o).when(failed, after_failure).when(recovered, after_recovery).otherwise(n)

    touching = known | ~outcome.isin("unchanged", "recovered")
    joined = old.join(new, F.col("o.id") == F.col("n.id"), "full_outer").filter(touching)
    return joined.select(
        *[pick(c).cast(stored.schema[c].dataType).alias(c) for c in stored.columns]
    )


def outcome(page_hash: Column, stored_hash: Column, stored_status: Column, error: Column, parse_error: Column, questions: Column, refresh: bool = False) -> Column:
    """What a fetch of a package amounts to; the conditions are tried in this order."""
    same = F.lit(False) if refresh else F.coalesce(page_hash == stored_hash, F.lit(False))
    ok = F.coalesce(stored_status == "ok", F.lit(False))
    return (
        F.when(error.isNotNull(), "fetch_error")
        .when(same & ok, "unchanged")
        .when(same, "recovered")
        .when(parse_error.isNotNull(), "parse_error")
        .when(questions == 0, "empty")
        .when(ok, "updated")
        .otherwise("new")
    )


def outcome_counts(outcomes: DataFrame) -> DataFrame:
    """outcome, n, n_questions; a recovered page is also an unchanged one, and only stored questions count."""
    counted = outcomes.withColumn(
        "counts_as",
        F.when(
            F.col("outcome") == "recovered", F.array(F.lit("recovered"), F.lit("unchanged")),
        ).otherwise(F.array("outcome")),
    )
    stored = F.when(F.col("outcome").isin("new", "updated"), F.col("questions")).otherwise(0)
    return counted.select(F.explode("counts_as").alias("outcome"), stored.alias("questions")).groupBy("outcome").agg(
        F.count("*").alias("n"), F.coalesce(F.sum("questions"), F.lit(0)).alias("n_questions"),
    )


def settled(packages: DataFrame, today: Column, days: int = values.RESTLESS_DAYS) -> DataFrame:
    """Packages that need no further fetch: ok or empty, and not played recently."""
    return packages.filter(F.col("status").isin(*SETTLED) & ~values.recent(F.col("played_at_start"), today, days))


def targets(discovered: DataFrame, settled_ids: DataFrame, refresh: bool = False) -> DataFrame:
    return discovered if refresh else discovered.join(settled_ids.select("id"), "id", "left_anti")


def prune(translations: DataFrame, canonical: DataFrame, key: str = "question_id") -> tuple[DataFrame, DataFrame]:
    """Translations that match a canonical record by id and content hash, and those that don't."""
    match = [translations[key] == canonical["id"], translations["content_hash"] == canonical["content_hash"]]
    both = reduce(Column.__and__, match)
    return translations.join(canonical, both, "left_semi"), translations.join(canonical, both, "left_anti")
