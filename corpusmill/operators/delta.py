"""Canonical records kept up to date with a set of changed questions, without a look at the other groups.

A group that only gains printings, all with ids above its last one, grows by a merge of two records: the earliest printing
and the order of what is pooled stay, and a text is replaced by a longer one only. Every other group that a changed question
was in or comes to is made anew from its members, since its earliest printing, a longest text or a pooled array may have left.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..schemas import CANONICAL
from . import curate

Stage = Callable[[DataFrame, str], DataFrame]
#: (name of a relation, column of keys) -> its rows with these keys.
Lookup = Callable[[str, DataFrame], DataFrame]


def group_key(nhash: Column) -> Column:
    """The key that reprints share, 16 hexadecimal digits, as a number."""
    return F.conv(nhash, 16, -10).cast("bigint")


def groups(rows: DataFrame) -> DataFrame:
    """group_key, canonical_id, last_id, printings of clean questions with their ``nhash``."""
    return rows.groupBy(group_key(F.col("nhash")).alias("group_key")).agg(
        F.min("id").alias("canonical_id"), F.max("id").alias("last_id"), F.count("*").alias("printings"),
    )


def joined_records(records: DataFrame, later: DataFrame) -> DataFrame:
    """Canonical records, each merged with that of printings which all come after its own.

    ``later`` has the columns of a record and ``canonical_id``, the id of the record that it joins.
    """
    both = records.alias("a").join(later.alias("b"), F.col("a.id") == F.col("b.canonical_id"))
    length = lambda side, c: F.length(text.strip(text.present(F.col(f"{side}.{c}"))))
    own = {c: F.col(f"a.{c}") for c in CANONICAL.fieldNames()}
    own |= {c: F.when(length("b", c) > length("a", c), F.col(f"b.{c}")).otherwise(F.col(f"a.{c}")) for c in curate.LONGEST}
    own |= {c: F.concat(F.col(f"a.{c}"), F.col(f"b.{c}")) for c in ("solve_percentages", "correct_answers")}
    own["tournament_ids"] = F.array_distinct(F.concat(F.col("a.tournament_ids"), F.col("b.tournament_ids")))
    own["printings"] = F.col("a.printings") + F.col("b.printings")
    return curate.with_statistics(both.select(*[c.alias(name) for name, c in own.items()])).select(*CANONICAL.fieldNames())


@dataclass
class Change:
    """What a set of changed questions does to the later relations: rows that come or are replaced, and keys that leave."""

    exclusions: DataFrame
    canonical: DataFrame
    printings: DataFrame
    groups: DataFrame
    changed: DataFrame
    records_gone: DataFrame
    groups_gone: DataFrame


def change(changed: DataFrame, lookup: Lookup, printings: DataFrame, stage: Stage, patterns: text.Patterns = text.DEFAULT) -> Change:
    """The effect of ``changed`` (question_id), the questions that were stored, replaced or removed since the relations were made.

    ``lookup`` reads rows of the stored relations by key; ``printings``, the whole printing map, is scanned, two
    numbers a row, only where groups are made anew, for their members.
    """
    ids = stage(changed.select("question_id").distinct(), "changed")
    rows = stage(lookup("questions", ids), "rows")
    excluded = stage(curate.exclusions(rows, patterns), "exclusions")
    clean = curate.with_key(curate.clean(rows, excluded))
    clean = stage(clean.withColumn("group_key", group_key(F.col("nhash"))), "clean")
    before = stage(lookup("question_printings", ids), "before")

    gains = clean.groupBy("group_key").agg(F.min("id").alias("first_id"))
    known = lookup("question_groups", gains.select("group_key"))
    left = before.select("canonical_id").distinct().withColumn("loses", F.lit(True))
    gains = gains.join(known, "group_key", "left").join(left, "canonical_id", "left")
    grows = F.coalesce(F.col("first_id") > F.col("last_id"), F.lit(False)) & F.col("loses").isNull()
    gains = stage(gains.withColumn("grows", grows), "gains")
    growing = gains.filter("grows").select("group_key", F.col("canonical_id").alias("record_id"), F.col("printings").alias("stored"))
    anew = gains.filter("not grows and canonical_id is not null").select("canonical_id")
    anew = stage(anew.union(before.select("canonical_id")).distinct(), "anew")

    members = ids.limit(0).toDF("id")
    if not anew.isEmpty():
        members = printings.join(anew, "canonical_id", "left_semi").join(ids, "question_id", "left_anti").select(F.col("question_id").alias("id"))
    members = stage(members, "members")
    others = clean.join(growing.select("group_key"), "group_key", "left_anti").select(*rows.columns)
    base = stage(lookup("questions", members).unionByName(others), "base")
    keyed = curate.with_key(base).select("id", "nhash")

    later = clean.join(growing, "group_key")
    merged = curate.with_key(curate.merge_printings(later.select(*rows.columns))).withColumn("group_key", group_key(F.col("nhash")))
    merged = merged.join(growing.select("group_key", F.col("record_id").alias("canonical_id")), "group_key")
    grown = joined_records(lookup("questions_canonical", growing.select("record_id")), merged)
    grown_groups = later.groupBy("group_key", "record_id", "stored").agg(F.max("id").alias("last_id"), F.count("*").alias("n"))

    return Change(
        exclusions=excluded,
        canonical=stage(curate.merge_printings(base).unionByName(grown), "canonical"),
        printings=curate.printing_map(base).unionByName(later.select(F.col("id").alias("question_id"), F.col("record_id").alias("canonical_id"))),
        groups=groups(keyed).unionByName(grown_groups.select("group_key", F.col("record_id").alias("canonical_id"), "last_id", (F.col("stored") + F.col("n")).alias("printings"))),
        changed=ids,
        records_gone=anew,
        groups_gone=curate.with_key(lookup("questions_canonical", anew)).select(group_key(F.col("nhash")).alias("group_key")),
    )


def summary(stored: DataFrame) -> DataFrame:
    """questions, merged, reprints from the groups: as ``curate.summary`` counts them from the printing map."""
    return stored.agg(
        F.count("*").alias("questions"), F.coalesce(F.sum((F.col("printings") > 1).cast("long")), F.lit(0)).alias("merged"),
        F.coalesce(F.sum(F.col("printings") - 1), F.lit(0)).alias("reprints"),
    )

