"""Exclusion of unusable rows and merging of reprints into canonical records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text, values
from ..staging import discard, staged

#: Fields of which a canonical record takes the longest version of any printing.
LONGEST = ("answer", "explanation", "acceptance_criteria", "handout_text", "source_references")


#: Printings from which on a group is pooled in segments, and ids in the range of a segment.
HOT, WIDTH = 100_000, 1 << 16


def exclusions(questions: DataFrame, patterns: text.Patterns = text.DEFAULT, question: str = "question", answer: str = "answer", key: str = "id") -> DataFrame:
    """question_id, reason of the rows that are no usable questions."""
    reason = text.exclusion_reason(F.col(question), F.col(answer), patterns)
    return questions.select(F.col(key).alias("question_id"), reason.alias("reason")).filter("reason is not null")


def exclusion_counts(excluded: DataFrame) -> DataFrame:
    return excluded.groupBy("reason").agg(F.count("*").alias("n"))


def clean(questions: DataFrame, excluded: DataFrame, key: str = "id") -> DataFrame:
    """Rows without an exclusion."""
    return questions.join(excluded, questions[key] == excluded["question_id"], "left_anti")


def longest(c: Column, key: Column) -> Column:
    """Aggregate: the value whose text without white space around is longest, of the smallest key on ties."""
    return F.max_by(c, F.struct(F.length(text.strip(text.present(c))), -key))


def in_order(key: Column, c: Column) -> Column:
    """Aggregate: the arrays of a group in ascending order of key."""
    return F.transform(F.array_sort(F.collect_list(F.struct(key.alias("k"), c.alias("v")))), lambda x: x["v"])


def with_key(rows: DataFrame, native: bool = False, column: str = "question") -> DataFrame:
    """Add ``nhash``, the key that reprints share, unless the rows have it."""
    if "nhash" in rows.columns:
        return rows
    return rows.withColumn("nhash", (text.native_key if native else text.normalized_key)(F.col(column)))


def merge_printings(rows: DataFrame, native: bool = False, hot: int = HOT, width: int = WIDTH) -> DataFrame:
    """One canonical record for each distinct question of ``rows`` (clean questions, each id once).

    Identity and all but the merged fields come from the smallest id; of ``LONGEST`` fields the longest text of
    any printing; tournaments are the ordered union, plays are pooled in order of id. Texts and counts are combined within
    each task before the one shuffle on the key; the plays of a group meet in one list. Groups of more than ``hot``
    printings, of which there are at most one for each ``hot`` rows, are found first. Their plays are pooled in
    segments, by ranges of ``width`` ids, which go to tasks of their own; what meets in the end is a list of arrays, no larger
    than the record that holds them, not one of printings.
    """
    keyed = with_key(rows, native)
    crowded = staged(keyed.groupBy("nhash").agg(F.count("*").alias("n")).filter(F.col("n") > hot).select("nhash"), "hot-keys")
    if crowded.isEmpty():
        discard(crowded)
        merged = _merged(keyed, _one_list(keyed))
    else:
        own, usual = (keyed.join(F.broadcast(crowded), "nhash", how) for how in ("left_semi", "left_anti"))
        merged = _merged(usual, _one_list(usual)).unionByName(_merged(own, None).join(_segments(own, width), "nhash"))
    merged = merged.select("first.*", *LONGEST, *_POOLED, "printings")
    return with_statistics(merged).select(*[c for c in rows.columns if c != "nhash"], "printings", "playings", "total_teams", "solve_rate")


_POOLED = ("tournament_ids", "solve_percentages", "correct_answers")


def _plays(rows: DataFrame) -> Column:
    """Aggregate: id, tournaments, shares and right answers of each printing, in order of id."""
    percents, corrects = values.paired(F.col("solve_percentages"), F.col("correct_answers"))
    tours = F.coalesce("tournament_ids", F.array().cast("array<bigint>"))
    return F.array_sort(F.collect_list(F.struct("id", tours.alias("t"), percents.alias("p"), corrects.alias("c"))))


def _flat(plays: str) -> list[Column]:
    """The pooled arrays of a list of structs t, p, c."""
    part = lambda c: F.transform(plays, lambda x: x[c])
    return [values.ordered_union(part("t")).alias("t"), F.flatten(part("p")).alias("p"), F.flatten(part("c")).alias("c")]


def _one_list(keyed: DataFrame) -> list[Column]:
    return [_plays(keyed).alias("plays")]


def _merged(keyed: DataFrame, plays: list[Column] | None) -> DataFrame:
    """nhash, first, texts and printings of each group; with ``plays`` also the pooled arrays."""
    own = [c for c in keyed.columns if c not in (*LONGEST, *_POOLED, "content_hash", "nhash")]
    merged = keyed.groupBy("nhash").agg(
        F.min_by(F.struct(*own), "id").alias("first"),
        *[longest(F.col(c), F.col("id")).alias(c) for c in LONGEST],
        F.count("*").alias("printings"),
        *(plays or []),
    )
    if not plays:
        return merged
    return merged.select("nhash", "first", *LONGEST, "printings", *[c.alias(n) for c, n in zip(_flat("plays"), _POOLED)])


def _segments(keyed: DataFrame, width: int) -> DataFrame:
    """nhash and the pooled arrays of each group, pooled first by ranges of ``width`` ids, then put together in their order."""
    parts = keyed.groupBy("nhash", F.floor(F.col("id") / width).alias("segment")).agg(_plays(keyed).alias("plays"))
    parts = parts.select("nhash", "segment", *_flat("plays"))
    whole = parts.groupBy("nhash").agg(F.array_sort(F.collect_list(F.struct("segment", "t", "p", "c"))).alias("parts"))
    return whole.select("nhash", *[c.alias(n) for c, n in zip(_flat("parts"), _POOLED)])


def with_statistics(merged: DataFrame) -> DataFrame:
    """Records with what follows from their pooled plays and merged texts: playings, total_teams, solve_rate, content_hash."""
    merged = merged.withColumn("playings", F.size("solve_percentages")).withColumn(
        "total_teams", values.total_teams(F.col("solve_percentages"), F.col("correct_answers")),
    )
    merged = merged.withColumn("solve_rate", values.solve_rate(F.col("correct_answers"), F.col("total_teams")))
    return merged.withColumn("content_hash", text.content_hash(*map(F.col, text.CONTENT_FIELDS)))


def printing_map(rows: DataFrame, native: bool = False, key: str = "id", column: str = "question") -> DataFrame:
    """question_id, canonical_id of every clean row; a record's own row maps to itself.

    The smallest id is aggregated before it is joined back, so that a key with many rows needs no single task. Ids
    and keys, some 30 bytes a row, are staged between the two, so that no text is read or folded twice and no lost executor takes them along.
    """
    keyed = staged(with_key(rows, native, column).select(F.col(key).alias("question_id"), "nhash"), "printing-keys")
    least = keyed.groupBy("nhash").agg(F.min("question_id").alias("canonical_id"))
    return keyed.join(least, "nhash").select("question_id", "canonical_id")


def summary(printings: DataFrame) -> DataFrame:
    """questions, merged, reprints: groups, groups of several printings, and printings beyond the first."""
    sizes = printings.groupBy("canonical_id").agg(F.count("*").alias("n"))
    return sizes.agg(
        F.count("*").alias("questions"), F.coalesce(F.sum((F.col("n") > 1).cast("long")), F.lit(0)).alias("merged"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("reprints"),
    )


def latest(rows: DataFrame, key: str, *order: Column) -> DataFrame:
    """One row for each key, the first in ``order``."""
    w = Window.partitionBy(key).orderBy(*order)
    return rows.withColumn("_place", F.row_number().over(w)).filter("_place = 1").drop("_place")
