"""Corpus statistics and invariants."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import EDITOR_STATUSES, STATUSES, USABLE, USAGE


def funnel(questions: DataFrame, excluded: DataFrame, canonical: DataFrame, translations: DataFrame, key: str = "id") -> DataFrame:
    """questions, clean, canonical, translated, awaiting as one row."""
    count = F.count("*")
    kept = questions.join(excluded, questions[key] == excluded["question_id"], "left_anti")
    usable = canonical.join(translations.filter(F.col("status").isin(*USABLE)), canonical["id"] == translations["question_id"], "inner")
    waiting = pending(canonical, translations)
    parts = [
        questions.agg(count.alias("questions")), kept.agg(count.alias("clean")),
        canonical.agg(count.alias("canonical")), usable.agg(count.alias("translated")),
        waiting.agg(count.alias("awaiting")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.join(part)  # one row each
    return out


def pending(canonical: DataFrame, translations: DataFrame) -> DataFrame:
    """Canonical records without a translation."""
    return canonical.join(translations, canonical["id"] == translations["question_id"], "left_anti")


def translated(canonical: DataFrame, translations: DataFrame) -> DataFrame:
    """Canonical records with usable English text."""
    english = [c for c in translations.columns if c.endswith("_en")]
    usable = translations.filter(F.col("status").isin(*USABLE)).select("question_id", *english, F.col("status").alias("translation_status"))
    return canonical.join(usable, canonical["id"] == usable["question_id"]).drop("question_id")


def status_counts(translations: DataFrame) -> DataFrame:
    return translations.groupBy("status").agg(F.count("*").alias("n"))


def usage_totals(translations: DataFrame) -> DataFrame:
    """Number of rows and sums of the counters; sums are null on an empty table."""
    return translations.agg(F.count("*").alias("n"), *[F.sum(u).alias(u) for u in USAGE])


def violations(tables: dict[str, DataFrame]) -> DataFrame:
    """name, n of each invariant that does not hold; empty if all do."""
    q, x, c, p, t = (tables[k] for k in ("questions", "question_exclusions", "questions_canonical", "question_printings", "translations"))
    keep = q.join(x, q["id"] == x["question_id"], "left_anti")
    checks = {f"{name}: repeated key": df.groupBy(key).count().filter("count > 1") for name, df, key in (("questions", q, "id"), ("canonical", c, "id"), ("printings", p, "question_id"), ("translations", t, "question_id"))}
    checks |= {
        "questions: no package": q.join(tables["packages"], q["package_id"] == tables["packages"]["id"], "left_anti"),
        "exclusions: no question": x.join(q, x["question_id"] == q["id"], "left_anti"),
        "clean rows without printing": keep.join(p, keep["id"] == p["question_id"], "left_anti"),
        "printings of no clean row": p.join(keep, p["question_id"] == keep["id"], "left_anti"),
        "printings without record": p.join(c, p["canonical_id"] == c["id"], "left_anti"),
        "records that do not map to themselves": c.join(p.filter("question_id = canonical_id"), c["id"] == p["question_id"], "left_anti"),
        "stale translations": t.join(c, (t["question_id"] == c["id"]) & (t["content_hash"] == c["content_hash"]), "left_anti"),
        "translations: unknown status": t.filter(~F.col("status").isin(*STATUSES) | ~F.col("editor_status").isin(*EDITOR_STATUSES)),
        "printings beyond the clean rows": c.agg(F.coalesce(F.sum("printings"), F.lit(0)).alias("n")).join(keep.agg(F.count("*").alias("m"))).filter("n <> m"),
    }
    out = None
    for name, df in checks.items():
        part = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
        out = part if out is None else out.unionByName(part)
    return out.filter("n > 0")
