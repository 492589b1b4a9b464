"""Personal data by bootstrapped contextual extraction, in DataFrame expressions only.

Base patterns find e-mail addresses, IP addresses, payment cards and telephone numbers. These seed
entities induce lexical patterns from the words around them; patterns and instances form a
bipartite graph whose edges are counted over all documents. In each round a pattern's
confidence for a kind is the share of its occurrences that stand at instances of that kind (those at instances
of no known kind weigh less, as far as these have no score), and instances at confident patterns gain scores. Confident patterns then mark the identifier-like
tokens at which they occur and which no base pattern knows.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import staged, text_of

KINDS = ["email", "ip", "card", "phone"]

# The base patterns. Look-behinds and possessive quantifiers only save retries; \G lets
# a local part start where the match before it ended. Cards are the runs of 13 to 19 digits.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
OCTETS = r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})(?:\.0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})){3}$"
# End of the fixed values.

#: An identifier-like token is a run of digit groups (with single or double blanks, dots, hyphens, slashes or
#: brackets between) of six digits or more, or stands between blanks and has four digits or an @.
TOKEN = r"(?<!\S)(?:(?=[(+]?+(?:[0-9][ .()/-]{0,2}+){6})[(+]?+[0-9]++(?:[ .()/-]{1,2}+[0-9]++)++[^\s0-9]*+|(?:(?:[^\s0-9]*+[0-9]){4}|[^\s@]*+@)\S*+)"
#: Characters looked at on either side of an entity.
REACH = 48
#: Rounds of scoring; different seed instances that a pattern needs; its least confidence; added to its occurrences;
#: and what an occurrence at an instance of no known kind counts against it (an unseen identifier, perhaps).
ROUNDS, SUPPORT, CONFIDENCE, SMOOTHING, UNKNOWN = 3, 5, 0.8, 1.0, 0.25
_SCORES = [f"s{k}" for k in range(len(KINDS))]


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it stands there."""
    return F.element_at(F.transform(F.array(value), body), 1)


def matches(text: Column, pattern: str) -> Column:
    """array<struct<start, end, value>> of the leftmost non-overlapping matches; positions in code points, end exclusive.

    Gaps and lengths are summed in blocks of about the square root of the number of matches, so a text of many
    matches does not copy its list for each of them.
    """
    pieces, values = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    begin = F.struct(F.lit(0).alias("at"), none.alias("out"))

    def step(done: Column, x: Column) -> Column:
        first = done["at"] + x["gap"]
        last = first + F.length(x["value"])
        own = F.array(F.struct(first.alias("start"), last.alias("end"), x["value"].alias("value")))
        return F.struct(last.alias("at"), F.concat(done["out"], own).alias("out"))

    def moved(part: Column, by: Column) -> Column:
        return F.transform(
            part["out"],
            lambda m: F.struct(
                (m["start"] + by).alias("start"), (m["end"] + by).alias("end"), m["value"].alias("value"),
            ),
        )

    def joined(parts: Column) -> Column:
        starts = F.aggregate(parts, F.array(F.lit(0)), lambda sums, p: F.concat(sums, F.array(F.element_at(sums, -1) + p["at"])))
        return F.flatten(F.zip_with(parts, _initial(starts), moved))

    def blocks(found: Column) -> Column:
        return _let(
            F.ceil(F.sqrt(F.size(found))).cast("int"),
            lambda b: _let(
                F.transform(
                    F.sequence(F.lit(0), b - 1), lambda k: F.aggregate(F.slice(found, k * b + 1, b), begin, step),
                ),
                joined,
            ),
        )

    paired = F.zip_with(pieces, values, lambda p, v: F.struct(F.length(p).alias("gap"), v.alias("value")))
    return F.when(F.size(values) > 0, _let(F.filter(paired, lambda x: x["value"].isNotNull()), blocks)).otherwise(none)


def _initial(c: Column) -> Column:
    """All but the last element."""
    return _let(c, lambda x: F.slice(x, F.lit(1), F.size(x) - 1))


def _luhn(value: Column) -> Column:
    digits = F.reverse(F.regexp_replace(value, "[^0-9]", ""))

    def weighed(i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, d).otherwise(F.when(d > 4, d * 2 - 9).otherwise(d * 2))

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda total, i: total + weighed(i)) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(OCTETS)
    if kind == "card":
        return _luhn(value)
    if kind == "phone":
        return F.length(F.regexp_replace(value, "[^0-9]", "")).between(9, 15)
    return F.lit(True)


def _check(kind: str):
    return lambda m: _valid(kind, m["value"])


def _labelled(kind: int):
    return lambda m: F.struct(F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end"), m["value"].alias("value"))


def base_spans(rows: DataFrame) -> DataFrame:
    """Add a column for each kind: array<struct<start, end, value>> of the valid matches in column ``text``."""
    may = {
        "email": F.contains("text", F.lit("@")), "phone": F.contains("text", F.lit("+")),
        "ip": F.col("text").rlike(r"[0-9]\.[0-9]"), "card": F.col("text").rlike(r"[0-9][\x20-]?[0-9]"),
    }
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    for kind in KINDS:
        found = F.when(may[kind], F.filter(matches(F.col("text"), PATTERNS[kind]), _check(kind))).otherwise(none)
        rows = rows.withColumn(kind, found)
    return rows


def _joined(spans: Column) -> Column:
    """kind:start:end of array<struct<kind, start, end, ..>>, comma-joined."""
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1), s["start"].cast("string"),
                s["end"].cast("string"),
            ),
        ),
        ",",
    )


def _word(text: Column, pattern: str) -> Column:
    found = F.regexp_extract(text, pattern, 1)
    return F.when(found == "", F.lit("^")).otherwise(F.regexp_replace(F.lower(found), "[0-9]", "0"))


def _occurrences(rows: DataFrame) -> DataFrame:
    """Add ``found``: array<struct<kind, start, end, value, patterns>> of base spans (kind 0..) and other identifier-like tokens (kind -1)."""
    base = F.concat(*[F.transform(F.col(kind), _labelled(k)) for k, kind in enumerate(KINDS)])
    rows = rows.withColumn("base", base)
    lead = lambda v: F.length(F.regexp_extract(v, r"^[\"'(<\[{|]*+", 0))
    trail = lambda v: F.length(F.regexp_extract(v, r"[\"')>\]}|,;:.!?]*$", 0))

    def trimmed(m: Column) -> Column:
        start, end = m["start"] + lead(m["value"]), m["end"] - trail(m["value"])
        return F.struct(
            F.lit(-1).alias("kind"), start.alias("start"), end.alias("end"),
            F.substring(m["value"], lead(m["value"]) + 1, end - start).alias("value"),
        )

    tokens = F.transform(matches(F.col("text"), TOKEN), trimmed)
    rows = rows.withColumn(
        "tokens",
        F.when(
            F.col("text").rlike("[0-9@]"), F.filter(tokens, lambda t: t["start"] < t["end"]),
        ).otherwise(F.array().cast("array<struct<kind:int,start:int,end:int,value:string>>")),
    )
    overlaps = lambda x: lambda t: (x["start"] < t["end"]) & (t["start"] < x["end"])

    def outside(blocks: Column) -> Column:
        return F.filter("tokens", lambda t: ~F.exists(blocks, lambda g: overlaps(g)(t) & F.exists(g["own"], lambda x: overlaps(x)(t))))

    fresh = F.when(F.size("base") == 0, F.col("tokens")).otherwise(_let(_blocks(F.col("base")), outside))

    def contextual(m: Column, cut: Callable[[Column, Column], Column]) -> Column:
        left = F.regexp_replace(cut(F.greatest(m["start"] - REACH, F.lit(0)), F.least(m["start"], F.lit(REACH))), r"[\"'(<\[{|]{1,4}$", "")
        right = cut(m["end"], F.lit(REACH))
        value = m["value"]
        one, two, after = _word(left, r"(\S+)\s*$"), _word(left, r"(\S+)\s+\S+\s*$"), _word(right, r"^[\s\"')>\]},;:.!?]*([^\s\"')>\]},;:.!?]+)")
        shape = F.regexp_replace(F.regexp_replace(F.regexp_replace(value, r"[A-Za-z]+", "a"), "[0-9]{4,}", "00"), "[0-9]{1,3}", "0")
        kinds = [
            F.concat_ws(" ", F.lit("two"), two, one), F.concat_ws(" ", F.lit("shape"), one, shape),
            F.concat_ws(" ", F.lit("around"), one, after),
        ]
        return F.struct(
            m["kind"].alias("kind"), m["start"].alias("start"), m["end"].alias("end"),
            F.xxhash64(F.lower(value)).alias("instance"), F.array(*[F.xxhash64(k) for k in kinds]).alias("patterns"),
        )

    found = _let(
        _pieces(F.col("text")),
        lambda p: F.transform(F.concat("base", fresh), lambda m: contextual(m, lambda start, n: _cut(p, start, n))),
    )
    return rows.withColumn("found", F.when(F.size("base") + F.size("tokens") > 0, found))


def _blocks(spans: Column) -> Column:
    """Spans in order of start, in blocks of the square root of their number: array<struct<start, end, own>>."""
    ordered = F.array_sort(F.transform(spans, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))))

    def block(own: Column) -> Column:
        return F.struct(
            F.element_at(own, 1)["start"].alias("start"),
            F.array_max(F.transform(own, lambda x: x["end"])).alias("end"), own.alias("own"),
        )

    def dealt(x: Column) -> Column:
        return _let(
            F.ceil(F.sqrt(F.size(x))).cast("int"),
            lambda b: F.transform(
                F.sequence(F.lit(0), F.ceil(F.size(x) / b).cast("int") - 1),
                lambda k: _let(F.slice(x, k * b + 1, b), block),
            ),
        )

    return _let(ordered, dealt)


def _pieces(text: Column) -> Column:
    """struct<parts, size>: the text in pieces of ``size`` characters, each with the REACH that follow, so that a place in a long text is found without going through all of it."""
    size = F.greatest(F.lit(1024), (F.sqrt(F.length(text)) * 16).cast("int"))
    return _let(
        size,
        lambda s: F.struct(
            F.transform(
                F.sequence(F.lit(0), F.floor(F.length(text) / s).cast("int")),
                lambda k: F.substring(text, k * s + 1, s + REACH),
            ).alias("parts"),
            s.alias("size"),
        ),
    )


def _cut(pieces: Column, start: Column, n: Column) -> Column:
    """At most REACH characters from ``start`` on."""
    at = F.floor(start / pieces["size"]).cast("int")
    return F.substring(F.element_at(pieces["parts"], at + 1), start - at * pieces["size"] + 1, n)


def confident_patterns(edges: DataFrame) -> DataFrame:
    """pattern, kind, confidence of the patterns that, after the last round, are confident for a kind.

    ``edges`` has pattern, instance, n (occurrences) and kind (-1 where no base pattern knows the instance).
    """
    edges = staged(edges, "pattern-edges")
    seeds = [F.when(F.col("kind") == k, 1.0).otherwise(0.0) for k in range(len(KINDS))]
    scored = edges.select("pattern", "instance", "n", "kind", *[s.alias(c) for s, c in zip(seeds, _SCORES)])
    for turn in range(ROUNDS):
        weight = F.when(F.col("kind") >= 0, 1.0).otherwise(F.lit(UNKNOWN) + (1 - UNKNOWN) * F.greatest(*_SCORES))
        sums = scored.groupBy("pattern").agg(
            F.sum(F.col("n") * weight).alias("total"), *[F.sum(F.col("n") * F.col(c)).alias(c) for c in _SCORES],
            *[F.sum(F.when(F.col("kind") == k, 1).otherwise(0)).alias(f"seeds{k}") for k in range(len(KINDS))],
        )
        shares = [F.when(F.col(f"seeds{k}") >= SUPPORT, F.col(c) / (F.col("total") + SMOOTHING)).otherwise(0.0) for k, c in enumerate(_SCORES)]
        sums = sums.select("pattern", *[s.alias(c) for s, c in zip(shares, _SCORES)])
        strong = staged(sums.filter(F.greatest(*_SCORES) >= CONFIDENCE), "patterns")
        if turn < ROUNDS - 1:
            # an instance's score: the chance that at least one of its confident patterns is right
            gained = edges.filter("kind < 0").join(strong, "pattern").groupBy("instance").agg(
                *[
                    (
                        1 - F.exp(
                            F.sum(
                                F.when(F.col(c) >= CONFIDENCE, F.log(F.greatest(1 - F.col(c), F.lit(1e-6)))).otherwise(0.0)
                            )
                        )
                    ).alias(f"gain_{c}") for c in _SCORES
                ]
            )
            scored = edges.join(staged(gained, "instances"), "instance", "left").select("pattern", "instance", "n", "kind", *[F.greatest(s, F.when(F.col("kind") < 0, F.coalesce(f"gain_{c}", F.lit(0.0))).otherwise(0.0)).alias(c) for s, c in zip(seeds, _SCORES)])
    best = F.greatest(*_SCORES)
    kind = reduce(lambda rest, k: F.when(F.col(_SCORES[k]) == best, k).otherwise(rest), reversed(range(len(KINDS))), F.lit(-1))
    return strong.select("pattern", kind.alias("as_kind"), best.alias("confidence"))


def find(documents: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_found of each row of ``documents``.

    ``spans`` lists base spans and those that the method adds (a kind each, never overlapping a base
    span); ``n_found`` counts the latter. Null and empty texts have none; repeated rows and rows that
    share an id give a row each; further columns are not read; an empty table gives no rows. Whole texts are searched; the
    time for one grows with its length and, for n matches, with n to the power 1.5.
    """
    rows = documents.select(documents["doc_id"].alias("doc_id"), text_of(documents).alias("text"))
    counts = [F.size(kind).cast("long").alias(f"n_{kind}") for kind in KINDS]
    rows = _occurrences(base_spans(rows))
    slim = F.transform("base", lambda b: F.struct(b["kind"].alias("kind"), b["start"].alias("start"), b["end"].alias("end")))
    rows = staged(rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", *counts, slim.alias("base"), "found"), "occurrences")

    each = rows.select("row", F.explode("found").alias("m")).select("row", "m.*")
    edges = each.select(
        "instance", "kind", F.explode("patterns").alias("pattern"),
    ).groupBy("pattern", "instance").agg(F.count("*").alias("n"), F.max("kind").alias("kind"))
    strong = confident_patterns(edges)
    marked = each.filter("kind < 0").select("row", "start", "end", F.explode("patterns").alias("pattern")).join(strong, "pattern")
    marked = marked.groupBy("row", "start", "end").agg(F.max_by("as_kind", F.struct("confidence", -F.col("as_kind"))).alias("kind"))
    added = marked.groupBy("row").agg(F.collect_list(F.struct("kind", "start", "end")).alias("added"))
    rows = rows.drop("found").join(added, "row", "left").withColumn(
        "added", F.coalesce("added", F.array().cast("array<struct<kind:int,start:int,end:int>>")),
    )
    return rows.select(
        "doc_id", *[f"n_{k}" for k in KINDS], F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.array_sort(F.concat("base", "added"))).alias("spans"),
        F.size("added").cast("long").alias("n_found"),
    )
