"""Numbers, arrays, JSON text, durations and costs as column expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# USD per million tokens.
RATES = {"input": 0.20, "cached_input": 0.02, "cache_write": 0.25, "output": 1.20}
# End of the fixed values.

#: Days after its first playing during which a package is fetched again.
RESTLESS_DAYS = 180


@dataclass(frozen=True)
class Rates:
    """USD per million tokens."""

    input: float = RATES["input"]
    cached_input: float = RATES["cached_input"]
    cache_write: float = RATES["cache_write"]
    output: float = RATES["output"]


def teams(percent: Column, correct: Column) -> Column:
    """Teams that played, from the share and number of right answers; 0 without a share."""
    share = F.coalesce(percent.cast("double"), F.lit(0.0))
    return F.when(share == 0, F.lit(0.0)).otherwise(correct / (share / 100))


def paired(first: Column, second: Column) -> tuple[Column, Column]:
    """Both arrays cut to the length of the shorter; null counts as empty."""
    a, b = F.coalesce(first, F.array().cast("array<double>")), F.coalesce(second, F.array().cast("array<bigint>"))
    n = F.least(F.size(a), F.size(b))
    return F.slice(a, F.lit(1), n), F.slice(b, F.lit(1), n)


def total_teams(percents: Column, corrects: Column) -> Column:
    return F.aggregate(F.zip_with(percents, corrects, teams), F.lit(0.0), lambda total, x: total + x)


def solve_rate(corrects: Column, total: Column) -> Column:
    """Right answers over teams; null without teams."""
    right = F.aggregate(corrects, F.lit(0).cast("bigint"), lambda n, x: n + F.coalesce(x, F.lit(0).cast("bigint")))
    return F.when(total != 0, right / total)


def ordered_union(arrays: Column) -> Column:
    """Distinct elements of an array of arrays in the order of their first appearance."""
    return F.array_distinct(F.flatten(arrays))


def compact_json(c: Column) -> Column:
    """JSON text without spaces, as pages are stored."""
    return F.to_json(c)


def spaced_json(c: Column) -> Column:
    """A numeric array as JSON text with ', ' between, as canonical records export it."""
    return F.concat(F.lit("["), F.array_join(F.transform(c, lambda x: F.coalesce(x.cast("string"), F.lit("null"))), ", "), F.lit("]"))


def truthy(c: Column) -> Column:
    """1 unless the JSON text is absent, false, null, zero or empty."""
    return F.when(c.isNull() | c.isin("", "false", "null", "0", "0.0", "[]", "{}"), 0).otherwise(1)


def recent(played: Column, today: Column, days: int = RESTLESS_DAYS) -> Column:
    """Whether a date text is at most ``days`` before today, compared as text; null is not."""
    return F.coalesce(played, F.lit("")) >= F.date_format(F.date_sub(today, days), "yyyy-MM-dd")


def index_url(base: str, page: Column) -> Column:
    return F.when(page == 1, F.lit(base)).otherwise(F.concat(F.lit(base + "/?page="), page.cast("string")))


def _without_dots(path: Column) -> Column:
    """A path without . and .. segments; those beyond its top are dropped."""
    parts = F.split(path, "/")

    def step(done: Column, part: Column) -> Column:
        up = F.when(F.size(done) > 1, F.slice(done, F.lit(1), F.size(done) - 1)).otherwise(done)
        return F.when(part == "..", up).when(part == ".", done).otherwise(F.concat(done, F.array(part)))

    last = F.when(F.element_at(parts, -1).isin(".", ".."), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
    return F.array_join(F.concat(F.aggregate(parts, F.array().cast("array<string>"), step), last), "/")


def absolute_url(base: str, url: Column) -> Column:
    """A link as an absolute one: absolute kept, //host, /path and path resolved against the site ``base``."""
    rooted = F.when(url.startswith("/"), url).otherwise(F.concat(F.lit("/"), url))
    path = F.regexp_extract(rooted, r"^[^?#]*+", 0)
    resolved = F.when(path.rlike(r"/\.{1,2}(?:/|$)"), F.concat(_without_dots(path), F.substring(rooted, F.length(path) + 1, F.length(rooted)))).otherwise(rooted)
    return F.when(url.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), url).when(url.startswith("//"), F.concat(F.lit(base.split("//")[0]), url)).otherwise(F.concat(F.lit(base), resolved))


def cost(input_tokens: Column, cached: Column, written: Column, output: Column, rates: Rates = Rates()) -> Column:
    """USD of token counts: uncached input (never below 0), cached, written to the cache, and output."""
    uncached = F.greatest(input_tokens - cached - written, F.lit(0))
    return (uncached * rates.input + cached * rates.cached_input + written * rates.cache_write + output * rates.output) / 1_000_000


def duration(seconds: Column) -> Column:
    """Whole seconds as 9s, 1m15s or 3h04m; negative ones as 0s."""
    s = F.greatest(seconds, F.lit(0)).cast("long")
    hours, minutes = F.floor(s / 3600), F.floor(s % 3600 / 60)
    return F.when(hours > 0, F.format_string("%dh%02dm", hours, minutes)).when(minutes > 0, F.format_string("%dm%02ds", minutes, s % 60)).otherwise(F.format_string("%ds", s))
