"""Exact draws without an order of all rows: a threshold is found by counting, and rows below it are kept where they are.

Each row has a rank of 64 hexadecimal digits that depends on its key and a seed, so it is as good as random. The rank of the
n-th row is found digit by digit: rows are counted by the next four digits of their rank, which takes an aggregation of at
most 65,536 rows, until the few rows that share all digits so far can be looked at. The draw is then a filter: it keeps the
partitions of its input, and no task sees more than its own rows.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Digits of a rank by which rows are counted at once, and rows that are looked at themselves.
DIGITS, FEW = 4, 1_000


def least(rows: DataFrame, n: int, rank: Column, tie: Column) -> DataFrame:
    """The ``n`` rows of the least rank (64 hexadecimal digits), all if there are no more; equal ranks by ``tie``, nulls first.

    Of rows that are equal in both any are taken, as many as are still wanted. ``rows`` is evaluated a few times and must
    give the same rows each time.
    """
    if n <= 0:
        return rows.limit(0)
    prefix, below = "", 0
    while True:
        width = len(prefix) + DIGITS
        own = rows.filter(rank.startswith(prefix)) if prefix else rows
        counts = sorted(own.groupBy(F.substring(rank, 1, width).alias("digits")).agg(F.count("*").alias("n")).collect())
        for digits, count in counts:
            if below + count >= n:
                break
            below += count
        else:
            return rows
        prefix = digits
        if count <= FEW or len(prefix) == 64:
            break
    if below + count == n:
        return rows.filter(F.substring(rank, 1, len(prefix)) <= prefix)
    few = rows.filter(rank.startswith(prefix)).select(rank.alias("rank"), tie.alias("tie"))
    edge = few.groupBy("rank", "tie").agg(F.count("*").alias("n")).orderBy("rank", F.asc_nulls_first("tie")).collect()
    out = rows.filter(F.substring(rank, 1, len(prefix)) < prefix)
    for row in edge:
        some = rows.filter((rank == row["rank"]) & tie.eqNullSafe(F.lit(row.tie)))
        if below + row.n >= n:  # the last ones; only some of those that are alike
            return out.unionByName(some if below + row.n == n else some.limit(n - below))
        below += row.n
        upto = tie.isNull() if row.tie is None else tie.isNull() | (tie <= F.lit(row.tie))
        out = rows.filter((rank < row["rank"]) | ((rank == row["rank"]) & upto))
    return out


def uniform(rows: DataFrame, key: str, n: int, seed: int | None = None) -> DataFrame:
    """``n`` rows drawn at random without replacement, all if there are no more; ``key`` tells rows apart.

    The draw depends on keys and seed alone.
    """
    salt = random.SystemRandom().getrandbits(64) if seed is None else seed
    return least(rows, n, F.sha2(F.concat_ws("|", F.coalesce(F.col(key).cast("string"), F.lit("null")), F.lit(f"draw {salt}")), 256), F.col(key))
