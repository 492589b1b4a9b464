"""Line deduplication by distinct-site spread.

Each line hash gets a HyperLogLog sketch of the sites (``source``) it stands on; sketches merge
in the aggregation, so a line that stands everywhere costs one small row a task. Lines whose
estimate is near the threshold get an exact distinct count. Lines on at least ``min_sites``
sites are boilerplate and are removed. Built from DataFrame expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import staged, text_of

#: Sites from which on a line is boilerplate.
MIN_SITES = 5
#: Shorter lines (white space at the ends apart) repeat by chance and stay.
MIN_CHARS = 10
#: log2 of the registers of a sketch (relative error about 1.04 / sqrt(2 ** LG_K)).
LG_K = 10
#: Relative half-width of the band around the threshold in which lines are counted exactly.
BAND = 0.2
#: Boilerplate lines that are broadcast at most (16 bytes each); more are joined by a shuffle.
BROADCAST_ROWS = 500_000


def line_key(line: Column) -> Column:
    return F.xxhash64(F.trim(line))


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def site_lines(documents: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc, own (hash of the text), site, line: each different line (its hash) of each document once."""
    long = F.filter(_lines(text_of(documents)), lambda x: F.length(F.trim(x)) >= min_chars)
    keys = F.array_distinct(F.transform(long, line_key))
    return documents.select(
        documents["doc_id"].alias("doc"), F.xxhash64(text_of(documents)).alias("own"),
        F.coalesce(documents["source"].cast("string"), F.lit("")).alias("site"), F.explode(keys).alias("line"),
    )


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """line, first_doc of the lines that stand on at least ``min_sites`` sites."""
    spread = lines.groupBy("line").agg(F.hll_sketch_agg("site", F.lit(LG_K)).alias("sketch"), F.min("doc").alias("first_doc"))
    spread = spread.select(
        "line", "first_doc", F.hll_sketch_estimate("sketch").alias("sites"),
    ).filter(F.col("sites") >= min_sites * (1 - BAND) - 1)
    spread = staged(spread, "line-spread")
    wide = F.col("sites") > min_sites * (1 + BAND) + 1
    near = spread.filter(~wide)
    exact = lines.join(
        near.select("line"), "line", "left_semi",
    ).groupBy("line").agg(F.countDistinct("site").alias("exact")).filter(F.col("exact") >= min_sites)
    return spread.filter(wide).select("line", "first_doc").unionByName(near.join(exact, "line").select("line", "first_doc"))


def remove_boilerplate(documents: DataFrame, min_sites: int = MIN_SITES, min_chars: int = MIN_CHARS, keep_first: bool = False) -> DataFrame:
    """``documents`` with the cleaned text, and n_lines and n_removed as the last two columns.

    With ``keep_first`` a boilerplate line stays in the document with the smallest doc_id that has
    it. Null texts stay null and, like empty ones, have no lines; a null source is a site of its own,
    the empty one; repeated rows and rows that share a doc_id are each cleaned; columns of any name
    pass through (two of the same name are allowed but for text, doc_id and source). Whole texts are cleaned;
    the time for one of n different boilerplate lines grows as n to the power 1.5.
    """
    lines = staged(site_lines(documents, min_chars), "site-lines")
    found = staged(boilerplate(lines, min_sites), "boilerplate")
    small = found.count() <= BROADCAST_ROWS
    hit = lines.join(F.broadcast(found) if small else found, "line")
    if keep_first:
        hit = hit.filter(~F.col("doc").eqNullSafe(F.col("first_doc")))
    gone = hit.groupBy("doc", "own").agg(F.collect_set("line").alias("listed"))
    # a line is looked for in one of as many parts as the square root of their number
    parts = F.ceil(F.sqrt(F.size("listed"))).cast("int")
    dealt = F.transform(F.sequence(F.lit(0), parts - 1), lambda k: F.filter("listed", lambda x: F.pmod(x, parts) == k))
    gone = gone.select("doc", "own", dealt.alias("gone"))

    names, fields = documents.columns, documents.schema.fields
    at, key = names.index("text"), names.index("doc_id")
    rows = documents.toDF(*[f"c{i}" for i in range(len(names))])
    text = F.col(f"c{at}").cast("string")
    # by id and text: rows of one id, or of none, that differ are cleaned apart
    joined = rows.join(gone, (F.xxhash64(F.coalesce(text, F.lit(""))) == gone["own"]) & rows[f"c{key}"].eqNullSafe(gone["doc"]), "left")
    split = _lines(text)
    kept = F.filter(
        split,
        lambda x: ~F.array_contains(
            F.element_at("gone", F.pmod(line_key(x), F.size("gone")).cast("int") + 1), line_key(x),
        ),
    )
    some = F.col("gone").isNotNull()
    joined = joined.withColumn("kept", F.when(some, kept))
    empty = F.coalesce(F.length(text), F.lit(0)) == 0
    cleaned = F.when(some, F.array_join("kept", "\n")).otherwise(F.col(f"c{at}"))
    out = [cleaned.alias("text") if i == at else F.col(f"c{i}").alias(n) for i, n in enumerate(names)]
    n_lines = F.when(empty, 0).otherwise(F.size(split)).cast("long")
    return joined.select(
        *out, n_lines.alias("n_lines"),
        F.when(some, F.size(split) - F.size("kept")).otherwise(0).cast("long").alias("n_removed"),
    )


def dedup_stage(documents: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """``documents``, all columns, after removal with ``keep_first``; documents that lost every line go.

    A document all of whose lines stand elsewhere first has nothing of its own. n_chars, where it is a
    number, follows the new text.
    """
    names = documents.columns
    out = remove_boilerplate(documents, min_sites, keep_first=True)
    rows = out.toDF(*[f"c{i}" for i in range(len(names))], "n_lines", "n_removed")
    text = F.col(f"c{names.index('text')}")
    rows = rows.filter((F.col("n_removed") == 0) | (F.length(F.regexp_replace(text, r"\s+", "")) > 0))
    columns = []
    for i, f in enumerate(documents.schema.fields):
        own = F.col(f"c{i}")
        if f.name == "n_chars" and isinstance(f.dataType, T.NumericType):
            own = F.when(F.col("n_removed") > 0, F.length(text)).otherwise(own).cast(f.dataType)
        columns.append(own.alias(f.name))
    return rows.select(*columns)


def digests(documents: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_removed and the hash of the cleaned text (empty where null)."""
    out = remove_boilerplate(documents.select("doc_id", "text", "source"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


#: The same by exact counts, for DuckDB.
ORACLE_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, coalesce(source, '') AS site FROM documents),
l AS (SELECT r, doc_id, site, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM d WHERE text <> ''),
b AS (SELECT trim(line) AS line FROM l WHERE length(trim(line)) >= {MIN_CHARS} GROUP BY 1 HAVING count(DISTINCT site) >= {MIN_SITES}),
m AS (SELECT l.*, b.line IS NOT NULL AS gone FROM l LEFT JOIN b ON trim(l.line) = b.line),
g AS (SELECT r, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed, string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone) AS kept FROM m GROUP BY r)
SELECT doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS text_sha256
FROM d LEFT JOIN g USING (r)
"""
