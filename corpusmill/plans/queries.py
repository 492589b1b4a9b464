"""Registered queries over the shared tables, each with its SQL counterpart for DuckDB.

The operators' patterns are parameters; here they look for what the Latin-script tables hold. Numbers
with fractions are rounded after adding an epsilon, since two engines may differ at rounding ties.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text, values
from ..operators import curate, draw, funnel, merge, review
from ..sources import pages
from . import source_queries, stage_queries

LATIN = text.Patterns(
    host_note=r"(?U)<!--(?:[^>]*?)-->|<script>[^<]*</script>",
    multipart=r"(?U)(?:^\s*+|(?<!\s)[\s&&[^\n]]*+\n\s*+)(?:\[[^\]]*+\]\s*+)*+(Of|The)\b", blitz="of",
    refers_to_other=r"(?U)[Tt]okens?\s*=", handout_lost=r"(?iU)licen[cs]ed\s+under[^.\]]{0,60}(?:apache|cc)",
)
LIMIT = 50


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _round(c: Column) -> Column:
    return F.round(c + 1e-9, 6)


def clean_text(spark: SparkSession, sf: str) -> DataFrame:
    dirty = F.concat(F.replace(F.col("text"), F.lit(" "), F.lit(" \t ")), F.lit("\r\n\n\n\n x "))
    return _table(spark, sf, "documents").select("doc_id", text.clean_text(dirty).alias("cleaned"))


def content_hash(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "documents").select(
        "doc_id", text.content_hash(F.col("text"), F.col("lang"), F.col("source")).alias("content_hash"),
    )


def page_hash(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "pages").select("page_id", text.page_hash(F.col("html")).alias("page_hash"))


def _key(spark: SparkSession, sf: str, native: bool) -> DataFrame:
    return curate.with_key(_table(spark, sf, "documents"), native, "text").select("doc_id", "nhash")


def normalized_key(spark: SparkSession, sf: str) -> DataFrame:
    return _key(spark, sf, True)


def normalized_key_general(spark: SparkSession, sf: str) -> DataFrame:
    return _key(spark, sf, False)


def _excluded(spark: SparkSession, sf: str) -> DataFrame:
    return curate.exclusions(_table(spark, sf, "documents"), LATIN, "text", "source", "doc_id")


def exclusion_counts(spark: SparkSession, sf: str) -> DataFrame:
    return curate.exclusion_counts(_excluded(spark, sf))


def clean_view(spark: SparkSession, sf: str) -> DataFrame:
    return curate.clean(_table(spark, sf, "documents"), _excluded(spark, sf), "doc_id").select("doc_id", "lang", "n_chars")


def canonical_groups(spark: SparkSession, sf: str) -> DataFrame:
    keyed = curate.with_key(_table(spark, sf, "documents"), True, "text")
    return keyed.groupBy("nhash").agg(
        F.min("doc_id").alias("canonical_id"), F.count("*").alias("printings"),
        curate.longest(F.col("source"), F.col("doc_id")).alias("longest_source"),
    )


def printing_map(spark: SparkSession, sf: str) -> DataFrame:
    return curate.printing_map(_table(spark, sf, "documents"), True, "doc_id", "text")


def _as_questions(spark: SparkSession, sf: str) -> DataFrame:
    """Documents in the shape of clean questions: other columns stand in for the fields that merge."""
    d = _table(spark, sf, "documents")
    return d.select(
        F.col("doc_id").alias("id"),
        (F.col("doc_id") % 7).alias("package_id"),
        F.col("text").alias("question"),
        F.col("source").alias("answer"),
        F.col("lang").alias("explanation"),
        F.concat("lang", F.lit(" "), "source").alias("acceptance_criteria"),
        F.lit("").alias("handout_text"),
        F.concat(F.lit(" "), "source", F.lit(" ")).alias("source_references"),
        F.array(F.col("doc_id") % 3, F.col("doc_id") % 5).alias("tournament_ids"),
        F.array((F.col("doc_id") % 4 * 25).cast("double"), F.lit(50.0)).alias("solve_percentages"),
        F.array(F.col("doc_id") % 11).alias("correct_answers"),
        F.lit("").alias("content_hash"),
    )


def canonical_merge(spark: SparkSession, sf: str) -> DataFrame:
    m = curate.merge_printings(_as_questions(spark, sf), True)
    joined = lambda c: F.array_join(F.transform(c, lambda x: x.cast("long").cast("string")), ", ").alias(c)
    return m.select(
        "id", "package_id", "answer", "explanation", "acceptance_criteria", "source_references",
        joined("tournament_ids"), joined("solve_percentages"), joined("correct_answers"), "content_hash", "printings",
        F.col("playings").cast("long").alias("playings"), _round(F.col("total_teams")).alias("total_teams"),
        _round(F.col("solve_rate")).alias("solve_rate"),
    )


def canonical_summary(spark: SparkSession, sf: str) -> DataFrame:
    return curate.summary(printing_map(spark, sf))


def longest_text(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "conversations").groupBy("conv_id", "role").agg(curate.longest(F.col("text"), F.col("turn")).alias("longest"))


def ordered_union(spark: SparkSession, sf: str) -> DataFrame:
    suppliers = curate.in_order(F.col("l_linenumber"), F.array("l_suppkey"))
    found = _table(spark, sf, "lineitem").groupBy("l_orderkey").agg(values.ordered_union(suppliers).alias("s"))
    return found.select("l_orderkey", F.array_join(F.transform("s", lambda x: x.cast("string")), ",").alias("suppliers"))


def pooled_rate(spark: SparkSession, sf: str) -> DataFrame:
    line = _table(spark, sf, "lineitem")
    played = values.teams(F.col("l_discount") * 100, F.col("l_quantity"))
    pooled = line.groupBy("l_orderkey").agg(F.sum(played).alias("total"), F.sum("l_quantity").alias("right"))
    return pooled.select(
        "l_orderkey", _round(F.col("total")).alias("total_teams"),
        _round(F.when(F.col("total") != 0, F.col("right") / F.col("total"))).alias("solve_rate"),
    )


def paired_truncate(spark: SparkSession, sf: str) -> DataFrame:
    e = _table(spark, sf, "events")
    in_order = lambda c, kind: curate.in_order(F.col("event_id"), F.array(c.cast(kind)))
    arrays = e.groupBy("user_id").agg(
        F.flatten(in_order(F.col("value"), "double")).alias("p"),
        F.flatten(in_order(F.col("event_id"), "bigint")).alias("c"),
    )
    p, c = values.paired(F.col("p"), F.slice("c", F.lit(1), F.lit(3)))
    return arrays.select(
        "user_id", F.size(p).cast("long").alias("pairs"),
        _round(F.aggregate(p, F.lit(0.0), lambda a, x: a + F.coalesce(x, F.lit(0.0)))).alias("total"),
        F.array_join(F.transform(c, lambda x: x.cast("string")), ",").alias("events"),
    )


def note_split(spark: SparkSession, sf: str) -> DataFrame:
    html = F.col("html")
    return _table(spark, sf, "pages").select(
        "page_id", text.host_notes(html, LATIN).alias("notes"), text.without_host_notes(html, LATIN).alias("rest"),
    )


def kind_detect(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "conversations").select("conv_id", "turn", text.question_kind(F.col("text"), LATIN).alias("kind"))


def link_extract(spark: SparkSession, sf: str) -> DataFrame:
    found = pages.links(F.col("html"), r'href="([^"]*)"')
    return _table(spark, sf, "pages").select("page_id", F.array_join(found, " ").alias("links"), F.size(found).cast("long").alias("n"))


def payload_extract(spark: SparkSession, sf: str) -> DataFrame:
    e = _table(spark, sf, "events")
    return e.select(
        "event_id", F.expr("try_cast(get_json_object(props, '$.k') AS bigint)").alias("k"),
        values.truthy(F.get_json_object("props", "$.k")).cast("long").alias("flag"),
    )


def script_extract(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "pages").select("page_id", F.regexp_extract("html", r"track\((\d+)\)", 1).cast("long").alias("tracked"))


def upsert_latest(spark: SparkSession, sf: str) -> DataFrame:
    e = _table(spark, sf, "events").select("user_id", "event_id", "event_type", "value")
    old = e.filter("event_id % 2 = 0").groupBy("user_id").agg(
        F.min_by(F.struct("event_id", "event_type", "value"), "event_id").alias("r")
    ).select("user_id", "r.*")
    return merge.upsert(old, e.filter("event_id % 2 = 1"), "user_id", ["event_id"]).withColumn("value", _round(F.col("value")))


def _outcomes(spark: SparkSession, sf: str) -> DataFrame:
    e = _table(spark, sf, "events")
    old = e.filter("event_id % 2 = 0").groupBy("user_id").agg(
        F.max_by("event_type", "event_id").alias("old_hash"),
        F.when(F.max("event_id") % 4 == 0, "ok").otherwise("http_error").alias("old_status"),
    )
    new = e.filter("event_id % 2 = 1").groupBy("user_id").agg(
        F.max_by("event_type", "event_id").alias("page_hash"),
        F.when(F.max("event_id") % 10 == 1, "timeout").alias("error"),
        F.when(F.max("event_id") % 10 == 3, "no payload").alias("parse_error"), (F.count("*") % 3).alias("questions"),
    )
    both = new.join(old, "user_id", "left")
    c = F.col
    return both.select(
        "user_id",
        merge.outcome(
            c("page_hash"), c("old_hash"), c("old_status"), c("error"), c("parse_error"), c("questions"),
        ).alias("outcome"),
        "questions",
    )


def outcome_classify(spark: SparkSession, sf: str) -> DataFrame:
    return _outcomes(spark, sf).select("user_id", "outcome")


def outcome_counts(spark: SparkSession, sf: str) -> DataFrame:
    return merge.outcome_counts(_outcomes(spark, sf))


def settled_filter(spark: SparkSession, sf: str) -> DataFrame:
    o = _table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderstatus") == "F", "ok").when(F.col("o_orderstatus") == "O", "empty").otherwise("http_error").alias("status"),
        F.when(
            F.col("o_orderkey") % 10 != 0, F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"),
        ).alias("played_at_start"),
    )
    return merge.settled(o, F.to_date(F.lit("1998-01-01")), 365).select("id", "status", "played_at_start")


def pending_anti(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents").select(F.col("doc_id").alias("id"))
    return funnel.pending(docs, _table(spark, sf, "labels").withColumnRenamed("doc_id", "question_id"))


def usable_join(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "lang", "n_chars")
    t = _table(spark, sf, "labels").select(
        F.col("doc_id").alias("question_id"),
        F.when(F.col("quality") == 0, "untranslatable").when(F.col("toxic") == 1, "adapted").otherwise("translated").alias("status"),
    )
    return funnel.translated(docs, t)


def title_join(spark: SparkSession, sf: str) -> DataFrame:
    o = _table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("package_id"),
        *[F.lit("").alias(c) for c in ("content_hash", *text.CONTENT_FIELDS)],
    )
    titles = _table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("title"))
    none = spark.createDataFrame([], "question_id bigint")
    return review.pending_inputs(o, none, titles).select("question_id", "package_title")


def _pruned(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    docs = _table(spark, sf, "documents").select(F.col("doc_id").alias("id"), text.content_hash(F.col("text")).alias("content_hash"))
    changed = F.when(F.col("question_id") % 3 == 0, F.lit("stale")).otherwise(F.col("content_hash"))
    t = _table(spark, sf, "labels").select(F.col("doc_id").alias("question_id")).join(docs, F.col("question_id") == F.col("id")).select(
        "question_id", changed.alias("content_hash"),
    )
    return merge.prune(t, docs)


def stale_prune(spark: SparkSession, sf: str) -> DataFrame:
    kept, gone = _pruned(spark, sf)
    return kept.select("question_id", F.lit("kept").alias("fate")).unionByName(gone.select("question_id", F.lit("pruned").alias("fate")))


def sample_hash(spark: SparkSession, sf: str) -> DataFrame:
    return review.sample_by_hash(_table(spark, sf, "documents").select("doc_id"), "doc_id", "7", LIMIT)


def sample_random(spark: SparkSession, sf: str) -> DataFrame:
    return draw.uniform(_table(spark, sf, "documents").select("doc_id"), "doc_id", LIMIT, 7)


def _as_translations(spark: SparkSession, sf: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("long")
    return _table(spark, sf, "events").select(
        F.col("event_type").alias("status"), F.lit(1).cast("long").alias("api_requests"),
        (k * 10).alias("input_tokens"), k.alias("cached_input_tokens"), (k % 3).alias("cache_write_input_tokens"),
        (k * 2).alias("output_tokens"), k.alias("reasoning_output_tokens"),
    )


def status_counts(spark: SparkSession, sf: str) -> DataFrame:
    return funnel.status_counts(_as_translations(spark, sf))


def usage_totals(spark: SparkSession, sf: str) -> DataFrame:
    return funnel.usage_totals(_as_translations(spark, sf))


def usage_cost(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col
    spent = values.cost(c("l_quantity") * 1000, c("l_extendedprice"), c("l_discount") * 100_000, c("l_tax") * 100_000)
    return _table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", _round(spent).alias("usd"))


def corpus_funnel(spark: SparkSession, sf: str) -> DataFrame:
    d = _table(spark, sf, "documents")
    canonical = canonical_groups(spark, sf).select(F.col("canonical_id").alias("id"))
    t = _table(spark, sf, "labels").select(
        F.col("doc_id").alias("question_id"),
        F.when(F.col("quality") == 1, "translated").otherwise("untranslatable").alias("status"),
    )
    return funnel.funnel(d, _excluded(spark, sf), canonical, t, "doc_id")


def review_rounds(spark: SparkSession, sf: str) -> DataFrame:
    rounds = _table(spark, sf, "conversations").filter("role = 'assistant'")
    return review.last_round(rounds, "conv_id", "turn", F.length("text") > 300)


def durations(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "orders").select("o_orderkey", values.duration(F.col("o_orderkey") * 7 - 20).alias("shown"))


def index_urls(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "pages").select("page_id", values.index_url("https://site.example", F.col("page_id") + 1).alias("url"))


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Reprints of documents merged into canonical groups."""
    return canonical_groups(spark, sf)


Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (clean_text, content_hash, page_hash, normalized_key, normalized_key_general, exclusion_counts, clean_view, canonical_groups, printing_map, canonical_merge, canonical_summary, longest_text, ordered_union, pooled_rate, paired_truncate, note_split, kind_detect, link_extract, payload_extract, script_extract, upsert_latest, outcome_classify, outcome_counts, settled_filter, pending_anti, usable_join, title_join, stale_prune, sample_hash, sample_random, status_counts, usage_totals, usage_cost, corpus_funnel, review_rounds, durations, index_urls)
} | {"exclusion_reason": _excluded} | stage_queries.QUERIES | source_queries.QUERIES

_FOLDED = r"trim(regexp_replace(regexp_replace(replace(replace(lower(coalesce(text, '')), 'ß', 'ss'), 'ё', 'е'), '[^\p{L}\p{N}_\s]', ' ', 'g'), '\s+', ' ', 'g'))"
_NHASH = f"substr(sha256({_FOLDED}), 1, 16)"
_REASON = r"CASE WHEN trim(coalesce(source, '')) = '' THEN 'no_answer' WHEN length(trim(coalesce(text, ''), chr(32) || chr(9) || chr(10) || chr(13))) < 40 THEN 'not_a_question' WHEN regexp_matches(text, '[Tt]okens?\s*=') THEN 'refers_to_other_question' WHEN regexp_matches(text, '(?i)licen[cs]ed\s+under[^.\]]{0,60}(?:apache|cc)') THEN 'handout_lost' END"
_HASH5 = "substr(sha256(question || chr(0) || answer || chr(0) || explanation || chr(0) || acceptance_criteria || chr(0) || ''), 1, 16)"
_NOTE = "<!--(?:[^>]*?)-->|<script>[^<]*</script>"


def _tidy(x: str) -> str:
    """Lines of a text without white space at their ends and runs of it, for DuckDB."""
    return rf"regexp_replace(regexp_replace({x}, '[ \t]+', ' ', 'g'), '(?m)^[ \t\x0B\f\r]+|[ \t\x0B\f\r]+$', '', 'g')"


def _stripped(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


_EXCLUDED = f"(SELECT doc_id AS question_id, {_REASON} AS reason FROM documents WHERE ({_REASON}) IS NOT NULL)"
_MAP = f"(SELECT doc_id AS question_id, min(doc_id) OVER (PARTITION BY {_NHASH}) AS canonical_id FROM documents)"
_OUTCOMES = """(SELECT n.user_id, n.questions,
  CASE WHEN n.error IS NOT NULL THEN 'fetch_error' WHEN n.page_hash = o.old_hash AND o.old_status = 'ok' THEN 'unchanged' WHEN n.page_hash = o.old_hash THEN 'recovered' WHEN n.parse_error IS NOT NULL THEN 'parse_error' WHEN n.questions = 0 THEN 'empty' WHEN o.old_status = 'ok' THEN 'updated' ELSE 'new' END AS outcome
FROM (SELECT user_id, arg_max(event_type, event_id) AS page_hash,
  CASE WHEN max(event_id) % 10 = 1 THEN 'timeout' END AS error,
  CASE WHEN max(event_id) % 10 = 3 THEN 'no payload' END AS parse_error, count(*) % 3 AS questions FROM events
  WHERE event_id % 2 = 1 GROUP BY user_id) n
LEFT JOIN (SELECT user_id, arg_max(event_type, event_id) AS old_hash,
  CASE WHEN max(event_id) % 4 = 0 THEN 'ok' ELSE 'http_error' END AS old_status FROM events WHERE event_id % 2 = 0
  GROUP BY user_id) o ON n.user_id = o.user_id)"""
_K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"

ORACLE_SQL: dict[str, str] = {
    "clean_text": "SELECT doc_id, " + _stripped("regexp_replace(" + _tidy(r"regexp_replace(replace(text, ' ', ' ' || chr(9) || ' ') || chr(13) || chr(10) || chr(10) || chr(10) || chr(10) || ' x ', '\r\n?', chr(10), 'g')") + r", '\n{3,}', chr(10) || chr(10), 'g')") + " AS cleaned FROM documents",
    "content_hash": "SELECT doc_id, substr(sha256(text || chr(0) || lang || chr(0) || source), 1, 16) AS content_hash FROM documents",
    "page_hash": "SELECT page_id, substr(sha256(html), 1, 16) AS page_hash FROM pages",
    "normalized_key": f"SELECT doc_id, {_NHASH} AS nhash FROM documents",
    "normalized_key_general": f"SELECT doc_id, {_NHASH} AS nhash FROM documents",
    "exclusion_reason": f"SELECT * FROM {_EXCLUDED}",
    "exclusion_counts": f"SELECT reason, count(*) AS n FROM {_EXCLUDED} GROUP BY reason",
    "clean_view": f"SELECT doc_id, lang, n_chars FROM documents WHERE ({_REASON}) IS NULL",
    "canonical_groups": f"""SELECT {_NHASH} AS nhash, min(doc_id) AS canonical_id, count(*) AS printings, arg_max(source,
  struct_pack(l := length(source), i := -doc_id)) AS longest_source FROM documents GROUP BY 1""",
    "printing_map": f"SELECT * FROM {_MAP}",
    "canonical_merge": f"""
WITH q AS (SELECT {_NHASH} AS nhash, doc_id AS id, text AS question, source AS answer, lang AS explanation,
  lang || ' ' || source AS acceptance_criteria, ' ' || source || ' ' AS source_references, doc_id % 3 AS t1,
  doc_id % 5 AS t2, doc_id % 4 * 25 AS pct, doc_id % 11 AS right_ FROM documents),
g AS (SELECT nhash, min(id) AS id, arg_min(question, id) AS question, arg_max(answer, struct_pack(l := length(answer),
  i := -id)) AS answer, arg_max(explanation, struct_pack(l := length(explanation), i := -id)) AS explanation,
  arg_max(acceptance_criteria, struct_pack(l := length(acceptance_criteria), i := -id)) AS acceptance_criteria,
  arg_max(source_references, struct_pack(l := length(trim(source_references)), i := -id)) AS source_references,
  string_agg(CAST(pct AS VARCHAR), ', ' ORDER BY id) AS solve_percentages, string_agg(CAST(right_ AS VARCHAR), ', '
  ORDER BY id) AS correct_answers, count(*) AS printings,
  sum(CASE WHEN pct = 0 THEN 0.0 ELSE right_ / (pct / 100.0) END) AS total, sum(right_) AS answers FROM q GROUP BY nhash),
u AS (SELECT nhash, string_agg(CAST(t AS VARCHAR), ', ' ORDER BY first) AS tournament_ids FROM (SELECT nhash, t,
  min(id * 2 + k) AS first FROM (SELECT nhash, id, t1 AS t, 0 AS k FROM q UNION ALL SELECT nhash, id, t2, 1 FROM q)
  GROUP BY nhash, t) GROUP BY nhash)
SELECT id, id % 7 AS package_id, answer, explanation, acceptance_criteria, source_references, tournament_ids,
  solve_percentages, correct_answers, {_HASH5} AS content_hash, printings, printings AS playings, round(total + 1e-9,
  6) AS total_teams, CASE WHEN total <> 0 THEN round(answers / total + 1e-9, 6) END AS solve_rate FROM g
  JOIN u USING (nhash)""",
    "canonical_summary": f"""SELECT count(*) AS questions, sum(CASE WHEN n > 1 THEN 1 ELSE 0 END)::BIGINT AS merged, sum(n - 1)::BIGINT AS reprints
  FROM (SELECT canonical_id, count(*) AS n FROM {_MAP} GROUP BY 1)""",
    "longest_text": "SELECT conv_id, role, arg_max(text, struct_pack(l := length(" + _stripped("text") + "), i := -turn)) AS longest FROM conversations GROUP BY conv_id, role",
    "ordered_union": """SELECT l_orderkey, string_agg(CAST(l_suppkey AS VARCHAR), ',' ORDER BY first) AS suppliers FROM (SELECT l_orderkey,
  l_suppkey, min(struct_pack(n := l_linenumber, s := l_suppkey)) AS first FROM lineitem GROUP BY 1, 2) GROUP BY 1""",
    "pooled_rate": """SELECT l_orderkey, round(total + 1e-9, 6) AS total_teams, CASE WHEN total <> 0 THEN round(answers / total + 1e-9,
  6) END AS solve_rate FROM (SELECT l_orderkey,
  sum(CASE WHEN l_discount = 0 THEN 0.0 ELSE l_quantity / (l_discount * 100 / 100) END) AS total,
  sum(l_quantity) AS answers FROM lineitem GROUP BY 1)""",
    "paired_truncate": """SELECT user_id, count(*) AS pairs, round(sum(coalesce(value, 0)) + 1e-9, 6) AS total,
  string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY event_id) AS events FROM (SELECT *,
  row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS r FROM events) WHERE r <= 3 GROUP BY user_id""",
    "note_split": f"SELECT page_id, array_to_string(regexp_extract_all(html, '{_NOTE}'), chr(10)) AS notes, CASE WHEN regexp_matches(html, '{_NOTE}') THEN " + _stripped(_tidy(rf"regexp_replace(regexp_replace(regexp_replace(html, '{_NOTE}', '', 'g'), '[ \t]+', ' ', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g')")) + " ELSE html END AS rest FROM pages",
    "kind_detect": r"""SELECT conv_id, turn, CASE lower(regexp_extract(text, '(?:^|\n)\s*(?:\[[^\]]*\]\s*)*(Of|The)\b',
  1)) WHEN '' THEN 'normal' WHEN 'of' THEN 'blitz' ELSE 'duplet' END AS kind FROM conversations""",
    "link_extract": """SELECT p.page_id, coalesce(links, '') AS links, coalesce(n, 0) AS n FROM pages p LEFT JOIN (SELECT page_id,
  string_agg(l, ' ' ORDER BY first) AS links, count(*) AS n FROM (SELECT page_id, l, min(i) AS first
  FROM (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS l,
  generate_subscripts(regexp_extract_all(html, 'href="([^"]*)"', 1), 1) AS i FROM pages) GROUP BY 1, 2)
  GROUP BY 1) x ON p.page_id = x.page_id""",
    "payload_extract": f"SELECT event_id, {_K} AS k, CASE WHEN {_K} IS NULL OR {_K} = 0 THEN 0 ELSE 1 END::BIGINT AS flag FROM events",
    "script_extract": r"SELECT page_id, CAST(regexp_extract(html, 'track\((\d+)\)', 1) AS BIGINT) AS tracked FROM pages",
    "upsert_latest": """WITH n AS (SELECT user_id, max(event_id) AS event_id FROM events WHERE event_id % 2 = 1 GROUP BY 1),
  o AS (SELECT user_id, min(event_id) AS event_id FROM events WHERE event_id % 2 = 0 GROUP BY 1), w AS (SELECT * FROM n
  UNION ALL SELECT * FROM o WHERE user_id NOT IN (SELECT user_id FROM n)) SELECT e.user_id, e.event_id, e.event_type,
  round(e.value + 1e-9, 6) AS value FROM events e JOIN w ON e.event_id = w.event_id""",
    "outcome_classify": f"SELECT user_id, outcome FROM {_OUTCOMES}",
    "outcome_counts": f"""SELECT outcome, count(*) AS n, sum(q)::BIGINT AS n_questions FROM (SELECT outcome, CASE WHEN outcome IN ('new',
  'updated') THEN questions ELSE 0 END AS q FROM {_OUTCOMES} UNION ALL SELECT 'unchanged', 0 FROM {_OUTCOMES}
  WHERE outcome = 'recovered') GROUP BY outcome""",
    "settled_filter": """SELECT id, status, played_at_start FROM (SELECT o_orderkey AS id,
  CASE o_orderstatus WHEN 'F' THEN 'ok' WHEN 'O' THEN 'empty' ELSE 'http_error' END AS status,
  CASE WHEN o_orderkey % 10 <> 0 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') END AS played_at_start FROM orders)
  WHERE status IN ('ok', 'empty') AND coalesce(played_at_start, '') < '1997-01-01'""",
    "pending_anti": "SELECT doc_id AS id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "usable_join": """SELECT d.doc_id AS id, lang, n_chars, CASE WHEN toxic = 1 THEN 'adapted' ELSE 'translated' END AS translation_status
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE quality <> 0""",
    "title_join": "SELECT o_orderkey AS question_id, c_name AS package_title FROM orders JOIN customer ON o_custkey = c_custkey",
    "stale_prune": """SELECT d.doc_id AS question_id, CASE WHEN d.doc_id % 3 = 0 THEN 'pruned' ELSE 'kept' END AS fate FROM documents d
  JOIN labels l ON d.doc_id = l.doc_id""",
    "sample_hash": f"SELECT doc_id FROM documents ORDER BY sha256(CAST(doc_id AS VARCHAR) || '|7'), doc_id LIMIT {LIMIT}",
    "status_counts": "SELECT event_type AS status, count(*) AS n FROM events GROUP BY 1",
    "usage_totals": f"""SELECT count(*) AS n, count(*) AS api_requests, sum({_K} * 10)::BIGINT AS input_tokens,
  sum({_K})::BIGINT AS cached_input_tokens, sum({_K} % 3)::BIGINT AS cache_write_input_tokens,
  sum({_K} * 2)::BIGINT AS output_tokens, sum({_K})::BIGINT AS reasoning_output_tokens FROM events""",
    "usage_cost": """SELECT l_orderkey, l_linenumber, round((greatest(l_quantity * 1000 - l_extendedprice - l_discount * 100000,
  0) * 0.20 + l_extendedprice * 0.02 + l_discount * 100000 * 0.25 + l_tax * 100000 * 1.20) / 1000000 + 1e-9, 6) AS usd
  FROM lineitem""",
    "corpus_funnel": f"""WITH c AS (SELECT min(doc_id) AS id FROM documents GROUP BY {_NHASH}) SELECT (SELECT count(*)
  FROM documents) AS questions, (SELECT count(*) FROM documents WHERE ({_REASON}) IS NULL) AS clean, (SELECT count(*)
  FROM c) AS canonical, (SELECT count(*) FROM c JOIN labels ON id = doc_id WHERE quality = 1) AS translated,
  (SELECT count(*) FROM c WHERE id NOT IN (SELECT doc_id FROM labels)) AS awaiting""",
    "review_rounds": """SELECT conv_id, coalesce(min(turn) FILTER (length(text) > 300), max(turn)) AS last_turn,
  count(*) FILTER (length(text) > 300) > 0 AS accepted FROM conversations WHERE role = 'assistant' GROUP BY conv_id""",
    "durations": """SELECT o_orderkey, CASE WHEN s >= 3600 THEN printf('%dh%02dm', s // 3600,
  s % 3600 // 60) WHEN s >= 60 THEN printf('%dm%02ds', s // 60, s % 60) ELSE printf('%ds', s) END AS shown
  FROM (SELECT o_orderkey, greatest(o_orderkey * 7 - 20, 0) AS s FROM orders)""",
    "index_urls": """SELECT page_id, 'https://site.example' ||
  CASE WHEN page_id = 0 THEN '' ELSE '/?page=' || CAST(page_id + 1 AS VARCHAR) END AS url FROM pages""",
} | stage_queries.ORACLE_SQL | source_queries.ORACLE_SQL
