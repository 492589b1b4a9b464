"""Registered queries that run whole stages on rows made of the shared tables: page parsing, the package merge, the
review fold with scripted rounds, invariants, and the exported texts. Each has SQL that states the result directly.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text, values
from ..operators import funnel, merge, review
from ..schemas import ENGLISH, PACKAGES, USAGE
from ..sources import pages
from ..sources.warehouse import Warehouse
from ..staging import Scratch, shared_folder
from . import build

#: Spellings of the site's markers, as rows get them.
NOTE, BLITZ = "[Ведущему: тихо]", "Блиц."
#: What makes a question long enough to be one.
WHY = " to a customer who had ordered it long before"


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _json_string(c: Column) -> Column:
    """The text as a JSON string, quotes included."""
    listed = F.to_json(F.array(c))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def _pages(spark: SparkSession, sf: str) -> DataFrame:
    """A page for each order: its lines are the questions. Orders whose id ends in 3 declare one too many, in 4 have no payload."""
    c = F.col
    number = c("l_linenumber")
    question = F.struct(
        (c("l_orderkey") * 10 + number).alias("id"),
        number.alias("number"),
        F.when(number == 5, "").otherwise(F.concat(F.when(number == 1, BLITZ + "\n").otherwise(""), F.when(number == 2, NOTE).otherwise(""), F.lit(" Part  "), c("l_partkey").cast("string"), F.lit("\r\nshipped\tby "), c("l_suppkey").cast("string"), F.lit(WHY))).alias("text"),
        c("l_returnflag").alias("answer"),
        F.concat(F.lit(" "), c("l_linestatus")).alias("zachet"),
        F.when(number == 3, " /img/1.png").when(number == 4, "../img/2.png").alias("razdatkaPic"),
        F.array(F.struct(c("l_suppkey").alias("id"), F.lit(" A  B ").alias("name"))).alias("authors"),
        F.array(F.struct((c("l_partkey") % 5).alias("id"))).alias("tournaments"),
        F.lit(" book ").alias("source"),
        (number % 2 == 0).alias("takenDown"),
        F.array(c("l_quantity")).alias("complexity"),
        F.array(c("l_linenumber").cast("long")).alias("correct_answers"),
    )
    packs = _table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(question)).alias("questions"))
    declared = F.size("questions") + F.when(c("l_orderkey") % 10 == 3, 1).otherwise(0)
    pack = F.struct(
        c("l_orderkey").alias("id"), F.lit(" ").alias("title"),
        F.concat(F.lit("Order  "), c("l_orderkey").cast("string")).alias("longTitle"),
        F.lit("2020-01-02").alias("startDate"), F.lit("").alias("endDate"), declared.alias("questions"),
        F.array(F.struct("questions")).alias("tours"),
    )
    # columns of their own, or else each use spells the page again
    packs = packs.select("l_orderkey", F.concat(F.lit("1:"), F.to_json(F.struct(pack.alias("pack")))).alias("stream"))
    packs = packs.select(
        "l_orderkey", _json_string(F.substring("stream", 1, 40)).alias("head"),
        F.to_json(F.array(F.substring("stream", 41, (1 << 31) - 1))).alias("rest"),
    )
    html = F.when(c("l_orderkey") % 10 == 4, "<html>nothing</html>").otherwise(
        F.concat(
            F.lit("<script>self.__next_f.push([1,"), c("head"), F.lit("])</script><p><script>self.__next_f.push([1,"),
            F.substring("rest", 2, (1 << 31) - 1), F.lit(")</script>"),
        )
    )
    return packs.select(c("l_orderkey").alias("id"), html.alias("html"))


def page_parse(spark: SparkSession, sf: str) -> DataFrame:
    """Package fields and errors of parsed pages."""
    p = pages.parse(_pages(spark, sf))
    ok = F.col("parse_error").isNull()
    return p.select(
        "id", "parse_error", F.when(ok, F.col("package.title")).alias("title"),
        F.when(ok, F.col("package.played_at_start")).alias("played"),
        F.when(ok, F.size("questions")).cast("long").alias("n_questions"),
    )


def question_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Typed rows of the questions of parsed pages."""
    parsed = pages.parse(_pages(spark, sf)).filter("parse_error is null")
    q = pages.question_rows(parsed)
    media = F.array_join(F.transform("media_urls", lambda m: F.concat_ws("=", m["role"], m["url"])), " ")
    return q.select(
        "id", "package_id", F.col("question_number").cast("long").alias("question_number"), "question", "answer",
        "acceptance_criteria", "host_note", "kind", media.alias("media"),
        F.col("has_media").cast("long").alias("has_media"), F.col("taken_down").cast("long").alias("taken_down"),
        F.element_at("author_ids", 1).alias("author_id"), F.element_at("author_names", 1).alias("author"),
        F.element_at("tournament_ids", 1).alias("tournament_id"), "source_references",
        F.element_at("solve_percentages", 1).alias("percentage"), F.element_at("correct_answers", 1).alias("correct"),
        "content_hash",
    )


def package_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Stored packages (from even events) after the outcomes of a fetch (the last odd event of each user)."""
    e = _table(spark, sf, "events")
    c, n = F.col, F.col("event_id")
    text_ = lambda x: x.cast("string")

    def rows(df: DataFrame, **own: Column) -> DataFrame:
        blank = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in PACKAGES.fields}
        return df.select(
            *[own.get(name, col).alias(name) for name, col in blank.items()],
            *[col.alias(k) for k, col in own.items() if k not in blank],
        )

    stored = e.filter("event_id % 2 = 0 and user_id % 4 <> 1").groupBy("user_id").agg(F.max("event_id").alias("event_id"))
    stored = rows(
        stored, id=c("user_id"), title=F.concat(F.lit("old "), text_(n)), url=F.concat(F.lit("u"), text_(n)),
        status=F.when(n % 3 == 0, "parse_error").otherwise("ok"), http_status=F.lit(200),
        page_hash=F.concat(F.lit("h"), text_(n)), questions_found=(n % 7).cast("int"),
        first_seen_at=F.timestamp_seconds(n), fetched_at=F.timestamp_seconds(n), error=F.lit(""),
    )
    batch = e.filter("event_id % 2 = 1").groupBy("user_id").agg(F.max("event_id").alias("event_id"))
    outcome = F.element_at(
        F.array(*map(F.lit, ("new", "updated", "unchanged", "recovered", "fetch_error", "parse_error", "empty"))),
        (n % 7 + 1).cast("int"),
    )
    status = F.when(outcome == "fetch_error", "http_error").when(outcome.isin("parse_error", "empty"), outcome).otherwise("ok")
    batch = rows(
        batch, id=c("user_id"), title=F.concat(F.lit("new "), text_(n)), url=F.concat(F.lit("v"), text_(n)),
        status=status, http_status=F.lit(200), page_hash=F.concat(F.lit("g"), text_(n)),
        questions_found=(n % 5).cast("int"), first_seen_at=F.timestamp_seconds(n), fetched_at=F.timestamp_seconds(n),
        error=F.when(status == "ok", "").otherwise("why"), outcome=outcome,
    )
    merged = merge.merge_packages(stored, batch)
    seconds = lambda x: F.unix_timestamp(x).alias(x)
    return merged.select(
        "id", "title", "url", "status", F.col("http_status").cast("long").alias("http_status"), "page_hash",
        F.col("questions_found").cast("long").alias("questions_found"), seconds("first_seen_at"),
        seconds("fetched_at"), "error",
    )


class Scripted:
    """A client whose answers follow from the record's number: accepted in turn id % 5 + 1 (the fourth and fifth never come), given up
    if id % 3 = 0, edited if id % 4 = 0 and sent back if id % 4 = 1; every seventh record is out of its reach."""

    def __init__(self) -> None:
        self.turn: dict[int, int] = {}

    async def propose(self, source: dict, previous: dict | None, feedback: dict | None) -> tuple[dict, dict]:
        ident = source["question_id"]
        if ident % 7 == 6:
            raise RuntimeError("out of reach")
        self.turn[ident] = self.turn.get(ident, 0) + 1
        given_up = ident % 3 == 0
        fields = dict.fromkeys(ENGLISH, "" if given_up else f"turn {self.turn[ident]}")
        return fields | {
            "status": "untranslatable" if given_up else "translated", "changes_description": "none",
            "untranslatable_reason": "a pun" if given_up else "",
        }, {"requests": 1, "input_tokens": 100, "output_tokens": 40}

    async def critique(self, source: dict, candidate: dict) -> tuple[dict, dict]:
        ident = source["question_id"]
        status = "untranslatable" if ident % 3 == 0 else "adapted"
        accepts = self.turn[ident] > ident % 5
        return {
            "decision": "accept" if accepts else "revise", "accepted_status": status, "summary": "no way",
            "issues": [], "revision_instructions": "again",
        }, {"requests": 1, "input_tokens": 80, "output_tokens": 20}

    async def edit(self, source: dict, candidate: dict) -> tuple[dict, dict]:
        kind = source["question_id"] % 4
        own = {f: candidate[f] + (" polished" if kind == 0 else "") for f in ENGLISH}
        return own | {
            "decision": "needs_rework" if kind == 1 else "edited", "edit_summary": "", "needs_rework_reason": "",
        }, {"requests": 1, "input_tokens": 60, "output_tokens": 10}


def _reviews(spark: SparkSession, sf: str) -> DataFrame:
    sources = _table(spark, sf, "conversations").select(F.col("conv_id").alias("question_id")).distinct()
    sources = sources.select("question_id", *[F.lit("x").alias(c) for c in review.SOURCE[1:]])
    return review.run_reviews(sources, Scripted, concurrency=50, partitions=8)


def review_fold(spark: SparkSession, sf: str) -> DataFrame:
    """What the fold makes of scripted rounds for every conversation."""
    return _reviews(spark, sf).select(
        "question_id", "status", "question_en", "changes_description", "untranslatable_reason", "editor_status",
        "translation_attempts", "editor_attempts", *USAGE[:2], "output_tokens", "failure",
    )


def run_report(spark: SparkSession, sf: str) -> DataFrame:
    return review.run_report(_reviews(spark, sf)).select("selected", "completed", "errors", *USAGE[:2], "output_tokens")


def violations(spark: SparkSession, sf: str) -> DataFrame:
    """Invariants that documents, taken as questions with some faults, violate."""
    d = _table(spark, sf, "documents").select(F.col("doc_id").alias("id"))
    n = F.col("id")
    clean = d.filter("id % 10 <> 1")
    tables = {
        "packages": d.select((n % 5).alias("id")).distinct().filter("id <> 4"),
        "questions": d.select("id", (n % 5).alias("package_id")),
        "question_exclusions": d.filter("id % 10 = 1").select(F.when(n % 100 == 1, -n).otherwise(n).alias("question_id")),
        "questions_canonical": clean.filter("id % 3 = 0").select("id", F.lit(3).cast("long").alias("printings"), F.concat(F.lit("h"), n.cast("string")).alias("content_hash")),
        "question_printings": clean.select(n.alias("question_id"), (n - n % 3).alias("canonical_id")),
        "translations": clean.filter("id % 6 = 0").select(n.alias("question_id"), F.concat(F.when(n % 12 == 0, "h").otherwise("old"), n.cast("string")).alias("content_hash"), F.when(n % 18 == 0, "odd").otherwise("translated").alias("status"), F.lit("skipped").alias("editor_status")),
    }
    return funnel.violations(tables)


def exported_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Arrays as JSON text, spaced as records export them and compact as pages are stored."""
    o = _table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.col("l_linenumber").cast("long"))).alias("a"))
    return o.select("l_orderkey", values.spaced_json(F.col("a")).alias("spaced"), values.compact_json(F.col("a")).alias("compact"))


def media_links(spark: SparkSession, sf: str) -> DataFrame:
    """Absolute links of the pages' relative ones."""
    c = F.col("page_id")
    url = F.element_at(
        F.array(
            F.concat(F.lit("/a/"), c.cast("string")), F.concat(F.lit("b/../"), c.cast("string"), F.lit("?q=/../x")),
            F.lit("//host/x"), F.col("url"), F.lit("a/./b/.."),
        ),
        (c % 5 + 1).cast("int"),
    )
    return _table(spark, sf, "pages").select("page_id", values.absolute_url("https://site.example", url).alias("link"))


def build_run(spark: SparkSession, sf: str) -> DataFrame:
    """The funnel of a warehouse after the pages are stored twice (the second time all are unchanged) and everything is rebuilt, and what was counted on the way."""
    house = Warehouse(spark, f"{shared_folder(spark)}/corpusmill/house-{uuid.uuid4().hex}")
    counts: dict[str, int] = {}
    with Scratch("site") as stage:
        found = stage(_pages(spark, sf).select("id", F.col("id").alias("position"), "html", F.when(F.col("id") % 10 == 5, "refused").alias("error")), "pages")
        for turn in ("first", "again"):
            for r in build.store_pages(house, found).collect():
                counts[f"{turn}_{r.outcome}"] = r.n
    summary = build.rebuild(house).first()
    names = ["first_new", "first_parse_error", "first_fetch_error", "again_unchanged", "again_parse_error", "again_fetch_error"]
    more = [F.lit(counts.get(n, 0)).cast("long").alias(n) for n in names] + [
        F.lit(summary[n]).cast("long").alias(n) for n in ("merged", "reprints", "dropped")
    ]
    broken = funnel.violations(house.tables()).agg(F.count("*").alias("violations"))
    return build.corpus_funnel(house).join(broken).select("*", *more)  # one row each


def target_selection(spark: SparkSession, sf: str) -> DataFrame:
    """Users with events whose package, made of their orders, is not settled."""
    o = _table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("id")).agg(
        F.max("o_orderdate").alias("d"), F.min("o_orderstatus").alias("s"),
    )
    packs = o.select(
        "id",
        F.when(F.col("s") == "F", "ok").when(F.col("s") == "O", "empty").otherwise("http_error").alias("status"),
        F.date_format("d", "yyyy-MM-dd").alias("played_at_start"),
    )
    discovered = _table(spark, sf, "events").select(F.col("user_id").alias("id")).distinct()
    return merge.targets(discovered, merge.settled(packs, F.to_date(F.lit("1998-06-01")), 300))


def random_draw(spark: SparkSession, sf: str) -> DataFrame:
    """A draw of pending records: how many, how many different, how many of them known and untranslated."""
    o = _table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("package_id"),
        *[F.lit("").alias(c) for c in ("content_hash", *text.CONTENT_FIELDS)],
    )
    done = o.filter("id % 3 = 0").select(F.col("id").alias("question_id"))
    titles = _table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("title"))
    drawn = review.pending_inputs(o, done, titles, 100, seed=3)
    return drawn.agg(
        F.count("*").alias("n"), F.countDistinct("question_id").alias("different"),
        F.count(
            F.when((F.col("question_id") % 3 != 0) & F.col("package_title").startswith("Customer"), 1)
        ).alias("pending"),
    )


def prompts(spark: SparkSession, sf: str) -> DataFrame:
    """The task that a record's prompt carries, and what is wrong with a candidate made of it by its form alone."""
    d = _table(spark, sf, "conversations")

    def of(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for r in rows:
            sources = [dict.fromkeys(review.SOURCE, "") | {"question": f"q{c}", "answer": t[:10], "package_title": "p"} for c, t in zip(r["conv_id"], r["text"])]
            forms = [
                dict.fromkeys(ENGLISH, "x") | {
                    "answer_en": " " if n % 2 else "x", "status": "untranslatable" if n % 3 == 0 else "adapted",
                    "changes_description": "" if n % 5 == 0 else "c", "untranslatable_reason": "" if n % 2 else "r",
                } for n in r["turn"]
            ]
            yield pd.DataFrame({"conv_id": r["conv_id"], "turn": r["turn"], "task": [review.prompt(s) for s in sources], "issues": ["; ".join(review.local_issues(f)) for f in forms]})

    return d.select(
        "conv_id", "turn", F.regexp_replace("text", r"[^A-Za-z ]", "").alias("text"),
    ).mapInPandas(of, "conv_id long, turn long, task string, issues string")


Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {
    f.__name__: f for f in (
        build_run, target_selection, random_draw, prompts, page_parse, question_rows, package_merge, review_fold,
        run_report, violations, exported_texts, media_links,
    )
}

_FOLD = """(SELECT question_id, question_id % 7 = 6 AS fails, question_id % 3 = 0 AS lost, least(question_id % 5 + 1, 3) AS turns, question_id % 5 < 3 AS accepted, question_id % 4 AS edit FROM (SELECT DISTINCT conv_id AS question_id FROM conversations))"""
_USAGE = "2 * turns + CASE WHEN lost THEN 0 ELSE 1 END AS api_requests, 180 * turns + CASE WHEN lost THEN 0 ELSE 60 END AS input_tokens, 60 * turns + CASE WHEN lost THEN 0 ELSE 10 END AS output_tokens"
_QUESTION = "CASE WHEN l_linenumber = 1 THEN 'Блиц.' || chr(10) ELSE '' END || CASE WHEN l_linenumber = 5 THEN '[Media question; see media URLs]' ELSE 'Part ' || l_partkey || chr(10) || 'shipped by ' || l_suppkey || '" + WHY + "' END"

ORACLE_SQL: dict[str, str] = {
    "page_parse": """SELECT l_orderkey AS id,
  CASE l_orderkey % 10 WHEN 4 THEN 'no embedded chunks' WHEN 3 THEN 'declared ' || (count(*) + 1) || ' questions, parsed ' || count(*) END AS parse_error,
CASE WHEN l_orderkey % 10 NOT IN (3, 4) THEN 'Order ' || l_orderkey END AS title, CASE WHEN l_orderkey % 10 NOT IN (3,
  4) THEN '2020-01-02' END AS played, CASE WHEN l_orderkey % 10 NOT IN (3, 4) THEN count(*) END AS n_questions
  FROM lineitem GROUP BY l_orderkey""",
    "question_rows": f"""SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS package_id, l_linenumber::BIGINT AS question_number,
  q AS question, l_returnflag AS answer, l_linestatus AS acceptance_criteria,
CASE WHEN l_linenumber = 2 THEN '{NOTE}' ELSE '' END AS host_note, CASE WHEN l_linenumber = 1 THEN 'blitz' ELSE 'normal' END AS kind,
CASE l_linenumber WHEN 3 THEN 'handout={pages.BASE_URL}/img/1.png' WHEN 4 THEN 'handout={pages.BASE_URL}/img/2.png' ELSE '' END AS media,
  CASE WHEN l_linenumber IN (3, 4) THEN 1 ELSE 0 END::BIGINT AS has_media,
  CASE WHEN l_linenumber % 2 = 0 THEN 1 ELSE 0 END::BIGINT AS taken_down,
l_suppkey AS author_id, 'A B' AS author, l_partkey % 5 AS tournament_id, 'book' AS source_references,
  l_quantity AS percentage, l_linenumber::BIGINT AS correct,
substr(sha256(q || chr(0) || l_returnflag || chr(0) || '' || chr(0) || l_linestatus || chr(0) || ''), 1, 16) AS content_hash
FROM (SELECT *, {_QUESTION} AS q FROM lineitem) WHERE l_orderkey % 10 NOT IN (3, 4)""",
    "package_merge": """WITH o AS (SELECT user_id AS id, max(event_id) AS n FROM events WHERE event_id % 2 = 0 AND user_id % 4 <> 1 GROUP BY 1),
b AS (SELECT user_id AS id, max(event_id) AS m, max(event_id) % 7 AS k FROM events WHERE event_id % 2 = 1 GROUP BY 1),
j AS (SELECT coalesce(o.id, b.id) AS id, n, m, k, k IN (4, 5, 6) AS failed, k = 3 AS recovered,
  m IS NULL OR k = 2 AS same,
  CASE k WHEN 4 THEN 'http_error' WHEN 5 THEN 'parse_error' WHEN 6 THEN 'empty' ELSE 'ok' END AS s FROM o FULL
  JOIN b ON o.id = b.id)
SELECT id, CASE WHEN same OR recovered OR failed AND n IS NOT NULL THEN 'old ' || n ELSE 'new ' || m END AS title,
  CASE WHEN n IS NOT NULL THEN 'u' || n WHEN NOT same AND NOT recovered THEN 'v' || m WHEN recovered THEN 'v' || m END AS url,
CASE WHEN same THEN CASE WHEN n % 3 = 0 THEN 'parse_error' WHEN n IS NOT NULL THEN 'ok' END WHEN recovered THEN 'ok' ELSE s END AS status,
CASE WHEN same AND n IS NULL THEN NULL ELSE 200 END::BIGINT AS http_status,
CASE WHEN same OR recovered OR failed AND n IS NOT NULL THEN 'h' || n ELSE 'g' || m END AS page_hash,
  CASE WHEN same OR recovered OR failed AND n IS NOT NULL THEN n % 7 ELSE m % 5 END AS questions_found,
CASE WHEN n IS NOT NULL THEN n ELSE m END AS first_seen_at, CASE WHEN same THEN n ELSE m END AS fetched_at,
  CASE WHEN same AND n IS NULL THEN NULL WHEN failed AND NOT same THEN 'why' ELSE '' END AS error
FROM j WHERE n IS NOT NULL OR k NOT IN (2, 3)""",
    "review_fold": f"""SELECT question_id, CASE WHEN fails THEN NULL WHEN lost THEN 'untranslatable' ELSE 'adapted' END AS status,
  CASE WHEN fails THEN NULL WHEN lost THEN '' ELSE 'turn ' || turns ||
  CASE WHEN edit = 0 THEN ' polished' ELSE '' END END AS question_en,
CASE WHEN fails THEN NULL WHEN lost AND NOT accepted THEN '{review.EXHAUSTED}' WHEN NOT lost AND edit = 0 THEN 'none{review.COPY_EDIT}{review.POLISHED}' ELSE 'none' END AS changes_description,
CASE WHEN fails THEN NULL WHEN NOT lost THEN '' WHEN accepted THEN 'a pun' ELSE 'no way' END AS untranslatable_reason,
  CASE WHEN fails THEN NULL WHEN lost THEN 'skipped' WHEN edit = 1 THEN 'needs_rework' WHEN edit = 0 THEN 'edited' ELSE 'unchanged' END AS editor_status,
CASE WHEN NOT fails THEN turns END AS translation_attempts, CASE WHEN NOT fails THEN
  CASE WHEN lost THEN 0 ELSE 1 END END::BIGINT AS editor_attempts,
  CASE WHEN NOT fails THEN api_requests END AS api_requests, CASE WHEN NOT fails THEN input_tokens END AS input_tokens,
  CASE WHEN NOT fails THEN output_tokens END AS output_tokens,
  CASE WHEN fails THEN 'RuntimeError: out of reach' END AS failure
FROM (SELECT *, {_USAGE} FROM {_FOLD})""",
    "run_report": f"""SELECT count(*) AS selected, count(*) FILTER (NOT fails) AS completed, count(*) FILTER (fails) AS errors,
  sum(api_requests) FILTER (NOT fails)::BIGINT AS api_requests,
  sum(input_tokens) FILTER (NOT fails)::BIGINT AS input_tokens,
  sum(output_tokens) FILTER (NOT fails)::BIGINT AS output_tokens FROM (SELECT *, {_USAGE} FROM {_FOLD})""",
    "violations": """WITH d AS (SELECT doc_id AS id FROM documents), k AS (SELECT id FROM d WHERE id % 10 <> 1 OR id % 100 = 1),
  p AS (SELECT id, id - id % 3 AS c FROM d WHERE id % 10 <> 1), c AS (SELECT id FROM d
  WHERE id % 10 <> 1 AND id % 3 = 0), t AS (SELECT id FROM c WHERE id % 6 = 0)
SELECT * FROM (
SELECT 'questions: no package' AS name, count(*) AS n FROM d WHERE id % 5 = 4
UNION ALL SELECT 'exclusions: no question', count(*) FROM d WHERE id % 100 = 1
UNION ALL SELECT 'clean rows without printing', count(*) FROM k WHERE id NOT IN (SELECT id FROM p)
UNION ALL SELECT 'printings without record', count(*) FROM p WHERE c NOT IN (SELECT id FROM c)
UNION ALL SELECT 'stale translations', count(*) FROM t WHERE id % 12 <> 0
UNION ALL SELECT 'translations: unknown status', count(*) FROM t WHERE id % 18 = 0
UNION ALL SELECT 'printings beyond the clean rows', CASE WHEN 3 * (SELECT count(*) FROM c) <> (SELECT count(*)
  FROM k) THEN 1 ELSE 0 END) WHERE n > 0""",
    "exported_texts": """SELECT l_orderkey, '[' || string_agg(CAST(l_linenumber AS VARCHAR), ', ' ORDER BY l_linenumber) || ']' AS spaced,
  '[' || string_agg(CAST(l_linenumber AS VARCHAR), ',' ORDER BY l_linenumber) || ']' AS compact FROM lineitem
  GROUP BY l_orderkey""",
    "media_links": """SELECT page_id,
  CASE page_id % 5 WHEN 0 THEN 'https://site.example/a/' || page_id WHEN 1 THEN 'https://site.example/' || page_id || '?q=/../x' WHEN 2 THEN 'https://host/x' WHEN 3 THEN url ELSE 'https://site.example/a/' END AS link
  FROM pages""",
    "build_run": """WITH q AS (SELECT *, l_linenumber = 1 AS blitz FROM lineitem WHERE l_orderkey % 10 NOT IN (3, 4, 5)
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_partkey || chr(13) || chr(10) || 'shipped' || chr(9) || 'by ' || l_suppkey || ' ' DESC) = 1),
   -- a page may repeat an id: its last one counts
 k AS (SELECT blitz, l_partkey, l_suppkey, count(*) AS n FROM q WHERE l_linenumber <> 5 GROUP BY ALL),
  o AS (SELECT DISTINCT l_orderkey FROM lineitem)
SELECT (SELECT count(*) FROM q) AS questions, (SELECT count(*) FROM q WHERE l_linenumber <> 5) AS clean,
  (SELECT count(*) FROM k) AS canonical, 0::BIGINT AS translated, (SELECT count(*) FROM k) AS awaiting,
  0::BIGINT AS violations,
(SELECT count(*) FROM o WHERE l_orderkey % 10 NOT IN (3, 4, 5)) AS first_new, (SELECT count(*) FROM o
  WHERE l_orderkey % 10 IN (3, 4)) AS first_parse_error, (SELECT count(*) FROM o
  WHERE l_orderkey % 10 = 5) AS first_fetch_error,
(SELECT count(*) FROM o WHERE l_orderkey % 10 NOT IN (3, 4, 5)) AS again_unchanged, (SELECT count(*) FROM o
  WHERE l_orderkey % 10 IN (3, 4)) AS again_parse_error, (SELECT count(*) FROM o
  WHERE l_orderkey % 10 = 5) AS again_fetch_error,
(SELECT count(*) FROM k WHERE n > 1) AS merged, (SELECT sum(n - 1) FROM k)::BIGINT AS reprints, 0::BIGINT AS dropped""",
    "target_selection": """SELECT DISTINCT user_id AS id FROM events WHERE user_id NOT IN (SELECT o_custkey FROM orders GROUP BY 1
  HAVING min(o_orderstatus) IN ('F', 'O') AND strftime(max(o_orderdate), '%Y-%m-%d') < '1997-08-05')""",
    "random_draw": """SELECT least(100, count(*)) AS n, least(100, count(*)) AS different, least(100, count(*)) AS pending FROM orders
  WHERE o_orderkey % 3 <> 0""",
    "prompts": """SELECT conv_id, turn, '{"question_ru": "q' || conv_id || '", "answer_ru": "' || left(regexp_replace(text, '[^A-Za-z ]',
  '', 'g'),
  10) || '", "explanation_ru": "", "acceptance_criteria_ru": "", "handout_text_ru": "", "package_title": "p"}' AS task,
CASE WHEN turn % 3 = 0 THEN
  CASE WHEN turn % 2 = 1 THEN 'untranslatable_reason is blank' ELSE '' END ELSE array_to_string(list_filter([CASE WHEN turn % 2 = 1 THEN 'answer_en is blank' END,
  CASE WHEN turn % 5 = 0 THEN 'changes_description is blank' END], lambda x: x IS NOT NULL), '; ') END AS issues
  FROM conversations""",
}
