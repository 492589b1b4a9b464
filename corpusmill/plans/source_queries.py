"""Registered queries of the site source, the answer sink, bucketed upserts and incremental canonicalisation, with SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyarrow import dataset, fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators import merge, review
from ..schemas import QUESTIONS, USAGE
from ..sources import answers, fetch, pages, site
from ..sources.buckets import BucketTable
from ..sources.warehouse import Warehouse
from ..staging import shared_folder, staged
from . import build, stage_queries
from .stage_queries import Scripted, _json_string, _table

#: Packages that a page of the index lists.
LISTED = 50


class TableSite:
    """A site of which the packages are the numbers in a Parquet file's column ``c_custkey``; every tenth refuses."""

    def __init__(self, table: str):
        files, path = fs.FileSystem.from_uri(table)
        ids = dataset.dataset(path, format="parquet", filesystem=files).to_table(columns=["c_custkey"]).column(0).to_pylist()
        self.ids = sorted(ids, reverse=True)
        self.index = {fetch.index_url(k + 1): self.ids[k * LISTED : (k + 1) * LISTED] for k in range(len(ids) // LISTED + 2)}

    def get(self, url: str) -> str:
        if url in self.index:
            return "<!-- <a href='/pack/0'> -->" + "".join(f'<a class="p" href="/pack/{i}?x">{i}</a>' for i in self.index[url])
        ident = int(url.rsplit("/", 1)[1])
        if ident % 10 == 4:
            raise OSError("refused")
        return f"<p>package {ident}</p>"


def site_crawl(spark: SparkSession, sf: str) -> DataFrame:
    """Packages that a walk through the index of a site of customers finds, every seventh one being settled, and their pages."""
    spark.dataSource.register(site.PackageSite)
    settled = staged(_table(spark, sf, "customer").filter("c_custkey % 7 = 0").select(F.col("c_custkey").alias("id")), "settled")
    options = {"fetcher": "corpusmill.plans.source_queries:TableSite", "argument": f"{sf}/customer.parquet", "settled": settled._staged_path}
    found = spark.read.format(site.NAME).options(**options).load()
    return found.select("id", "position", F.length("html").cast("long").alias("n_chars"), "error")


def index_links(spark: SparkSession, sf: str) -> DataFrame:
    """Packages linked from index pages that are made of an order's lines, among links that are none."""
    part = F.col("l_partkey").cast("string")
    forms = [("<a href='/pack/", "'>"), ('<A class="b" HREF = "/pack/', '/"> '), ('<a href="/pack/', '?a#b">'), ('<a href="/packs/', '">'), ('<a data-href="/pack/', '">'), ("<!-- <a href='/pack/", "'> -->"), ('<a href="/pack/', 'x">')]
    link = F.element_at(F.array(*[F.concat(F.lit(a), part, F.lit(b)) for a, b in forms]), F.col("l_linenumber"))
    lines = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", link.alias("link"))))
    shown = _table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.concat_ws(" ", F.transform(lines, lambda x: x["link"])).alias("html"))
    return pages.package_links(shown).select("l_orderkey", F.col("position").cast("long").alias("position"), "id")


def malformed_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Parse errors of pages that JSON allows and little else: deep nests, endless numbers, half a surrogate pair."""
    key = F.col("c_custkey")
    question = lambda more: F.concat(F.lit('1:{"pack":{"id":'), key.cast("string"), F.lit(',"title":"t","tours":[{"questions":[{"id":1,'), more, F.lit("}]}]}}"))
    kinds = [
        question(F.concat(F.lit('"text":'), F.repeat(F.lit("["), 100_000))),
        question(F.concat(F.lit('"number":"'), F.repeat(F.lit("9"), 5_000), F.lit('"'))),
        question(F.lit('"text":"cut \\ud83d"')),
        question(F.lit('"text":"whole \\ud83d\\ude00","number":"12"')),
    ]
    stream = F.element_at(F.array(*kinds), (F.floor(key / 50) % 4 + 1).cast("int"))
    html = F.concat(F.lit("<script>self.__next_f.push([1,"), _json_string(stream), F.lit("])</script>"))
    made = _table(spark, sf, "customer").filter("c_custkey % 50 = 0").select(key.alias("id"), html.alias("html"))
    return pages.parse(made).select("id", "parse_error", F.size("questions").cast("long").alias("n_questions"))


def answer_sink(spark: SparkSession, sf: str) -> DataFrame:
    """The scripted reviews of all conversations, each call remembered, each answer a record of the sink, written twice."""
    spark.dataSource.register(answers.ReviewAnswers)
    house = Warehouse(spark, f"{shared_folder(spark)}/corpusmill/house-{uuid.uuid4().hex}")
    sources = _table(spark, sf, "conversations").select(F.col("conv_id").alias("question_id")).distinct()
    sources = sources.select("question_id", *[F.lit("x").alias(c) for c in review.SOURCE[1:]])
    calls, folder = house.uri(house.work()), house.uri(house.work())
    for _ in range(2):  # the second time every answer is remembered
        done = review.run_reviews(sources, Scripted, concurrency=50, partitions=8, calls=calls)
        done.write.format(answers.NAME).mode("append").save(folder)
    found = spark.read.schema(review.RESULT).parquet(folder)
    return found.select("question_id", "status", "question_en", "editor_status", "translation_attempts", *USAGE[:2], "failure")


def bucket_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Users' last even events, stored in buckets, after an upsert of their last odd ones and the removal of every ninth user."""
    events = _table(spark, sf, "events")
    schema = events.select(F.col("user_id").cast("long").alias("id"), F.col("event_id").cast("long").alias("event_id"), "event_type").schema
    last = [
        merge.last_rows(events.filter(F.col("event_id") % 2 == odd).withColumn("id", F.col("user_id").cast("long")), "id", ["event_id"], schema.fieldNames())
        for odd in (0, 1)
    ]
    folder = Warehouse(spark, f"{shared_folder(spark)}/corpusmill/house-{uuid.uuid4().hex}").uri(f"{shared_folder(spark)}/corpusmill/buckets-{uuid.uuid4().hex}")
    table = BucketTable(spark, folder, schema, "id", []).upsert(last[0])
    gone = events.select(F.col("user_id").alias("id")).filter("id % 9 = 0").distinct()
    return table.upsert(last[1].filter("id % 9 <> 0"), gone).read()


def catch_up(spark: SparkSession, sf: str) -> DataFrame:
    """Canonical records of the documents, taken as questions, built from two thirds, then brought up to date with the last third and some exchanged answers."""
    house = Warehouse(spark, f"{shared_folder(spark)}/corpusmill/house-{uuid.uuid4().hex}")
    d = _table(spark, sf, "documents")
    blank = {f.name: F.lit(None).cast(f.dataType) for f in QUESTIONS.fields}
    key = F.col("doc_id")
    rows = d.filter("doc_id is not null").select(
        *[c.alias(name) for name, c in (blank | {
            "id": key, "package_id": key % 5, "question": F.concat(F.lit("x" * text.MIN_QUESTION_LENGTH + " "), text.native_key(F.col("text"))),
            "answer": F.when(key % 10 != 1, F.concat(F.col("lang"), F.repeat(F.lit("!"), (key % 6).cast("int")))).otherwise(""),
            **{c: F.lit("") for c in ("explanation", "acceptance_criteria", "handout_text", "source_references")},
            "tournament_ids": F.array(key % 3), "solve_percentages": F.array(F.lit(50.0)), "correct_answers": F.array(key % 11),
        }).items()]
    ).dropDuplicates(["id"])
    changed = rows.filter("id % 3 = 2 or id % 17 = 0").withColumn("answer", F.when(F.col("id") % 17 == 0, "now").otherwise(F.col("answer")))
    for batch in (rows.filter("id % 3 <> 2"), changed):
        stored = staged(batch, "questions")
        house.point({"questions": house.upsert("questions", stored), "question_changes": house.upsert("question_changes", stored.select("id").toDF("question_id"))})
        build.catch_up(house).collect()
    right = F.aggregate("correct_answers", F.lit(0).cast("long"), lambda n, x: n + x)
    return house.read("questions_canonical").select("id", "answer", "printings", F.col("playings").cast("long").alias("playings"), right.alias("correct"), F.array_join(F.transform("correct_answers", lambda x: x.cast("string")), ",").alias("in_order"))


Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {f.__name__: f for f in (site_crawl, index_links, malformed_pages, answer_sink, bucket_upsert, catch_up)}

_KEY = "trim(regexp_replace(regexp_replace(replace(replace(lower(coalesce(text, '')), 'ß', 'ss'), 'ё', 'е'), '[^\\p{L}\\p{N}_\\s]', ' ', 'g'), '\\s+', ' ', 'g'))"

ORACLE_SQL: dict[str, str] = {
    "answer_sink": f"SELECT question_id, status, question_en, editor_status, translation_attempts, {', '.join(USAGE[:2])}, failure FROM ({stage_queries.ORACLE_SQL['review_fold']})",
    "site_crawl": """SELECT c_custkey AS id, row_number() OVER (ORDER BY c_custkey DESC) - 1 AS position,
  CASE WHEN c_custkey % 10 <> 4 THEN 15 + length(CAST(c_custkey AS VARCHAR)) END::BIGINT AS n_chars,
  CASE WHEN c_custkey % 10 = 4 THEN 'refused' END AS error FROM customer WHERE c_custkey % 7 <> 0""",
    "index_links": """SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY n, id) - 1 AS position, id
  FROM (SELECT l_orderkey, l_partkey AS id, min(l_linenumber) AS n FROM lineitem WHERE l_linenumber <= 3 GROUP BY ALL)""",
    "malformed_pages": """SELECT c_custkey AS id, CASE c_custkey // 50 % 4 WHEN 0 THEN 'the payload is nested too deeply'
  WHEN 1 THEN 'the payload is malformed: a number of too many digits' WHEN 2 THEN 'the payload has half a surrogate pair' END AS parse_error,
  CASE WHEN c_custkey // 50 % 4 = 3 THEN 1 ELSE 0 END::BIGINT AS n_questions FROM customer WHERE c_custkey % 50 = 0""",
    "bucket_upsert": """SELECT user_id::BIGINT AS id, max(event_id)::BIGINT AS event_id, arg_max(event_type, event_id) AS event_type
  FROM events e WHERE user_id % 9 <> 0 AND (event_id % 2 = 1 OR NOT EXISTS (SELECT 1 FROM events o WHERE o.user_id = e.user_id AND o.event_id % 2 = 1)) GROUP BY user_id""",
    "catch_up": f"""WITH q AS (SELECT doc_id, {_KEY} AS k, CASE WHEN doc_id % 17 = 0 THEN 'now' WHEN doc_id % 10 <> 1 THEN lang || repeat('!', (doc_id % 6)::INT) ELSE '' END AS a FROM documents)
SELECT min(doc_id) AS id, arg_max(a, struct_pack(l := length(a), i := -doc_id)) AS answer, count(*) AS printings, count(*) AS playings, sum(doc_id % 11)::BIGINT AS correct,
  string_agg(CAST(doc_id % 11 AS VARCHAR), ',' ORDER BY doc_id) AS in_order FROM q WHERE a <> '' GROUP BY k""",
}
