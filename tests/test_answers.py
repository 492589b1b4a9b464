import asyncio
import json

import pytest
from corpusmill.operators import review
from corpusmill.plans import translate
from corpusmill.sources import answers
from corpusmill.sources.site import Store
from corpusmill.sources.warehouse import Warehouse
from fake_client import Logged
from pyspark.sql import functions as F
from test_review import SOURCE, tables

ROLES = ["propose1", "critique1", "propose2", "critique2", "edit"]


class Stopping(Logged):
    """Raises at the n-th call from now."""

    left = 99

    def _note(self, source, role):
        if self.left == 0:
            raise ConnectionError("stopped")
        self.left -= 1
        super()._note(source, role)


@pytest.mark.parametrize("stop", range(1, 5))
def test_a_review_goes_on_from_the_call_it_was_at(tmp_path, stop):
    plain = asyncio.run(review.review(Logged(tmp_path), SOURCE))
    (tmp_path / "calls").write_text("")
    client, store = Stopping(tmp_path), Store(str(tmp_path / "store"))
    client.left = stop
    with pytest.raises(ConnectionError):
        asyncio.run(review.review(answers.Calls(client, store, SOURCE), SOURCE))
    client.left = 99
    again = asyncio.run(review.review(answers.Calls(client, Store(str(tmp_path / "store")), SOURCE), SOURCE))
    assert again == plain and dict(client.calls()) == {f"1 {r}": 1 for r in ROLES}


def house_of(spark, tmp_path, n):
    house = Warehouse(spark, str(tmp_path / "house"))
    canonical, packages = tables(spark, n)
    full = lambda df, name: house.read(name).unionByName(df, allowMissingColumns=True)
    house.swap({"questions_canonical": full(canonical, "questions_canonical"), "packages": full(packages, "packages")})
    return house, [r.id for r in canonical.collect()]


@pytest.mark.parametrize("role", ["propose1", "critique2", "edit"])
def test_a_task_lost_in_mid_partition_repeats_one_call(spark, tmp_path, role):
    house, ids = house_of(spark, tmp_path, 6)
    at = sorted(ids)[3]
    with pytest.raises(Exception):  # a local session does not run a task again
        translate.run(house, lambda: Logged(tmp_path, (at, role)), concurrency=1, partitions=1)
    assert house.read("translations").count() == 0 and (tmp_path / "died").exists()
    done = translate.run(house, lambda: Logged(tmp_path, (at, role)), concurrency=1, partitions=1)
    calls = Logged(tmp_path).calls()
    assert set(calls) == {f"{i} {r}" for i in ids for r in ROLES}
    assert {k: n for k, n in calls.items() if n > 1} == {f"{at} {role}": 2}
    stored = house.read("translations").collect()
    assert sorted(r.question_id for r in stored) == sorted(ids) and {(r.question_en, r.api_requests, r.editor_status) for r in stored} == {("polished", 5, "edited")}
    assert done["errors"] == 0 and Store(house.uri(f"{house.path}/{translate.CALLS}")).names() == []
    assert translate._answered(house) == []


def results(spark, rows):
    blank = {f.name: None for f in review.RESULT.fields}
    return spark.createDataFrame([blank | r for r in rows], review.RESULT)


def test_records_are_written_once_however_often_they_are_committed(spark, tmp_path):
    spark.dataSource.register(answers.ReviewAnswers)
    path = str(tmp_path / "answers")
    rows = [{"question_id": i, "content_hash": f"h{i}", "answer_en": "é\n" * i, "input_tokens": i} for i in range(20)]
    for _ in range(2):
        results(spark, rows).repartition(3).write.format(answers.NAME).mode("append").save(path)
    results(spark, [rows[4] | {"answer_en": "later"}, rows[5] | {"content_hash": "other", "failure": "why"}]).write.format(answers.NAME).mode("append").save(path)
    got = spark.read.schema(review.RESULT).parquet(path)
    assert got.count() == 21 and got.schema == review.RESULT and (tmp_path / "answers" / "_SUCCESS").exists()
    assert {(r.question_id, r.answer_en) for r in got.filter("failure is null").collect()} == {(r["question_id"], "later" if r["question_id"] == 4 else r["answer_en"]) for r in rows}
    told = [json.loads(p.read_text()) for p in (tmp_path / "answers" / "_commits").iterdir()]
    assert sorted(sum(m["records"] for m in t) for t in told) == [2, 20, 20]


def test_records_of_a_job_that_failed_stay(spark, tmp_path):
    spark.dataSource.register(answers.ReviewAnswers)
    path = str(tmp_path / "answers")
    rows = results(spark, [{"question_id": i, "content_hash": "h"} for i in range(4)]).repartitionByRange(4, "question_id")
    bad = F.when(F.col("question_id") == 3, F.raise_error(F.lit("lost")).cast("string")).otherwise(F.col("content_hash"))
    with pytest.raises(Exception):
        rows.withColumn("content_hash", bad).write.format(answers.NAME).mode("append").save(path)
    assert not (tmp_path / "answers" / "_SUCCESS").exists()
    assert not answers.recorded(path) or spark.read.schema(review.RESULT).parquet(path).filter("question_id = 3").count() == 0
    rows.write.format(answers.NAME).mode("append").save(path)
    assert sorted(r.question_id for r in spark.read.schema(review.RESULT).parquet(path).collect()) == [0, 1, 2, 3]


def test_a_sink_without_keys_is_refused(spark, tmp_path):
    spark.dataSource.register(answers.ReviewAnswers)
    with pytest.raises(Exception, match="columns that are missing"):
        spark.range(2).write.format(answers.NAME).mode("append").save(str(tmp_path / "x"))
