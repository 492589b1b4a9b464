import asyncio
from collections import Counter

import pytest
from corpusmill import schemas
from corpusmill.operators import review
from corpusmill.progress import format_duration, reporting, sink_for
from pyspark.sql import functions as F

GOOD = dict.fromkeys(schemas.ENGLISH, "text") | {"status": "translated", "changes_description": "none", "untranslatable_reason": ""}
LOST = dict.fromkeys(schemas.ENGLISH, "") | {"status": "untranslatable", "changes_description": "", "untranslatable_reason": "a pun"}
SOURCE = dict.fromkeys(review.SOURCE, "с") | {"question_id": 1}


def critique(decision="accept", status="translated", **more):
    return {"decision": decision, "accepted_status": status, "summary": "", "issues": [], "revision_instructions": ""} | more


def edit(decision="unchanged", **more):
    return dict.fromkeys(schemas.ENGLISH, "text") | {"decision": decision, "edit_summary": "", "needs_rework_reason": ""} | more


class Script:
    """A client that answers from lists and notes what it was told."""

    def __init__(self, candidates, critiques, edits=()):
        self.answers = {"propose": iter(candidates), "critique": iter(critiques), "edit": iter(edits)}
        self.feedback = []

    async def propose(self, source, previous, feedback):
        self.feedback.append(feedback)
        return next(self.answers["propose"]), {"requests": 1, "input_tokens": 100, "output_tokens": 40}

    async def critique(self, source, candidate):
        return next(self.answers["critique"]), {"requests": 1, "input_tokens": 80, "output_tokens": 20}

    async def edit(self, source, candidate):
        return next(self.answers["edit"]), {"requests": 1, "input_tokens": 60, "output_tokens": 10}


def run(*script, **more):
    client = Script(*script)
    return asyncio.run(review.review(client, SOURCE, **more)), client


def test_revised_then_accepted():
    v, client = run([GOOD, GOOD], [critique("revise", revision_instructions="shorter"), critique("accept", "adapted")], [edit()])
    assert (v.candidate["status"], v.rounds, v.edits, v.editor_status) == ("adapted", 2, 1, "unchanged")
    assert v.usage == Counter(requests=5, input_tokens=420, output_tokens=130) and client.feedback[1]["revision_instructions"] == "shorter"
    assert len(v.history) == 3


def test_exhausted_without_and_with_a_playable_candidate():
    v, _ = run([GOOD] * 2, [critique("revise", "untranslatable", summary="no way")] * 2, max_revisions=1)
    assert v.candidate == LOST | {"changes_description": review.EXHAUSTED, "untranslatable_reason": "no way"} and v.editor_status == "skipped" and len(v.history) == 2
    v, _ = run([GOOD, GOOD | {"answer_en": " "}], [critique("revise", "adapted")] * 2, [edit()], max_revisions=1)
    assert v.candidate == GOOD | {"status": "adapted"}
    v, _ = run([GOOD | {"answer_en": " "}], [critique("revise")], max_revisions=0)
    assert v.candidate["untranslatable_reason"] == "answer_en is blank"


def test_form_and_disagreement_force_a_revision():
    v, client = run([GOOD | {"question_en": ""}, LOST, LOST], [critique(revision_instructions="ok"), critique(), critique("accept", "untranslatable")])
    assert v.candidate["status"] == "untranslatable" and v.rounds == 3
    assert client.feedback[1]["revision_instructions"] == "ok question_en is blank" and client.feedback[2]["issues"] == [review.DISAGREE]


def test_editor():
    v, _ = run([GOOD], [critique()], [edit("unchanged", answer_en="better", edit_summary="")])
    assert v.editor_status == "edited" and v.candidate["answer_en"] == "better" and v.candidate["changes_description"] == "none English copy edit: " + review.POLISHED
    v, _ = run([GOOD], [critique()], [edit("needs_rework", answer_en="other", needs_rework_reason="hard")])
    assert v.editor_status == "needs_rework" and v.candidate == GOOD and v.history[-1]["editor"]["needs_rework_reason"] == "hard"
    v, _ = run([GOOD], [critique()], [edit("edited", answer_en=" ")])
    assert v.editor_status == "needs_rework" and "answer_en" in v.history[-1]["editor"]["needs_rework_reason"]
    v, _ = run([GOOD], [critique()], [edit("edited")])
    assert v.editor_status == "unchanged"


class Steady:
    """Accepts everything but questions that say 'bad'; counts how many reviews are under way."""

    now = peak = 0

    async def propose(self, source, previous, feedback):
        Steady.now += 1
        Steady.peak = max(Steady.peak, Steady.now)
        await asyncio.sleep(0.01)
        Steady.now -= 1
        if source["question"] == "bad":
            raise RuntimeError("refused")
        return dict(GOOD), {"requests": 1, "input_tokens": 100}

    async def critique(self, source, candidate):
        return critique(), {"requests": 1}

    async def edit(self, source, candidate):
        return edit(), {"requests": 1}


def tables(spark, n=8):
    canonical = spark.createDataFrame([(i, 1, f"h{i}", "bad" if i == 3 else "q") for i in range(n)], "id long, package_id long, content_hash string, question string")
    canonical = canonical.select("*", *[F.lit("").alias(c) for c in ("answer", "explanation", "acceptance_criteria", "handout_text")])
    return canonical, spark.createDataFrame([(1, "Пакет")], "id long, title string")


def test_distributed_run(spark):
    canonical, packages = tables(spark)
    none = spark.createDataFrame([], schemas.TRANSLATIONS)
    inputs = review.pending_inputs(canonical, none, packages)
    out = review.run_reviews(inputs, Steady, concurrency=2, partitions=2).cache()
    assert tuple(review.run_report(out).first())[:5] == (8, 7, 1, 21, 700)
    (bad,) = out.filter("failure is not null").collect()
    assert bad.question_id == 3 and bad.failure == "RuntimeError: refused" and bad.status is None
    done = out.filter("failure is null").drop("failure")
    assert done.schema == schemas.TRANSLATIONS and {r.editor_status for r in done.collect()} == {"unchanged"}
    assert [r.question_id for r in review.pending_inputs(canonical, done, packages).collect()] == [3]
    assert review.pending_inputs(canonical, done, packages, refresh=True).count() == 8
    with pytest.raises(Exception, match="refused"):
        review.run_reviews(inputs, Steady, fail_fast=True).collect()


@pytest.mark.parametrize("limit", [1, 4])
def test_concurrency_is_bounded(limit):
    async def all_of():
        gate = asyncio.Semaphore(limit)

        async def one():
            async with gate:
                await review.review(Steady(), SOURCE | {"question": "q"})

        await asyncio.gather(*[one() for _ in range(12)])

    Steady.peak = 0
    asyncio.run(all_of())
    assert Steady.peak == limit


def test_draws_cover_every_record_once(spark):
    canonical, packages = tables(spark, 10)
    left, seen = canonical, []
    while left.count():
        none = spark.createDataFrame([], schemas.TRANSLATIONS)
        seen.append([r.question_id for r in review.pending_inputs(left, none, packages, limit=4, seed=len(seen)).collect()])
        left = left.filter(~F.col("id").isin(seen[-1]))
    assert sorted(sum(seen, [])) == list(range(10)) and [len(s) for s in seen] == [4, 4, 2]


def test_prompt():
    assert review.prompt(SOURCE).startswith('{"question_ru": "с"') and '"package_title": "с"' in review.prompt(SOURCE)


class Stream:
    def __init__(self, terminal):
        self.text, self.terminal = "", terminal

    def isatty(self):
        return self.terminal

    def write(self, text):
        self.text += text

    def flush(self):
        pass


def test_durations():
    assert [format_duration(x) for x in (-3, 9, 75, 11_059)] == ["0s", "9s", "1m15s", "3h04m"]


def test_progress_lines():
    now = [0.0]
    log = Stream(False)
    with reporting("fetch", sink_for(log), clock=lambda: now[0]) as told:
        told(0, 4_000)
        now[0] = 10.0
        told(1_000, 4_000, "too soon")
        now[0] = 40.0
        told(1_000, 4_000, "slow")
        now[0] = 50.0
        told(4_000, 4_000)
    assert log.text.splitlines() == ["fetch: 0/4,000 (0%)", "fetch: 1,000/4,000 (25%), 25.0/s, eta 2m00s: slow", "fetch: 4,000/4,000 (100%), 80.0/s", "fetch: 4,000 in 50s"]


def test_progress_on_a_terminal():
    terminal = Stream(True)
    with reporting("x", sink_for(terminal), clock=lambda: 0.0) as told:
        told(1, 10, "long word")
        told(10, 10)
    assert terminal.text == "\rx: 1/10 (10%): long word\rx: 10/10 (100%)         \rx: 10 in 0s    \n"
    terminal = Stream(True)
    with reporting("x", sink_for(terminal)):
        pass
    assert terminal.text == "\rx: nothing to do\n"
