import random
from datetime import datetime

import pytest
from corpusmill.operators import curate, funnel
from corpusmill.plans import build
from corpusmill.schemas import QUESTIONS, TRANSLATIONS
from corpusmill.sources import buckets
from corpusmill.sources.warehouse import Warehouse

LATER = ("question_exclusions", "questions_canonical", "question_printings", "question_groups", "translations")


def question(rng, ident):
    """Few different questions, so that printings meet, in spellings that share a key; some that are excluded."""
    kind = rng.randrange(9)
    words = f"Вопрос {kind} о городе, в котором случилось то, что описано здесь"
    words = rng.choice((words, words.upper() + "!", f"  {words}.", "коротко" if rng.random() < 0.3 else words))
    blank = {f.name: None for f in QUESTIONS.fields} | {c: "" for c in ("explanation", "acceptance_criteria", "handout_text", "source_references")}
    plays = [(float(rng.choice((0, 10, 50, 90))), rng.randrange(40)) for _ in range(rng.randrange(4))]
    return blank | {
        "id": ident, "package_id": ident // 10, "question": words, "answer": rng.choice(("", "да", "да " * rng.randrange(1, 5))),
        "explanation": "x" * rng.randrange(4), "handout_text": rng.choice(("", " ", "аб")), "source_references": rng.choice(("", "книга", "книги")),
        "tournament_ids": [rng.randrange(5) for _ in range(rng.randrange(3))], "solve_percentages": [p for p, _ in plays],
        "correct_answers": [c for _, c in plays][: rng.choice((9, 1))], "content_hash": "h", "kind": "normal",
    }


def rows_of(house, name):
    return sorted(map(str, house.read(name).collect()))


def store(house, rows):
    taken = house.spark.createDataFrame(rows, QUESTIONS)
    house.point({"questions": house.upsert("questions", taken), "question_changes": house.upsert("question_changes", taken.selectExpr("id AS question_id"))})


def translate_all(house):
    """A translation for every canonical record of now."""
    now = datetime(2026, 1, 1)
    blank = {f.name: None for f in TRANSLATIONS.fields}
    rows = [blank | {"question_id": r.id, "content_hash": r.content_hash, "status": "translated", "completed_at": now} for r in house.read("questions_canonical").collect()]
    house.point({"translations": house.upsert("translations", house.spark.createDataFrame(rows, TRANSLATIONS))})


@pytest.mark.parametrize("seed", [1])
def test_catching_up_equals_a_full_rebuild(spark, tmp_path, monkeypatch, seed):
    monkeypatch.setattr(buckets, "BUCKET_ROWS", 20)
    rng, house = random.Random(seed), Warehouse(spark, str(tmp_path / "house"))
    store(house, [question(rng, i) for i in rng.sample(range(100, 160), 30)])
    build.catch_up(house)
    translate_all(house)
    # later printings only; any of the lot; a single one
    for ids in (range(200, 212), rng.sample(range(90, 220), 15), [rng.randrange(100, 160)]):
        store(house, [question(rng, i) for i in ids])
        caught = build.catch_up(house).first().asDict()
        got = {name: rows_of(house, name) for name in LATER}
        assert house.read("question_changes").isEmpty()
        assert {r.name for r in funnel.violations(house.tables()).collect()} == {"questions: no package"}
        assert curate.summary(house.read("question_printings")).first().asDict() == {k: v for k, v in caught.items() if k != "dropped"}
        before = house.current()
        again = build.rebuild(house).first().asDict()
        assert {name: rows_of(house, name) for name in LATER} == got
        assert again == caught | {"dropped": 0}
        house.point({name: before[name] for name in LATER})  # go on from what was caught up
        translate_all(house)


def test_later_printings_leave_other_members_unread(spark, tmp_path, monkeypatch):
    """A group that only gains later printings is not made anew: its members aren't looked up."""
    rng, house = random.Random(3), Warehouse(spark, str(tmp_path / "house"))
    one = question(rng, 1) | {"question": "Вопрос о городе, в котором случилось то, что описано здесь", "answer": "да"}
    store(house, [one | {"id": i} for i in range(1, 6)])
    build.catch_up(house)
    asked = []
    lookup = house.lookup
    monkeypatch.setattr(house, "lookup", lambda name, keys: asked.append((name, sorted(r[0] for r in keys.collect()))) or lookup(name, keys))
    store(house, [one | {"id": i, "answer": "да, " + "очень " * i} for i in (6, 7)])
    build.catch_up(house)
    assert [ids for name, ids in asked if name == "questions"] == [[6, 7], []]
    record = house.read("questions_canonical").first()
    assert (record.id, record.printings, record.answer) == (1, 7, "да, " + "очень " * 7)
    store(house, [one | {"id": 7, "answer": "нет"}])  # the longest answer leaves: the group is made anew
    build.catch_up(house)
    assert house.read("questions_canonical").first().answer == "да, " + "очень " * 6 and asked[-1][0] == "translations"
