from random import Random

from corpusmill import schemas
from corpusmill.operators import curate, funnel, merge
from pyspark.sql import functions as F

LONG = "Назовите город, в котором произошли описанные в тексте события"


def questions(spark, *rows):
    """Rows of (id, package, question, answer, explanation, tournaments, percents, corrects, kind)."""
    full = []
    for i, package, question, answer, explanation, tours, percents, corrects, *kind in rows:
        full.append((i, package, 1, question, answer, explanation, "", "", "", kind[0] if kind else "normal", 0, [], [], [], tours, "", 0, percents, corrects, f"h{i}"))
    return spark.createDataFrame(full, schemas.QUESTIONS)


def test_merge_of_two_printings(spark):
    rows = questions(spark, (9, 8, LONG + "!", "Рим ", "длинное пояснение", [2, 3], [90.0], [90], "blitz"), (4, 7, LONG.upper(), "Рим", "кратко", [3, 1], [50.0, 0.0, 7.0], [5, 1], "normal"))
    (r,) = curate.merge_printings(rows).collect()
    assert (r.id, r.package_id, r.kind, r.answer, r.explanation, r.question) == (4, 7, "normal", "Рим", "длинное пояснение", LONG.upper())
    assert r.tournament_ids == [3, 1, 2] and r.solve_percentages == [50.0, 0.0, 90.0] and r.correct_answers == [5, 1, 90]
    assert (r.printings, r.playings) == (2, 3) and abs(r.total_teams - 110) < 1e-9 and abs(r.solve_rate - 96 / 110) < 1e-9
    assert curate.merge_printings(rows, True).first() == r


def test_singletons_with_and_without_plays(spark):
    a, b = curate.merge_printings(questions(spark, (1, 1, LONG, "a", "", [], [25.0], [5]), (2, 1, LONG + " иначе", "b", "", None, None, None))).orderBy("id").collect()
    assert (a.printings, a.playings, a.total_teams, a.solve_rate) == (1, 1, 20.0, 0.25)
    assert (b.printings, b.playings, b.total_teams, b.solve_rate, b.tournament_ids) == (1, 0, 0.0, None, [])


def test_map_summary_and_exclusion(spark):
    rows = questions(spark, *[(i, 1, f"{LONG} {'раз' if i % 2 else 'два'}", "x", "", [], [], []) for i in (1, 2, 3, 4)], (5, 1, "$1a", "x", "", [], [], []))
    excluded = curate.exclusions(rows)
    kept = curate.clean(rows, excluded)
    found = curate.printing_map(kept)
    assert sorted(map(tuple, found.collect())) == [(1, 1), (2, 2), (3, 1), (4, 2)]
    assert tuple(curate.summary(found).first()) == (2, 2, 2)
    assert [tuple(r) for r in curate.exclusion_counts(excluded).collect()] == [("not_a_question", 1)]
    empty = curate.summary(curate.printing_map(kept.limit(0)))
    assert tuple(empty.first()) == (0, 0, 0)


def test_upsert_and_latest(spark):
    old = spark.createDataFrame([(1, "a", 0, 0), (2, "b", 0, 0)], "id long, v string, t int, p int")
    new = spark.createDataFrame([(2, "c", 0, 5), (2, "d", 1, 0), (3, "e", 0, 0)], old.schema)
    assert sorted(r.v for r in merge.upsert(old, new, "id", ["t", "p"]).collect()) == ["a", "d", "e"]
    assert [r.v for r in curate.latest(new, "id", F.desc("t"), F.desc("p")).orderBy("id").collect()] == ["d", "e"]


def test_prune_and_funnel(spark):
    canonical = spark.createDataFrame([(1, "h1"), (2, "h2"), (3, "h3")], "id long, content_hash string")
    t = spark.createDataFrame([(1, "h1", "translated", "q"), (2, "old", "adapted", "q"), (9, "h1", "adapted", "q"), (3, "h3", "untranslatable", "")], "question_id long, content_hash string, status string, question_en string")
    kept, gone = merge.prune(t, canonical)
    assert sorted(r.question_id for r in kept.collect()) == [1, 3] and sorted(r.question_id for r in gone.collect()) == [2, 9]
    q = spark.createDataFrame([(i,) for i in range(1, 6)], "id long")
    x = spark.createDataFrame([(5, "no_answer")], schemas.EXCLUSIONS)
    assert tuple(funnel.funnel(q, x, canonical, kept).first()) == (5, 4, 3, 1, 1)
    assert [(r.id, r.translation_status) for r in funnel.translated(canonical, kept).collect()] == [(1, "translated")]
    none = spark.createDataFrame([], schemas.TRANSLATIONS)
    assert tuple(funnel.usage_totals(none).first()) == (0, None, None, None, None, None, None)
    assert funnel.status_counts(none).count() == 0


def test_hot_groups_are_pooled_in_segments_with_equal_results(spark):
    """Every group above two printings takes the way of segments, of few ids or of many, negative ids included."""
    rng = Random(2)
    rows = [{"id": i, "question": f"вопрос {rng.randrange(6)}", "answer": "x" * rng.randrange(4), "tournament_ids": rng.choice((None, [rng.randrange(4)])), "solve_percentages": [float(i % 90)] * rng.randrange(3), "correct_answers": [i] * rng.randrange(3)} for i in rng.sample(range(-50, 150), 90)]
    blank = {f.name: None for f in schemas.QUESTIONS.fields}
    df = spark.createDataFrame([blank | r for r in rows], schemas.QUESTIONS).repartition(5)
    want = sorted(map(str, curate.merge_printings(df).collect()))
    for hot, width in ((2, 7), (2, 1), (16, 1 << 16)):
        assert sorted(map(str, curate.merge_printings(df, hot=hot, width=width).collect())) == want
