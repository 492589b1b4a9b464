import sys
from pathlib import Path

from corpusmill.llm import linedup
from corpusmill.llm.queries import table

sys.path.insert(0, str(Path(__file__).parent))
from llm_oracle import compare

SF = "/root/testdata/sf0.001"


def test_matches_sql_with_exact_counts(spark):
    got = compare(linedup.digests(table(spark, SF, "documents")), linedup.ORACLE_SQL, SF)
    assert any(r[1] for r in got)


SITES = "abcdef"
BOILER = "All rights reserved."


def rows():
    out = [(i, f"{BOILER}\nown line number {i}\n  {BOILER} \n\nshort", s, "x", 1) for i, s in enumerate(SITES)]
    return out + [(6, None, "a", "x", 1), (7, "", "b", "x", 1), (8, "line on four sites", None, "x", 1), (9, BOILER, None, "x", 1), (9, BOILER, None, "x", 1), (None, BOILER + "\nz", "a", "x", 1), (10, "word " * 30_000 + "\n" + BOILER, "c", "x", 1)] + [(20 + i, "line on four sites", s, "x", 1) for i, s in enumerate("abc")]


SCHEMA = "doc_id long, text string, source string, gone string, line long"


def test_edges_and_clashing_names(spark):
    docs = spark.createDataFrame(rows(), SCHEMA)
    out = linedup.remove_boilerplate(docs)
    assert out.columns == [*docs.columns, "n_lines", "n_removed"] and out.count() == docs.count()
    got = {(r.doc_id, r.n_lines, r.n_removed, r.text) for r in out.collect()}
    assert (0, 5, 2, "own line number 0\n\nshort") in got
    assert {(6, 0, 0, None), (7, 0, 0, ""), (9, 1, 1, ""), (None, 2, 1, "z"), (8, 1, 0, "line on four sites")} <= got
    assert linedup.remove_boilerplate(docs.limit(0)).count() == 0


def test_near_threshold_lines_are_counted_exactly(spark):
    for sites in range(3, 9):
        lines = spark.createDataFrame([(i, f"s{i % sites}", 7) for i in range(50)], "doc long, site string, line long")
        assert linedup.boilerplate(lines).count() == (sites >= linedup.MIN_SITES)


def test_stage_keeps_one_copy_and_the_shuffled_join_agrees(spark, monkeypatch):
    docs = spark.createDataFrame(rows(), SCHEMA).filter("doc_id is not null")
    out = linedup.dedup_stage(docs)
    assert out.columns == docs.columns
    got = {r.doc_id: r.text for r in out.collect()}
    assert BOILER in got[0] and BOILER not in got[1] and 9 not in got and got[6] is None and got[7] == ""
    monkeypatch.setattr(linedup, "BROADCAST_ROWS", -1)
    assert {r.doc_id: r.text for r in linedup.dedup_stage(docs).collect()} == got


def test_no_python_in_the_plan(spark):
    plan = linedup.digests(table(spark, SF, "documents"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_documents_of_very_many_boilerplate_lines(spark):
    """16,000 lines that stand on six sites each: seconds, and nothing but the own line is left."""
    import time

    lines = [f"boilerplate number {i}" for i in range(16_000)]
    docs = spark.createDataFrame([(i, "\n".join([*lines, f"own {i} of this site"]), s, "x", 1) for i, s in enumerate(SITES)], SCHEMA)
    start = time.monotonic()
    got = {(r.doc_id, r.n_lines, r.n_removed, r.text) for r in linedup.remove_boilerplate(docs).collect()}
    assert got == {(i, 16_001, 16_000, f"own {i} of this site") for i in range(6)}
    assert time.monotonic() - start < 30


def test_rows_of_one_id_and_different_texts(spark):
    """Each keeps or loses its own lines, also where the id is null."""
    docs = spark.createDataFrame([(i, BOILER, s, "x", 1) for i, s in enumerate(SITES)] + [(3, "another text of three", "a", "x", 1), (None, BOILER + "\na", "b", "x", 1), (None, "no boilerplate at all", "c", "x", 1)], SCHEMA)
    got = sorted((str(r.doc_id), r.text, r.n_removed) for r in linedup.remove_boilerplate(docs, keep_first=True).collect())
    assert got == sorted([("0", BOILER, 0), *((str(i), "", 1) for i in range(1, 6)), ("3", "another text of three", 0), ("None", "a", 1), ("None", "no boilerplate at all", 0)])
