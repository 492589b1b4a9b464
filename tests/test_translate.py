import json

import pytest
from corpusmill.operators import review
from corpusmill.plans import translate
from corpusmill.sources.warehouse import Warehouse
from test_review import Steady, tables


def test_runs_until_nothing_is_pending(spark, tmp_path, capsys):
    house = Warehouse(spark, str(tmp_path / "house"))
    canonical, packages = tables(spark, 3)
    full = lambda df, name: house.read(name).unionByName(df, allowMissingColumns=True)
    house.swap({"questions_canonical": full(canonical, "questions_canonical"), "packages": full(packages, "packages")})
    args = [str(tmp_path / "house"), "2"]
    assert translate.main(args, Steady) == 0
    assert "completed: 2" in capsys.readouterr().out
    by_status, totals, waiting = translate.statistics(house)
    assert [tuple(r) for r in by_status.collect()] == [("translated", 2)] and totals.first().n == 2 and waiting == 1
    assert translate.run(house, Steady, 2)["selected"] == 1
    assert translate.run(house, Steady, 2)["selected"] == 0
    assert translate.run(house, Steady, None, refresh=True)["completed"] == 3 and house.read("translations").count() == 3
    with pytest.raises(SystemExit):
        translate.main([args[0], "0"], Steady)


class Breaking(Steady):
    """Answers for some records; the others' reviews end the run."""

    async def propose(self, source, previous, feedback):
        if source["question_id"] % 3 == 0:
            raise RuntimeError("out of credit")
        return await super().propose(source, previous, feedback)


def test_answers_outlive_a_run_that_breaks_off(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(translate, "BATCH", 1)
    house = Warehouse(spark, str(tmp_path / "house"))
    canonical, packages = tables(spark, 6)
    full = lambda df, name: house.read(name).unionByName(df, allowMissingColumns=True)
    house.swap({"questions_canonical": full(canonical, "questions_canonical"), "packages": full(packages, "packages")})
    told = []
    with pytest.raises(Exception, match="out of credit"):
        translate.run(house, Breaking, fail_fast=True, told=lambda *x: told.append(x))
    written = [r.question_id for f in translate._answered(house) for r in spark.read.parquet(f).collect()]
    assert house.read("translations").count() == 0 and len(written) <= len(told)
    done = translate.run(house, Breaking)
    stored = {r.question_id for r in house.read("translations").collect()}
    assert set(written) <= stored and done["selected"] == 6 - len(written) and done["errors"] == 6 - len(stored)
    assert translate._answered(house) == []
    with pytest.raises(Exception, match="out of credit"):
        translate.main([str(tmp_path / "house"), "9", "--fail-fast"], Breaking)
    last = translate.run(house, Steady)  # record 3 fails with any client
    assert (last["completed"], last["errors"]) == (5 - len(stored), 1)


class Told(Steady):
    """Says in its texts which instructions it got."""

    def __init__(self, policy):
        self.policy = policy

    async def propose(self, source, previous, feedback):
        answer, usage = await super().propose(source, previous, feedback)
        return answer | {"question_en": self.policy.prompt("propose", source, feedback=feedback)}, usage

    async def critique(self, source, candidate):
        answer, usage = await super().critique(source, candidate)
        return answer | {"decision": "revise"}, usage

    async def edit(self, source, candidate):
        return dict(candidate) | {"decision": "unchanged", "edit_summary": "", "needs_rework_reason": ""}, {"requests": 1}


def test_policy_reaches_the_client(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "house"))
    canonical, packages = tables(spark, 2)
    full = lambda df, name: house.read(name).unionByName(df, allowMissingColumns=True)
    house.swap({"questions_canonical": full(canonical, "questions_canonical"), "packages": full(packages, "packages")})
    (tmp_path / "policy.json").write_text(json.dumps({"instructions": {"propose": "Переведи."}, "max_revisions": 0}), encoding="utf-8")
    assert translate.main([str(tmp_path / "house"), "5", "--policy", str(tmp_path / "policy.json")], Told) == 0
    rows = house.read("translations").collect()
    assert len(rows) == 2 and all(r.translation_attempts == 1 and r.question_en.startswith('Переведи.\n\n{\n  "question_ru": "q"') for r in rows)
    with pytest.raises(TypeError):
        review.Policy(rounds=3)
