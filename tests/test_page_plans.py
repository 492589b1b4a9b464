from corpusmill.plans import stage_queries


def test_payloads_are_read_by_python_once(spark):
    """A filter on what follows from the payload doesn't have Python read every page a second time."""
    plan = stage_queries.question_rows(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_pages_are_spelt_and_read_once(spark):
    """Neither the filter on errors nor the chunks of a page spell or read its JSON again."""
    plan = stage_queries.question_rows(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 0 and plan.count("longTitle, concat(Order") <= 1
