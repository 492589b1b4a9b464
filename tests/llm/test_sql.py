import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
from corpusmill.llm.queries import ORACLE_SQL, QUERIES
from llm_oracle import compare

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_sql(spark, name):
    assert compare(QUERIES[name](spark, SF), ORACLE_SQL[name], SF)


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
