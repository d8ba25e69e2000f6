import pytest

from compare import differences, open_duckdb
from emberline.llm.oracle import ORACLE
from emberline.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, sf_dir, name):
    assert differences(QUERIES[name](spark, sf_dir), open_duckdb(sf_dir), ORACLE[name]) is None


def test_a_query_per_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
