import pytest
from oracle import compare

from lakeloom.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_its_statement(spark, sf_dir, name):
    assert compare(spark, sf_dir, queries.QUERIES[name], queries.ORACLE_SQL[name])
