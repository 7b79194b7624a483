"""Registered queries with SQL against DuckDB; the others have plain versions in their tests."""

import pytest

from oracle import difference, oracle_connection
from tillwright.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("query", [q for q in QUERIES if q.sql], ids=lambda q: q.name)
def test_query_matches_its_sql(spark, query):
    assert difference(query.run(spark, SF_DIR), oracle_connection(SF_DIR), query.sql) is None
