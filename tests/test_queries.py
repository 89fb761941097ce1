import os

import pytest

from grapheon import queries
from tests.oracle import compare

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_its_sql(spark, name):
    compare(spark, name, queries.QUERIES[name], queries.ORACLE_SQL[name], SF)


def test_queries_without_sql_have_rows(spark):
    """What they hold is tested against plain loops: test_analogies, test_rest."""
    for name in set(queries.QUERIES) - set(queries.ORACLE_SQL):
        assert queries.QUERIES[name](spark, SF).count() > 0, name
