import pytest

from grapheon import queries
from tests.test_queries import SF


@pytest.mark.parametrize(("name", "column", "table"), [("composition_rollup_all", "root", "region"), ("walk_inbound_all", "root", "orders"), ("neighbours_any_all", "root", "nation"), ("unsatisfied_all", "supplier", "supplier")])
def test_every_root_has_rows(spark, name, column, table):
    got = queries.QUERIES[name](spark, SF).select(column).distinct().count()
    assert got == spark.read.parquet(f"{SF}/{table}.parquet").count()
