import pytest

from corvane.plans import catalog
from tests._sql import SMALL, connect, same


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_its_sql(spark, name):
    assert name in catalog.SQL
    same(catalog.QUERIES[name](spark, SMALL), connect(), catalog.SQL[name])


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns
    assert set(entry.oracle_sql()) <= set(entry.queries())
