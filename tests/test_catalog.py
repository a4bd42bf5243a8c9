import pytest
from compare import SF, same
from eventloom.plans import catalog

ROWS_ONLY = sorted(set(catalog.QUERIES) - set(catalog.ORACLES))


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_equals_sql(spark, name):
    same(spark, catalog.QUERIES[name], catalog.ORACLES[name])


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_gives_rows(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() > 0
