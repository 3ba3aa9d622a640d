import pytest

from brindle.plans import catalog
from tests.compare import duck, rows


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, data, name):
    found = catalog.queries()[name](spark, data).toPandas()
    sql = catalog.oracle_sql().get(name)
    if sql is None:
        assert len(found)
    else:
        assert rows(found) == rows(duck(data).sql(sql).df())


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 10
    assert set(entry.oracle_sql()) <= set(entry.queries())
