import pytest

from oracle import same
from rivulet.plans import registry


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_against_sql(spark, sf, name):
    assert same(spark, sf, registry.queries()[name], registry.oracle_sql()[name])


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_rows_only(spark, sf, name):
    assert registry.queries()[name](spark, sf).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(registry.queries()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
