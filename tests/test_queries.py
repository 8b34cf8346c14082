"""Every query against its SQL on the smallest tables."""

import compare
import pytest

from rosterlake.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_equals_sql(spark, con, name):
    said, _ = compare.compare(spark, con, SF, name, registry.queries()[name], registry.oracle_sql().get(name))
    assert said is None


def test_every_sql_has_a_query():
    assert set(registry.oracle_sql()) <= set(registry.queries())


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).take(1)
    assert set(e.oracle_sql()) <= set(e.queries())
