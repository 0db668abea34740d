"""Each registered query against its SQL."""

import pytest

from ledgerloom.plans import registry
from tests.oracle import differences, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    return duck(SF)


def test_every_query_has_sql():
    assert set(registry.queries()) == set(registry.oracle_sql())


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, tables, name):
    df = registry.queries()[name](spark, SF)
    assert differences(df, tables, registry.oracle_sql()[name]) == ""
