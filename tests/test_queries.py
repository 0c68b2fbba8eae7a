"""Every registered relational query against its oracle SQL on the smallest tables."""

import oracle
import pytest
from tessella.plans import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_matches_its_oracle(spark, con, name):
    found = oracle.difference(spark, con, SF, catalog.queries()[name], catalog.oracle_sql()[name])
    assert found in ("", "no rows"), found


def test_entry_has_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
