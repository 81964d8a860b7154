"""Every registered query against its SQL; those without SQL have to run."""

import os

import pytest
from compare import rows, views

from tallgrass.plans import registry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return views(SF)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, con, name):
    found = registry.queries()[name](spark, SF).toPandas()
    if name in registry.oracle_sql():
        expected = con.sql(registry.oracle_sql()[name]).df()
        assert sorted(found.columns) == sorted(expected.columns)
        assert rows(found) == rows(expected)
    else:
        assert len(found) > 0
