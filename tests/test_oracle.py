"""Every catalogue key against its DuckDB oracle on the smallest tables."""

import pytest

from __spark_entry__ import entry
from blotter.catalog import queries
from blotter.oracle import oracle_sql
from tests.conftest import SF_SMALL
from tests.oracle_compare import compare, duck

KEYS = sorted(queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_key_has_an_oracle():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, con, key):
    r = compare(spark, con, key, SF_SMALL, queries(), oracle_sql())
    assert r["status"] == "match", r


def test_entry_schema_is_stable(spark):
    a, b = entry(spark), entry(spark)
    assert a.schema == b.schema
    assert a.count() > 0
