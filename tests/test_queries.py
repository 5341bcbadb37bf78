"""Every registered query against its SQL twin on whole tables."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry
from tests.compare import assert_same, duck
from tests.conftest import SF_SMALL
from tideline.plans import all_oracles as oracle_sql
from tideline.plans import all_queries as queries


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_each_query_has_a_twin():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, con, name):
    assert_same(queries()[name](spark, SF_SMALL), con, oracle_sql()[name])


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["_id", "customer_id", "total_amount", "status"]
    assert df.count() > 0
