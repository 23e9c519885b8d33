"""Every registered query against its SQL on the whole tables of the smallest data set."""

import pytest
from oracle_check import compare, connect

from riskflow.plans.oracle import ORACLE
from riskflow.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", QUERIES)
def test_query_agrees_with_sql(spark, duck, name):
    assert compare(spark, duck, QUERIES[name], ORACLE[name], SF_DIR) is None
