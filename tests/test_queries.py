import pytest

import __spark_entry__ as entry
from tests.compare import connect, differences

from kerbside.plans.oracles import oracle_sql
from kerbside.plans.queries import QUERIES

ORACLES = oracle_sql()


def test_each_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, check_dir, name):
    con = connect(check_dir)
    assert differences(QUERIES[name](spark, check_dir), con, ORACLES[name]) == []


def test_entry(spark):
    assert entry.entry(spark).count() > 0
