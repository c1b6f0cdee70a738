"""Every query against its SQL."""

import pytest
from conftest import rows_of

from siltstone.oracles import oracle_sql
from siltstone.queries import queries


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, sf_dir, duck, name):
    assert rows_of(queries()[name](spark, sf_dir)) == rows_of(duck.sql(oracle_sql()[name]).df())


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_query_without_sql_runs(spark, sf_dir, name):
    assert queries()[name](spark, sf_dir).count() > 0
