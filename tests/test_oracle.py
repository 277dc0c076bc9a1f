"""Every SQL-expressible query equals its independent DuckDB twin."""

import pytest

from __spark_entry__ import oracle_sql, queries
from tests.conftest import SF_SMALL
from tests.helpers import same_rows

SQL = oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck, name):
    df = queries()[name](spark, SF_SMALL)
    same_rows(df, duck(SF_SMALL), SQL[name])


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(queries())


def test_entry_runs(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.count() > 0
    assert df.columns == ["id", "is_train", "cust_avg", "cust_std"]
