"""Every named query against its SQL, over whole tables."""

import os

import pytest

import parity
from millrace.catalog import QUERIES

SF = os.environ.get("PARITY_SF", "0.001")


@pytest.fixture(scope="module")
def con():
    return parity.connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    query = QUERIES[name]
    df = query.run(spark, f"{parity.DATA}/sf{SF}")
    got = parity.spark_result(df)
    if query.sql is None:
        assert got[1]
        return
    assert parity.differences(got, parity.sql_result(con, query.sql)) is None
    assert parity.type_differences(df, con, query.sql) is None
