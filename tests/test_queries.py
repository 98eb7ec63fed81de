"""Every query of the library's own tables against its SQL, over whole tables."""

import pytest

import __spark_entry__
from compare import connect, difference
from sigloom.plans import check_sql, table_queries


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = connect(sf_dir)
    yield con
    con.close()


def test_every_query_has_sql():
    assert set(table_queries.QUERIES) == set(check_sql.CHECKS)
    assert set(table_queries.QUERIES) <= set(__spark_entry__.queries())
    assert set(check_sql.CHECKS) <= set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", list(table_queries.QUERIES))
def test_query(spark, sf_dir, duck, name):
    df = __spark_entry__.queries()[name](spark, sf_dir)
    assert difference(df, duck, __spark_entry__.oracle_sql()[name]) is None


def test_entry(spark):
    df = __spark_entry__.entry(spark)
    assert df.count() > 0 and "cpd_score" in df.columns
