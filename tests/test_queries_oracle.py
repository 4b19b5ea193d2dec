"""Every registered query against its DuckDB SQL on the smallest driver tables."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tools.oracle_check import duck, rows_of

SQL = E.oracle_sql()
NAMES = sorted(set(E.queries()) - set(E.LLM_QUERIES))  # those of tests/llm have their own tests


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if name not in SQL:
        assert len(got) > 0
        return
    res = con.execute(SQL[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert got == rows_of(cols, res.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "_xfer_id" in df.columns


def test_every_query_has_sql():
    assert set(NAMES) <= set(SQL)
