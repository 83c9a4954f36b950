"""Every query with an oracle equals its DuckDB SQL on the sf0.001 tables."""

import pytest

from conftest import SF_SMALL

import __spark_entry__ as E
from tools.oracle_check import digest, duck

ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = df.collect()
    res = con.execute(ORACLES[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(E.queries())


def test_entry_smoke(spark):
    rows = E.entry(spark).collect()
    assert len(rows) == 3
