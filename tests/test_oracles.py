"""Every registered query against its SQL oracle (DuckDB) on the smallest tables."""

import pytest

import __spark_entry__ as E
from lakeframe import registry
from tools.check_oracles import digest, duck

from .conftest import SF_SMALL

QUERIES = registry.queries()  # those of the optional part have tests of their own
ORACLES = registry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_is_registered_with_an_oracle():
    assert set(ORACLES) == set(QUERIES)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["media_name", "original_height", "original_width"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    assert rows, f"{name} returned no rows"
    if name not in ORACLES:
        return
    res = con.execute(ORACLES[name])
    cols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(cols, orows)
