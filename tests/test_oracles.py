"""Every registered query equals its SQL oracle (row count, columns, values) at the smallest sf."""

import pytest

from tidewater.plans.oracles import oracle_sql
from tidewater.plans.registry import queries
from helpers import SF_SMALL, duck, result_digest

KEYS = sorted(queries())


def test_every_query_has_an_oracle():
    assert set(oracle_sql()) == set(queries())
    assert len(KEYS) == 43


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = queries()[key](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(oracle_sql()[key])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    h1, l1 = result_digest(df.columns, rows)
    h2, l2 = result_digest(ocols, orows)
    assert h1 == h2, (sorted(set(l1) - set(l2))[:3], sorted(set(l2) - set(l1))[:3])


def test_entry_smoke(spark):
    from __spark_entry__ import entry

    df = entry(spark)
    assert df.count() > 0
    assert df.columns[-1] == "rank"
