"""Registered queries against their DuckDB oracle on the small tables
(the full set at sf0.01 runs with ``python tools/oracle_check.py``)."""

import pytest

from fixtures import SF_SMALL

from oracle.registry import ORACLES

# fits of the large forest take a minute each: they run with tools/oracle_check.py
KEYS = [k for k in ORACLES if k not in ("model_load_score_verified", "train_and_compare_verified")]


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, key):
    import __spark_entry__ as E
    from tools.oracle_check import connect, rows_of
    sdf = E.queries()[key](spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    res = connect(SF_SMALL).execute(E.oracle_sql()[key])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert rows_of(sdf.columns, srows) == rows_of(dcols, drows)


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert len(df.columns) == 107
    assert df.count() >= 0
