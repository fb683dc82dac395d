"""Every plan with SQL equals its DuckDB statement on the smallest scale factor."""

import pytest

from quarry.plans import PLANS
from tools.oracle_check import digest

SQL_KEYS = sorted(k for k, p in PLANS.items() if p.sql is not None)


@pytest.mark.parametrize("key", SQL_KEYS)
def test_plan_matches_oracle(spark, sf, duck, key):
    p = PLANS[key]
    df = p.fn(spark, sf)
    srows = [tuple(r) for r in df.collect()]
    rel = duck.sql(p.sql)
    dcols, drows = rel.columns, rel.fetchall()
    s = digest(df.columns, srows)
    d = digest(dcols, drows)
    assert s[0] == d[0], f"columns differ: {s[0]} vs {d[0]}"
    assert s[1] == d[1], f"row counts differ: {s[1]} vs {d[1]}"
    assert s[2] == d[2], f"values differ: {sorted(set(s[3]) - set(d[3]))[:3]} vs {sorted(set(d[3]) - set(s[3]))[:3]}"


def test_every_plan_has_doc():
    assert all(p.doc for p in PLANS.values())


def test_entry_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == ["mmsi", "start_time", "end_time", "record_count"]
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())
