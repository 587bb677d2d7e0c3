"""Every rule query gives the rows of its SQL on the small tables."""

import pandas as pd
import pytest

from skirmish.plans.queries import ORACLE_SQL, QUERIES

DATA = "/root/testdata/sf0.001"


def rows(frame):
    plain = lambda v: None if v is None or v is pd.NA or v != v else float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
    return sorted((tuple(plain(v) for v in r) for r in frame[sorted(frame.columns)].astype(object).itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows_as_sql(spark, duck, name):
    got, want = QUERIES[name](spark, DATA).toPandas(), duck.sql(ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_entry_and_contract(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 1000
    assert set(ORACLE_SQL) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_damage_plan_has_no_shuffle_and_no_python(spark):
    plan = QUERIES["calculate_damage"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
