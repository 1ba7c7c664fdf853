"""Every query of the catalogue against its SQL, on the smallest given tables."""

import os

import pandas as pd
import pytest

from factspan.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the given tables are not here")


def plain(v):
    if v is None or v is pd.NaT or v is pd.NA or isinstance(v, float) and v != v:
        return None
    v = v.tolist() if hasattr(v, "tolist") else v
    if isinstance(v, list | tuple):
        return tuple(map(plain, v))
    if isinstance(v, float):
        return int(v) if v == int(v) else round(v, 6)
    return v


def rows(df):
    return sorted(repr([plain(v) for v in r]) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    import duckdb

    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_same_rows_as_sql(spark, duck, name):
    got, want = catalog.queries()[name](spark, SF).toPandas(), duck.sql(catalog.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_entry_has_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_current_fact_plan_prunes_and_limits_early(spark):
    plan = catalog.queries()["current_fact_at"](spark, SF)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "BroadcastHashJoin" in plan and "props" not in plan.split("== Physical Plan ==")[1]
