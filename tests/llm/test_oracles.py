"""The training-data queries that SQL can express, against their SQL on the given tables."""

import os

import pandas as pd
import pytest

from factspan.llm import queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the given tables are not here")


def plain(v):
    v = v.tolist() if hasattr(v, "tolist") else v
    if v is None or v is pd.NA or isinstance(v, float) and v != v:  # pandas has a null of its own for each type
        return None
    return tuple(map(plain, v)) if isinstance(v, list) else (int(v) if v == int(v) else round(v, 6)) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_same_rows_as_sql(spark, name):
    import duckdb

    c = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark", "conversations"):
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got, want = queries.queries()[name](spark, SF).toPandas(), c.sql(queries.oracle_sql()[name]).df()
    rows = lambda df: sorted(repr([plain(v) for v in r]) for r in df[sorted(df.columns)].itertuples(index=False))
    assert sorted(got.columns) == sorted(want.columns) and len(got) > 0 and rows(got) == rows(want)
