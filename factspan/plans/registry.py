"""Where queries register under their names, with the same as SQL for DuckDB."""

from __future__ import annotations

from factspan.plans import testdata

QUERIES, SQL = {}, {}


def query(sql: str | None):
    """Register a function of (spark, read), where read(name) is a table, under its own name."""

    def add(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(spark, lambda name: testdata.table(spark, sf_dir, name))
        if sql:
            SQL[f.__name__] = sql
        return f

    return add
