"""Every registered query with a SQL twin gives the same rows on the small tables."""

from __future__ import annotations

import pytest

from check import normal, sort_key
from sortlane.catalog import QUERIES

CHECKED = [n for n, q in QUERIES.items() if q.sql is not None]


@pytest.mark.parametrize("name", CHECKED)
def test_matches_sql(spark, folder, duck, name):
    q = QUERIES[name]
    df = q.run(spark, folder)
    columns = sorted(df.columns)
    got = sorted((tuple(normal(r[c]) for c in columns) for r in df.collect()), key=sort_key)
    result = duck.execute(q.sql)
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    where = [names.index(c) for c in columns]
    want = sorted((tuple(normal(r[i]) for i in where) for r in result.fetchall()), key=sort_key)
    assert got == want


def test_entry_contract(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns == ["role", "industry", "n"]
