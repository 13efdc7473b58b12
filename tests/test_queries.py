"""Every query against its SQL in DuckDB."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

from tidemark.plans.registry import ORACLES, QUERIES


def rows_of(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(round(r[i], 6) if isinstance(r[i], float) else r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    found = duck.execute(ORACLES[name])
    columns = [c[0] for c in found.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.collect(), df.columns) == rows_of(found.fetchall(), columns)


def test_entry(spark, sf):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
