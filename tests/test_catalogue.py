"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import os
from pathlib import Path

import duckdb
import pytest

from gazetta.plans import catalogue

DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in Path(DIR).glob("*.parquet"):
        con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def plain(rows):
    return sorted(repr(tuple(round(x, 5) if isinstance(x, float) else x for x in r)) for r in rows)


@pytest.mark.parametrize("name", [*catalogue.QUERIES])
def test_query(spark, duck, name):
    df = catalogue.QUERIES[name](spark, DIR)
    columns = sorted(df.columns)
    rows = plain(df.select(*columns).collect())
    if name in catalogue.SQL:
        assert rows == plain(duck.sql(f"SELECT {', '.join(columns)} FROM ({catalogue.SQL[name]})").fetchall())
    else:
        assert rows


def test_entry(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).columns
