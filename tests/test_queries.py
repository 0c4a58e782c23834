"""Every registered query with SQL against DuckDB, on the smallest tables."""

import glob
import os

import duckdb
import pytest

from terraloom.plans import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


def plain(value):
    if value is None or str(value) in ("nan", "NaN", "NaT", "<NA>"):
        return "~"
    if isinstance(value, bool) or str(value) in ("True", "False"):
        return str(bool(value))
    if hasattr(value, "year"):
        return str(value)[:10]
    try:
        return f"{float(value):.6g}"
    except (TypeError, ValueError):
        return str(value)


def rows(frame):
    columns = sorted(frame.columns)
    return columns, sorted(tuple(plain(v) for v in r) for r in frame[columns].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, db, name):
    got, want = QUERIES[name](spark, FOLDER).toPandas(), db.execute(ORACLES[name]).df()
    assert rows(got) == rows(want)
