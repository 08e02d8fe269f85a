"""Every registered query against its DuckDB oracle on the smallest test data."""

import collections
import math

import duckdb
import pytest

import __spark_entry__ as entry
from intakeyard.sources.tables import TABLES

SF = "/root/testdata/sf0.001"


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else f"{v:.6g}"
    return str(v)


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return collections.Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    cur = con.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _bag(df.columns, [tuple(r) for r in df.collect()]) == _bag(dcols, cur.fetchall())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["line_no", "rule"] and df.count() > 0
