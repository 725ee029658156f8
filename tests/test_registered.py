"""Every registered query against DuckDB on the same tables."""

import os
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from subtide.contract.oracle import ORACLE
from subtide.contract.registry import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def as_multiset(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(repr(tuple(row[i] for i in order)) for row in rows)


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_sql(spark, duck, name):
    df = queries()[name](spark, SF_DIR)
    result = duck.execute(oracle_sql()[name])
    expected = as_multiset([c[0] for c in result.description], result.fetchall())
    actual = as_multiset(df.columns, [tuple(row) for row in df.collect()])
    assert actual == expected
    assert actual[1]


def test_every_query_has_sql():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(queries()) and set(ORACLE) <= set(oracle_sql())


def test_entry(spark):
    rows = entry(spark).collect()
    assert [r.week_start for r in rows] == sorted(r.week_start for r in rows)
    assert rows


def test_the_entry_is_imported_before_a_session_exists():
    done = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; assert set(e.queries()) >= set(e.oracle_sql())"], cwd=Path(__file__).parents[1], capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
