"""Every query against its DuckDB SQL over the shared tables."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = os.environ.get("TICKLOOM_TEST_SF", "/root/testdata/sf0.01")
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(file)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{file}'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool) or not isinstance(value, (int, float)):
        return str(value)
    return float(value) + 0.0


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    shown = [tuple(plain(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(shown, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = table(df.columns, [tuple(r) for r in df.collect()])
    cursor = duck.execute(ORACLES[name])
    want = table([c[0] for c in cursor.description], cursor.fetchall())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]


def test_queries_without_sql_return_rows(spark):
    for name in sorted(set(QUERIES) - set(ORACLES)):
        assert QUERIES[name](spark, SF).count() > 0


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
