"""Every registered query against DuckDB on the same tables."""

import math
import os
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
import __spark_entry__ as entry_module  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
# The text operators have their own tests.
ORACLES = {k: v for k, v in entry_module.oracle_sql().items() if k in entry_module.catalog.queries()}
QUERIES = {k: v for k, v in entry_module.queries().items() if k in entry_module.catalog.queries()}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(v):
        return "NaN" if isinstance(v, float) and math.isnan(v) else v

    return sorted(repr([value(r[i]) for i in order]) for r in rows)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_oracle(spark, duck, name):
    got = QUERIES[name](spark, SF_DIR)
    want = duck.execute(ORACLES[name])
    columns = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(columns)
    want_rows = want.fetchall()
    got_rows = got.collect()
    assert len(got_rows) == len(want_rows)
    assert bag(got.columns, got_rows) == bag(columns, want_rows)


def test_entry(spark):
    got = dict(entry_module.entry(spark).collect())
    assert got == {
        "1-URGENT": 216,
        "2-HIGH": 242,
        "3-MEDIUM": 271,
        "4-NOT SPECIFIED": 245,
        "5-LOW": 228,
    }
