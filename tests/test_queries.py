"""Every registered query against its DuckDB oracle, and the entry smoke."""

import duckdb
import pytest

import __spark_entry__ as entry
from estate.plans.queries import QUERIES
from estate.sources.tables import TABLES
from tools.oracle_check import compare

from conftest import SF_SMALL

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(entry.queries())
    assert set(NAMES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    line, ok = compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], SF_SMALL)
    assert ok, line


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["pool_name", "extract_ts", "min_request_start_time", "max_start_time",
                          "extract_window_minutes", "extract_window_hours", "num_requests"]
    assert df.count() > 0
