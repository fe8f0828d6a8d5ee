"""Every registered query against its DuckDB oracle at sf0.001 (row count,
column names, order-insensitive values) - the driver's check in small."""

import duckdb
import pytest

import __spark_entry__ as entry
from eventide.sources.tables import TABLES
from tools.check import digest

from conftest import SF0001

QUERIES = entry.queries()
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle_or_is_listed():
    # the optional training-data queries are tested in a folder of their own
    own = {n for n in QUERIES if n == "pipeline" or n.startswith("op")}
    no_oracle = set(QUERIES) - set(ORACLES) - own
    assert not no_oracle, no_oracle
    assert set(ORACLES) <= set(QUERIES)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["window_end", "item_id", "cnt", "rank"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(n for n in ORACLES if not n.startswith("op")))
def test_query_matches_oracle(spark, con, name):
    got = digest(QUERIES[name](spark, SF0001).toPandas())
    exp = digest(con.sql(ORACLES[name]).df())
    assert got == exp
