"""Every registered query against its DuckDB oracle at sf0.001, plus entry()."""

import duckdb
import pytest

import __spark_entry__ as entry

from conftest import SF_SMALL

import sys, os  # noqa: E401
sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                                "tools"))
from check_oracle import TABLES, rows_of  # noqa: E402

ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(set(entry.queries()) & set(ORACLE)))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    assert name in ORACLE, f"{name} has no oracle"
    rel = con.execute(ORACLE[name])
    ocols = [c[0] for c in rel.description]
    assert sorted(df.columns) == sorted(ocols)
    assert rows_of(df.columns, srows) == rows_of(ocols, rel.fetchall())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == entry.entry(spark).columns


def test_every_catalogue_query_has_an_oracle():
    from sluice.plans import catalog
    assert set(catalog.QUERIES) == set(catalog.ORACLE)
