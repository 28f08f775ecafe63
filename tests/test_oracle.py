"""Every catalog query against its DuckDB oracle (row count, columns, values)."""

import duckdb
import pytest

import __spark_entry__ as E
from sheetcraft.plans.catalog import QUERIES
from tools.oracle_check import TABLES, rows_of, types_match

from .conftest import SF_SMALL

NAMES = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    missing = set(QUERIES) - set(E.oracle_sql())
    assert not missing, missing


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    got = sdf.toArrow()
    rel = con.sql(E.oracle_sql()[name])
    sschema = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    assert not types_match(sschema, dict(zip(rel.columns, [str(t) for t in rel.types])))
    want = rel.arrow()
    want = want.read_all() if hasattr(want, "read_all") else want
    assert sorted(got.column_names) == sorted(want.column_names)
    assert got.num_rows == want.num_rows
    assert rows_of(got) == rows_of(want)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert df.columns[:3] == ["referral_id", "action_ts", "search_no"]
