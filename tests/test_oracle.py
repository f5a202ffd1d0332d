"""Every registered query against its DuckDB oracle on the smallest tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from __spark_entry__ import entry  # noqa: E402
from oracle_check import TABLES, _rows  # noqa: E402

from revspine.plans.registry import oracle_sql, queries  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_oracle():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_oracle(spark, con, name):
    s_tab = queries()[name](spark, SF).toArrow()
    d_tab = con.sql(oracle_sql()[name]).to_arrow_table()
    s_types = {f.name: str(f.type) for f in s_tab.schema}
    d_types = {f.name: str(f.type) for f in d_tab.schema}
    assert s_types == d_types  # same column names and Arrow types
    cols = sorted(s_types)
    srows, drows = s_tab.to_pylist(), d_tab.to_pylist()
    assert len(srows) == len(drows)
    assert _rows(srows, cols) == _rows(drows, cols)


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["month", "active_subscriptions", "active_customers", "mrr_amount"]
    assert df.count() > 0
