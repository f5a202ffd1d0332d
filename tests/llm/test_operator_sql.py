"""Queries that have SQL, side by side on the smallest tables."""

import duckdb
import pytest

from revspine.llm.oracle import oracle_sql
from revspine.llm.queries import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got, want = queries()[name](spark, SF).toArrow(), con.sql(oracle_sql()[name]).to_arrow_table()
    columns = sorted(got.column_names)
    assert sorted(want.column_names) == columns
    assert {c: str(got.schema.field(c).type) for c in columns} == {c: str(want.schema.field(c).type) for c in columns}
    rows = lambda t: sorted((tuple(r[c] for c in columns) for r in t.to_pylist()), key=str)
    assert rows(got) == rows(want) and rows(got)


def test_every_operator_and_the_pipeline_are_registered():
    names = list(queries())
    assert [n.split("_")[0] for n in names] == [f"op{k}" for k in range(1, 14)] + ["pipeline"]
    assert set(oracle_sql()) <= set(names)
