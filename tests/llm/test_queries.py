"""Queries with SQL equal DuckDB on the same files; every operator is registered."""

import os

import duckdb
import pytest

from labelwright.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for file in os.listdir(sf_dir):
        con.execute(f"create view {file.removesuffix('.parquet')} as select * from read_parquet('{sf_dir}/{file}')")
    ours = QUERIES[name](spark, sf_dir)
    theirs = con.sql(ORACLES[name])
    assert sorted(ours.columns) == sorted(theirs.columns)
    got = sorted(tuple(r) for r in ours.select(*theirs.columns).collect())
    assert got == sorted(theirs.fetchall())


def test_all_operators_are_registered():
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in QUERIES) == 1
    assert "pipeline" in QUERIES
