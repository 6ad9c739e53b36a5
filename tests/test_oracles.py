"""Every query with SQL equals DuckDB on the same files; the others return rows."""

import os

import duckdb
import pandas as pd
import pytest

from labelwright.plans import ORACLES, QUERIES
from labelwright.sources.scratch import discard

TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def db(sf_dir):
    con = duckdb.connect()
    for file in os.listdir(sf_dir):
        name = file.removesuffix(".parquet")
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{file}')")
    return con


def normal(frame):
    frame = frame[sorted(frame.columns)]
    show = lambda v: "null" if v is None or v is pd.NA or v != v else f"{v:.6f}" if isinstance(v, float) else str(v)
    return sorted(tuple(show(v) for v in row) for row in frame.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, db, sf_dir, name):
    built = QUERIES[name](spark, sf_dir)
    ours = built.toPandas()
    theirs = db.sql(ORACLES[name])
    assert {c: TYPES[t] for c, t in built.dtypes} == dict(
        zip(theirs.columns, [str(t) for t in theirs.types])
    )
    assert normal(ours) == normal(theirs.df())
    assert len(ours) > 0
    discard(spark)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_returns_rows(spark, sf_dir, name):
    rows = QUERIES[name](spark, sf_dir).count()
    # A forest that has seen the labels may well agree with all of so few rows.
    assert rows > 0 or name == "confidence_suspects"
    discard(spark)
