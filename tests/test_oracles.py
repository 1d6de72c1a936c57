"""Every query with an oracle against DuckDB on the smallest tables."""

import glob
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from leafpress.jobs import registry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return c


def rows(frame: pd.DataFrame) -> list:
    frame = frame[sorted(frame.columns)]
    cell = lambda v: None if pd.isna(v) else v if isinstance(v, str) else float(v)
    return sorted((tuple(map(cell, r)) for r in frame.itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", sorted(registry.oracles()))
def test_same_rows(spark, duck, name):
    ours, theirs = registry.queries()[name](spark, SF).toPandas(), duck.execute(registry.oracles()[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours) == rows(theirs)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
