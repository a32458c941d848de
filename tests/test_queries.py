"""Every registered query against its SQL statement, on the smallest tables."""

import __spark_entry__ as entry
import duckdb
import pandas as pd
import pytest
from conftest import SMALL

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return connection


def comparable(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for c in frame.columns:
        if pd.api.types.is_numeric_dtype(frame[c].dtype):
            frame[c] = frame[c].astype("float64").round(6)
        else:
            frame[c] = frame[c].astype(object).where(frame[c].notna(), "null").astype(str)
    return frame.sort_values(list(frame.columns)).reset_index(drop=True)


def test_every_statement_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry_runs_the_rules(spark):
    assert entry.entry(spark).count() == 30


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    found = QUERIES[name](spark, SMALL)
    if name in SQL:
        expected = comparable(duck.execute(SQL[name]).df())
        pd.testing.assert_frame_equal(comparable(found.toPandas()), expected, check_dtype=False)
    else:
        assert found.count() > 0
