"""Every query with SQL gives the same rows in DuckDB."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_module

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"create view {name} as select * from '{path}'")
    return connection


def as_rows(frame: pd.DataFrame) -> list[tuple]:
    ordered = frame[sorted(frame.columns)].astype(object)
    return sorted(
        tuple("" if pd.isna(value) else repr(value) for value in row)
        for row in ordered.itertuples(index=False, name=None)
    )


@pytest.mark.parametrize("name", sorted(entry_module.oracle_sql()))
def test_query_matches_sql(spark, database, name):
    actual = entry_module.queries()[name](spark, DATA).toPandas()
    expected = database.execute(entry_module.oracle_sql()[name]).fetch_df()
    assert sorted(actual.columns) == sorted(expected.columns)
    assert as_rows(actual) == as_rows(expected)


def test_every_oracle_has_a_query():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_entry_returns_rows(spark):
    assert entry_module.entry(spark).columns == ["weather_class", "count"]


@pytest.mark.parametrize("left_out", range(8))
def test_sql_of_weather_classes_finds_a_missing_rule(spark, database, monkeypatch, left_out):
    """The SQL has constants of its own: without any one of the library's rules the two differ."""
    from tripweave.functions import weather

    rules = weather.WEATHER_CLASS_PATTERNS
    assert len(rules) == 8
    monkeypatch.setattr(weather, "WEATHER_CLASS_PATTERNS", (*rules[:left_out], *rules[left_out + 1:]))
    actual = entry_module.queries()["classify_weather"](spark, DATA).toPandas()
    expected = database.execute(entry_module.oracle_sql()["classify_weather"]).fetch_df()
    assert as_rows(actual) != as_rows(expected)
