"""Every query with SQL gives what DuckDB gives on the smallest tables."""

from decimal import Decimal

import duckdb
import pandas as pd
import pytest

from wayline.plans import registry

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    if value is None or value is pd.NaT or value is pd.NA:
        return "null"
    if isinstance(value, bool) or type(value).__name__ == "bool":
        return str(bool(value))
    if isinstance(value, float | Decimal):
        return "null" if value != value else f"{float(value):.6g}"
    return str(value) if not hasattr(value, "item") else plain(value.item())


def rows(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(tuple(map(plain, r)) for r in frame.itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DIR}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_same_rows_as_sql(spark, duck, name):
    got, want = registry.QUERIES[name](spark, DIR).toPandas(), duck.execute(registry.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
