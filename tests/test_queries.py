"""Every registered query of the library against its DuckDB text, at the smallest scale."""

import datetime
import decimal

import duckdb
import pandas as pd
import pytest

from kinelake import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def duck(sf):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def plain(v):
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
        return None
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, (decimal.Decimal, float, int)) and not isinstance(v, bool):
        return float(f"{float(v):.9g}")  # nullable integers come as either kind
    if isinstance(v, (datetime.date, pd.Timestamp)):
        return str(pd.Timestamp(v))
    return v


def rows(df, columns):
    return sorted((tuple(plain(v) for v in r) for r in df[columns].astype(object).itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_oracle(spark, sf, duck, name):
    want = duck.execute(registry.ORACLES[name]).fetchdf()
    got = registry.QUERIES[name](spark, sf).toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got, sorted(got.columns)) == rows(want, sorted(got.columns))


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_query_without_oracle_runs(spark, sf, name):
    assert registry.QUERIES[name](spark, sf).count() > 0
