"""Every query that has SQL, against that SQL on the smallest data folder."""

import duckdb
import pandas as pd
import pytest

from annoframe import registry

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if v is None or v is pd.NA or v != v:
        return "null"
    return f"{v:.6g}" if isinstance(v, float) else str(v)


def rows(frame):
    return sorted(tuple(plain(v) for v in r) for r in frame[sorted(frame.columns)].itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_matches_sql(spark, duck, name):
    got, want = registry.QUERIES[name](spark, FOLDER).toPandas(), duck.sql(registry.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    numbers = {c for c in want.columns if pd.api.types.is_numeric_dtype(want[c]) and not pd.api.types.is_bool_dtype(want[c])}
    for c in numbers:
        got[c], want[c] = got[c].astype("float64"), want[c].astype("float64")
    assert rows(got) == rows(want)
