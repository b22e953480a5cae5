"""Every registered query against its SQL on the smallest tables."""

import math
import os

import duckdb
import pandas as pd
import pytest

from __spark_entry__ import oracle_sql
from cartoloom.plans import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{SF}/{t}.parquet"):
            con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(v):
    if v is None or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, str):
        return v
    return float(v) + 0.0  # one zero, whatever its sign


def rows(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted((tuple(plain(v) for v in r) for r in frame.itertuples(index=False, name=None)), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    got = QUERIES[name](spark, SF).toPandas()
    want = duck.execute(oracle_sql()[name]).fetch_df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
