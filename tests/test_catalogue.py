import importlib
import math
import os

import duckdb
import pandas as pd
import pytest
from pyspark.sql import DataFrame

from sedimenta.plans import catalogue

QUERIES, SQL = catalogue.queries(), catalogue.oracle_sql()


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v) or v is pd.NaT:
        return None
    return round(float(v), 9) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)


@pytest.fixture(scope="module")
def tables(data):
    con = duckdb.connect()
    for f in os.listdir(data):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{data}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, data, tables, name):
    df = QUERIES[name](spark, data)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    if name not in SQL:
        assert got
        return
    r = tables.execute(SQL[name])
    names = [d[0] for d in r.description]
    assert sorted(names) == columns
    assert got == sorted((tuple(plain(x[names.index(c)]) for c in columns) for x in r.fetchall()), key=repr)


def test_entry_point(spark, data):
    entry = importlib.import_module("__spark_entry__")
    assert isinstance(entry.entry(spark), DataFrame)
    assert set(catalogue.queries()) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
