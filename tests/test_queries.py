"""Every registered query against its reference SQL on the small test tables."""

import datetime
import decimal
import importlib
import math
import os
from collections import Counter

import pandas as pd
import pytest

import __spark_entry__ as entry

DATA = os.environ.get("GAVELSPARK_DATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for name in os.listdir(DATA):
        con.execute(f"create view {name.split('.')[0]} as select * from read_parquet('{DATA}/{name}')")
    return con


def plain(v):
    if hasattr(v, "tolist"):
        v = v.tolist()
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, (pd.Timestamp, datetime.date)):
        return str(pd.Timestamp(v))
    if isinstance(v, float):
        return round(v, 6)
    return float(v) if isinstance(v, int) and not isinstance(v, bool) else v


def rows(frame):
    return Counter(repr(tuple(plain(v) for v in r)) for r in frame[sorted(frame.columns)].itertuples(index=False, name=None))


CORE = sorted(n for m in entry.MODULES for n in importlib.import_module(m).QUERIES)


@pytest.mark.parametrize("name", sorted(n for n in entry.oracle_sql() if n in CORE))
def test_equals_reference_sql(spark, duck, name):
    mine = entry.queries()[name](spark, DATA).toPandas()
    theirs = duck.execute(entry.oracle_sql()[name]).df()
    assert sorted(mine.columns) == sorted(theirs.columns)
    assert rows(mine) == rows(theirs)


@pytest.mark.parametrize("name", [n for n in CORE if n not in entry.oracle_sql()])
def test_runs(spark, name):
    """What SQL cannot say runs to its end; its operators are tested against brute force elsewhere."""
    df = entry.queries()[name](spark, DATA)
    assert df.columns and df.count() >= 0


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1
