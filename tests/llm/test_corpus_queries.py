"""The corpus queries against their reference SQL on the small test tables."""

import os
from collections import Counter

import pandas as pd
import pytest

from gavelspark.llm import queries as Q

DATA = os.environ.get("GAVELSPARK_DATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def plain(v):
    return None if pd.isna(v) else round(float(v), 6)


@pytest.mark.parametrize("name", sorted(Q.ORACLE))
def test_equals_reference_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for file in os.listdir(DATA):
        con.execute(f"create view {file.split('.')[0]} as select * from read_parquet('{DATA}/{file}')")
    mine, theirs = Q.QUERIES[name](spark, DATA).toPandas(), con.execute(Q.ORACLE[name]).df()
    assert sorted(mine.columns) == sorted(theirs.columns)
    rows = lambda f: Counter(tuple(plain(v) for v in r) for r in f[sorted(f.columns)].itertuples(index=False, name=None))
    assert rows(mine) == rows(theirs)


def test_links_agree(spark):
    """The classes of p3 and its pairs say the same."""
    classes = Q.p3_classes(spark, DATA).collect()
    pairs = {tuple(r) for r in Q.p3_found(spark, DATA).collect()}
    by_class: dict = {}
    for r in classes:
        by_class.setdefault((r.source, r["class"]), []).append(r.mention_id)
    assert pairs == {(a, b) for ids in by_class.values() for a in ids for b in ids if a < b}
    assert {r.mention_id: r.links for r in classes} == {i: len(ids) - 1 for ids in by_class.values() for i in ids}
