import datetime as dt
import random

from pyspark.sql import functions as F

from gavelspark.operators.history import newest, type_two_merge
from gavelspark.operators.renames import biennium_label, counted_changes, name_terms, name_versions

SCHEMA = "source_id string, former_name string, legal_name string, boundary_biennium string, effective_start date, former_effective_end date, recorded_at timestamp"


def change(sid, former, legal, label, start=None, end=None, recorded=1):
    return (sid, former, legal, label, dt.date.fromisoformat(start) if start else None, dt.date.fromisoformat(end) if end else None, dt.datetime(2020, 1, recorded))


def test_merge_in_steps_equals_merge_at_once(spark):
    rng = random.Random(1)
    rows = [(f"k{rng.randint(0, 3)}", rng.choice(["a", "b", None, ""]), t) for t in range(60)]
    updates = spark.createDataFrame(rows, "k string, v string, t int")
    whole = sorted(map(tuple, type_two_merge(None, updates, ["k"], ["v"], "t").collect()), key=repr)
    dim = None
    for a in range(0, 60, 20):
        dim = type_two_merge(dim, updates.filter((F.col("t") >= a) & (F.col("t") < a + 20)), ["k"], ["v"], "t")
    assert sorted(map(tuple, dim.collect()), key=repr) == whole
    # Against a plain replay.
    expected = []
    for key in {k for k, _, _ in rows}:
        last = object()
        for _, v, t in sorted((r for r in rows if r[0] == key), key=lambda r: r[2]):
            if v != last:
                if expected and expected[-1][0] == key:
                    expected[-1][3] = t
                expected.append([key, v, t, None])
                last = v
    assert whole == sorted(map(tuple, expected), key=repr)


def test_merge_of_ties_repeats_and_nothing(spark):
    updates = spark.createDataFrame([("k", "a", 1), ("k", "a", 1), ("k", "b", 1), ("k", "c", None)], "k string, v string, t int")
    assert [tuple(r) for r in type_two_merge(None, updates, ["k"], ["v"], "t").collect()] == [("k", "b", 1, None)]
    assert type_two_merge(None, updates.limit(0), ["k"], ["v"], "t").count() == 0


def test_newest_is_one_row_per_key(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", None, "w")], "k string, t int, v string")
    assert sorted(map(tuple, newest(df, ["k"], "t").collect())) == [("a", 2, "z"), ("b", None, "w")]


def test_versions_of_names(spark):
    rows = [
        change("1", "A", "B", "2001-02"),
        change("1", "B", "C", "2003/04", recorded=1),
        change("1", "B", "D", "2003 - 2004", recorded=2),  # corrects the row above
        change("1", "E", "F", "2007-2008"),  # the hop D to E was never recorded
        change("2", "Ethics & Trade", "ETHICS, and  Trade", "2001-02"),  # typing only
        change("3", "A", "B", "nonsense"),
        change(None, "A", "B", "2001-02"),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted((r.source_id, r.name, r.valid_from, r.valid_to) for r in name_versions(df.union(df)).collect() if r.source_id == "1")
    assert got == [("1", "A", None, 2001), ("1", "B", 2001, 2003), ("1", "D", 2003, None), ("1", "E", None, 2007), ("1", "F", 2007, None)]
    rest = sorted((r.source_id, r.valid_from, r.valid_to) for r in name_versions(df).collect() if r.source_id != "1")
    assert rest == [("2", None, None), ("3", None, None)]
    assert name_versions(df.limit(0)).count() == 0


def test_same_name_again_after_an_unrecorded_hop(spark):
    df = spark.createDataFrame([change("1", "A", "B", "2001-02"), change("1", "C", "B", "2003-04")], SCHEMA)
    got = {(r.name, r.valid_from, r.valid_to) for r in name_versions(df).collect()}
    assert got == {("A", None, 2001), ("B", 2001, None), ("C", None, 2003), ("B", 2003, None)}


def test_terms(spark):
    df = spark.createDataFrame([change("1", "A", "B", "2001-02", "2001-01-01"), change("1", "B", "C", "2003-04", "2003-02-01", "2002-12-01")], SCHEMA)
    got = {(str(r["from"]), str(r["to"])) for r in name_terms(df).collect()}
    assert got == {("None", "2001-01-01"), ("2001-01-01", "2002-12-01"), ("2003-02-01", "None")}
    assert counted_changes(df).count() == 2


def test_label(spark):
    df = spark.createDataFrame([(1999,), (2013,), (None,)], "y int")
    assert [r[0] for r in df.select(biennium_label(F.col("y"))).collect()] == ["1999-00", "2013-14", None]


def test_late_updates_cut_closed_versions(spark):
    """Stored: A 2000 to 2005, B from 2005; a hole after 2010 of another key; a third key without updates."""
    dim = spark.createDataFrame([("k", "A", 2000, 2005), ("k", "B", 2005, None), ("h", "A", 2000, 2010), ("u", "A", 1990, None), ("u", "A", 1980, 1985)], "k string, v string, valid_from int, valid_to int")
    merge = lambda *rows: sorted((tuple(r) for r in type_two_merge(dim, spark.createDataFrame(list(rows), "k string, v string, t int"), ["k"], ["v"], "t").collect()), key=repr)
    same = [("u", "A", 1980, 1985), ("u", "A", 1990, None)]
    whole = [("k", "A", 2000, 2005), ("k", "B", 2005, None)]
    assert merge(("k", "C", 2003)) == sorted([("h", "A", 2000, 2010), ("k", "A", 2000, 2003), ("k", "C", 2003, 2005), ("k", "B", 2005, None), *same], key=repr)
    assert merge(("k", "A", 2003), ("k", "B", 2009), ("k", None, None), (None, "X", 2001)) == sorted([("h", "A", 2000, 2010), *whole, *same], key=repr)  # nothing new
    assert merge(("k", "C", 2005)) == sorted([("h", "A", 2000, 2010), ("k", "A", 2000, 2005), ("k", "C", 2005, None), *same], key=repr)  # replaces
    assert merge(("k", "B", 2003)) == sorted([("h", "A", 2000, 2010), ("k", "A", 2000, 2003), ("k", "B", 2003, None), *same], key=repr)  # earlier start
    assert merge(("k", "Z", 1999)) == sorted([("h", "A", 2000, 2010), ("k", "Z", 1999, 2000), *whole, *same], key=repr)
    assert merge(("h", "B", 2012), ("h", None, 2011)) == sorted([("h", "A", 2000, 2010), ("h", None, 2011, 2012), ("h", "B", 2012, None), *whole, *same], key=repr)
    assert merge() == sorted([("h", "A", 2000, 2010), *whole, *same], key=repr)


def test_late_updates_in_any_order_equal_a_replay_by_time(spark):
    """Distinct values at distinct times: the order of arrival makes no difference."""
    rng = random.Random(4)
    rows = [(f"k{i % 3}", f"v{i}", t) for i, t in enumerate(rng.sample(range(200), 40))]
    whole = sorted(map(tuple, type_two_merge(None, spark.createDataFrame(rows, "k string, v string, t int"), ["k"], ["v"], "t").collect()), key=repr)
    dim = None
    for part in (rows[:15], rows[15:20], rows[20:]):
        dim = type_two_merge(dim, spark.createDataFrame(part, "k string, v string, t int"), ["k"], ["v"], "t")
    assert sorted(map(tuple, dim.collect()), key=repr) == whole
