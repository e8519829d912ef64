import datetime as dt
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from gavelspark.operators.intervals import DisjointIntervals, periods_and_gaps

DAY0 = dt.date(1970, 1, 1)


def brute(pairs):
    days = sorted({d for lo, hi in pairs for d in range(lo, hi)})
    out = []
    for d in days:
        if out and out[-1][1] == d:
            out[-1][1] = d + 1
        else:
            out.append([d, d + 1])
    return [tuple(p) for p in out]


@given(st.lists(st.tuples(st.integers(-60, 60), st.integers(-60, 60)), max_size=40))
@settings(max_examples=200, deadline=None)
def test_map_equals_brute_force(pairs):
    own = DisjointIntervals()
    for lo, hi in pairs:
        own.insert(lo, hi)
    assert own.periods() == brute(pairs)
    assert own.gaps() == [(a[1], b[0]) for a, b in zip(own.periods(), own.periods()[1:])]


def day(n):
    return None if n is None else DAY0 + dt.timedelta(days=n)


def test_batch_equals_brute_force_with_a_hot_entity(spark):
    rng = random.Random(3)
    rows = []
    for entity, n in (("hot", 900), ("a", 40), ("b", 5), (None, 3)):
        for _ in range(n):
            lo = rng.randint(-9000, 20000)
            rows.append((entity, lo, lo + rng.randint(-2, 40)))
    rows += rows[:50]  # repeats
    df = spark.createDataFrame([(e, day(a), day(b), "x") for e, a, b in rows], "who string, f date, t date, entity string")
    got = periods_and_gaps(df, "who", "f", "t").collect()
    for entity in ("hot", "a", "b", None):
        own = DisjointIntervals()
        for e, a, b in rows:
            if e == entity:
                own.insert(a, b)
        mine = sorted(((r.from_date - DAY0).days, (r.to_date - DAY0).days) for r in got if r.entity == entity and r.kind == "period")
        gaps = sorted(((r.from_date - DAY0).days, (r.to_date - DAY0).days) for r in got if r.entity == entity and r.kind == "gap")
        assert mine == own.periods() and gaps == own.gaps()


def test_open_ends_empty_and_reversed(spark):
    rows = [("x", None, day(10)), ("x", day(20), None), ("x", day(30), day(40)), ("y", day(5), day(5)), ("y", day(9), day(2)), ("z", None, None)]
    df = spark.createDataFrame(rows, "who string, f date, t date")
    got = {(r.entity, r.kind, r.from_date, r.to_date) for r in periods_and_gaps(df, "who", "f", "t").collect()}
    assert got == {("x", "period", None, day(10)), ("x", "gap", day(10), day(20)), ("x", "period", day(20), None), ("z", "period", None, None)}
    assert periods_and_gaps(df.limit(0), "who", "f", "t").count() == 0


def test_stream_equals_batch(spark, tmp_path):
    from gavelspark.streaming.intervals import stream_periods

    rows = [("a", day(0), day(5)), ("a", day(9), day(12)), ("b", day(1), day(2)), ("a", day(4), day(9))]
    schema = "who string, f date, t date"
    for i, row in enumerate(rows):
        spark.createDataFrame([row], schema).coalesce(1).write.parquet(str(tmp_path / f"in/{i}"))
    out = {}
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in/*"))

    def keep(batch, _):
        for e in {r.entity for r in batch.collect()}:
            out[e] = sorted((r.kind, r.lo, r.hi) for r in batch.collect() if r.entity == e)

    query = stream_periods(stream, "who", "f", "t").writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", str(tmp_path / "c")).start()
    query.processAllAvailable()
    query.stop()
    assert out == {"a": [("period", 0, 12)], "b": [("period", 1, 2)]}
