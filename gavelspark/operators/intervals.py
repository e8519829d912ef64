"""Continuous periods and gaps of overlapping intervals per entity.

The state of one key is an ordered map of disjoint half-open intervals
(:class:`DisjointIntervals`); intervals come in no order, and every insertion finds
the overlapped ones by binary search, merges them and updates the gaps next to them.
The same state serves the batch operator (:func:`periods_and_gaps`) and the streaming
one (:func:`gavelspark.streaming.intervals.stream_periods`).

No task ever holds an unbounded group.  Intervals are cut at the borders of fixed
calendar buckets (touching pieces merge again, so cutting loses nothing) and repeats
are removed map-side, so a group (entity, bucket) holds at most ``BUCKET_DAYS**2 / 2``
different pieces however many rows an entity has.  The last step stitches the disjoint
pieces of an entity, of which the calendar bounds the number (at most
``BUCKET_DAYS / 2`` per bucket).
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Days of one calendar bucket (four years).
BUCKET_DAYS = 1461
#: Day numbers that stand for "no beginning" and "no end".
NEVER, FOREVER = -(2**31) + 1, 2**31 - 2


class DisjointIntervals:
    """Ordered disjoint half-open intervals [start, end) and the gaps between them."""

    __slots__ = ("starts", "ends")

    def __init__(self, starts: list[int] | None = None, ends: list[int] | None = None) -> None:
        self.starts: list[int] = list(starts or [])
        self.ends: list[int] = list(ends or [])

    def insert(self, start: int, end: int) -> None:
        """Adds one interval; empty and reversed ones change nothing."""
        if end <= start:
            return
        first = bisect_left(self.ends, start)
        after = bisect_right(self.starts, end)
        if first < after:
            start = min(start, self.starts[first])
            end = max(end, self.ends[after - 1])
        self.starts[first:after] = [start]
        self.ends[first:after] = [end]

    def periods(self) -> list[tuple[int, int]]:
        return list(zip(self.starts, self.ends))

    def gaps(self) -> list[tuple[int, int]]:
        """The space between neighbouring periods."""
        return list(zip(self.ends[:-1], self.starts[1:]))


def packed(lo: Column, hi: Column) -> Column:
    """Both ends in one number; sets of numbers are smaller than sets of structs."""
    return F.shiftleft(lo.cast("bigint"), 32) + (hi.cast("bigint") - NEVER)


def _filled(values) -> DisjointIntervals:
    """The map of one key after all its intervals, in the order in which they come."""
    state = DisjointIntervals()
    for v in values:
        state.insert(int(v) >> 32, (int(v) & 0xFFFFFFFF) + NEVER)
    return state


@F.pandas_udf(T.ArrayType(T.LongType()))
def _merged(values: pd.Series) -> pd.Series:
    return values.map(lambda v: [(lo << 32) + (hi - NEVER) for lo, hi in _filled(v).periods()])


@F.pandas_udf(T.ArrayType(T.StringType()))
def _stitched(values: pd.Series) -> pd.Series:
    """Periods and gaps as texts "kind lo hi"."""

    def of(v) -> list[str]:
        state = _filled(v)
        return [f"period {lo} {hi}" for lo, hi in state.periods()] + [f"gap {lo} {hi}" for lo, hi in state.gaps()]

    return values.map(of)


def periods_and_gaps(intervals: DataFrame, entity: str, start: str, end: str, within: list[str] | None = None) -> DataFrame:
    """Continuous periods and the gaps between them, per entity.

    ``start`` and ``end`` are dates of half-open intervals [start, end); a null
    start has no beginning, a null end is open.  Intervals that overlap or touch
    are one period; empty and reversed intervals do not count; repeats change
    nothing; a null entity is an entity of its own; an empty table gives no rows.
    ``within`` names further columns that part entities; others are ignored.

    Returns ``within``, ``entity string, kind {period, gap}, from_date date, to_date
    date`` (half-open; null = unbounded).
    """
    keys = [*(within or []), "entity"]
    day = lambda name, otherwise: F.coalesce(F.datediff(F.col(name), F.lit("1970-01-01").cast("date")), F.lit(otherwise))
    days = intervals.select(*(within or []), F.col(entity).cast("string").alias("entity"), day(start, NEVER).alias("lo"), day(end, FOREVER).alias("hi")).filter("lo < hi")
    # Unbounded intervals, of which an entity has few different ones, are no bucket's (null).
    bounded = (F.col("lo") > NEVER) & (F.col("hi") < FOREVER)
    buckets = F.sequence(F.expr(f"floor(lo / {BUCKET_DAYS})"), F.expr(f"floor((hi - 1) / {BUCKET_DAYS})"))
    cut = days.select(*keys, "lo", "hi", F.explode(F.when(bounded, buckets).otherwise(F.array(F.lit(None).cast("bigint")))).alias("bucket"))
    # Of those without beginning only the latest end, of those without end the earliest start matters.
    low = F.when(F.col("bucket").isNull(), F.col("lo")).otherwise(F.greatest("lo", (F.col("bucket") * BUCKET_DAYS).cast("int")))
    high = F.when(F.col("bucket").isNull(), F.col("hi")).otherwise(F.least("hi", ((F.col("bucket") + 1) * BUCKET_DAYS).cast("int")))
    grouped = cut.groupBy(*keys, "bucket").agg(F.collect_set(packed(low, high)).alias("own"))
    pieces = grouped.select(*keys, F.explode(_merged("own")).alias("piece"))
    whole = pieces.groupBy(*keys).agg(F.collect_list("piece").alias("own")).select(*keys, F.explode(_stitched("own")).alias("row")).withColumn("r", F.split("row", " "))
    date = lambda k, none: F.when(F.col("r")[k].cast("int") != none, F.date_add(F.lit("1970-01-01").cast("date"), F.col("r")[k].cast("int")))
    return whole.select(*keys, F.col("r")[0].alias("kind"), date(1, NEVER).alias("from_date"), date(2, FOREVER).alias("to_date"))
