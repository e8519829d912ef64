"""The interval map as keyed state of a stream."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gavelspark.operators.intervals import FOREVER, NEVER, DisjointIntervals

OUTPUT = "entity string, kind string, lo int, hi int"
STATE = "starts array<int>, ends array<int>"


def _update(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    own = DisjointIntervals(*state.get) if state.exists else DisjointIntervals()
    for frame in frames:
        for lo, hi in zip(frame.lo, frame.hi):
            own.insert(int(lo), int(hi))
    state.update((own.starts, own.ends))
    rows = [(key[0], "period", lo, hi) for lo, hi in own.periods()] + [(key[0], "gap", lo, hi) for lo, hi in own.gaps()]
    yield pd.DataFrame(rows, columns=["entity", "kind", "lo", "hi"])


def stream_periods(intervals: DataFrame, entity: str, start: str, end: str) -> DataFrame:
    """Per micro-batch the whole current periods and gaps of every entity that got an interval
    (day numbers, half-open).  State per entity is bounded by the calendar.  A null start or
    end is unbounded; empty and reversed intervals change nothing."""
    day = lambda name, otherwise: F.coalesce(F.datediff(F.col(name), F.lit("1970-01-01").cast("date")), F.lit(otherwise))
    days = intervals.select(F.col(entity).cast("string").alias("entity"), day(start, NEVER).alias("lo"), day(end, FOREVER).alias("hi"))
    return days.groupBy("entity").applyInPandasWithState(_update, OUTPUT, STATE, "update", "NoTimeout")


def day_text(number: str, shift: int = 0) -> Column:
    """ISO date of a day number, moved by ``shift`` days; '' for one without bound."""
    bounded = (F.col(number) > NEVER) & (F.col(number) < FOREVER)
    return F.when(bounded, F.date_format(F.date_add(F.lit("1970-01-01").cast("date"), F.col(number) + shift), "yyyy-MM-dd")).otherwise("")
