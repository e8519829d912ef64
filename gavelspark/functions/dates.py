"""Biennia, election calendar and dates of mixed precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gavelspark.operators.renames import biennium_label

__all__ = ["biennium_label"]


def parse_biennium(label: Column) -> Column:
    """struct(start, end) of YYYY-YY; the century rolls when the suffix is smaller; a bad label raises."""
    shape = r"^(\d{4})-(\d{2})$"
    start, short = F.regexp_extract(label, shape, 1).try_cast("int"), F.regexp_extract(label, shape, 2).try_cast("int")
    end = start - start % 100 + short + F.when(short < start % 100, 100).otherwise(0)
    return F.when(label.rlike(shape), F.struct(start.alias("start"), end.alias("end"))).when(label.isNotNull(), F.raise_error(F.concat(F.lit("bad biennium "), label)).cast("struct<start:int,end:int>"))


def biennium_start_of(day: Column) -> Column:
    """The odd year that begins the biennium of a date."""
    return F.year(day) - F.when(F.year(day) % 2 == 0, 1).otherwise(0)


def biennium_of(day: Column) -> Column:
    return biennium_label(biennium_start_of(day))


def start_date(label: Column) -> Column:
    return F.make_date(F.substring(label, 1, 4).cast("int"), F.lit(1), F.lit(1))


def previous_biennium(label: Column) -> Column:
    return biennium_label(F.substring(label, 1, 4).cast("int") - 2)


def bienniums_between(first: Column, last: Column) -> Column:
    """Labels from one biennium to another, inclusive; an inverted range raises."""
    a, b = F.substring(first, 1, 4).cast("int"), F.substring(last, 1, 4).cast("int")
    years = F.when(a <= b, F.sequence(a, b, F.lit(2))).otherwise(F.raise_error(F.lit("inverted range")).cast("array<int>"))
    return F.transform(years, biennium_label)


def biennium_window(label: Column) -> Column:
    start = F.substring(label, 1, 4).cast("int")
    zero = F.lit(0)
    return F.struct(
        F.make_timestamp(start, F.lit(1), F.lit(1), zero, zero, zero).alias("from"),
        F.make_timestamp(start + 1, F.lit(12), F.lit(31), F.lit(23), F.lit(59), F.lit(59)).alias("to"),
    )


def election_year(start: Column) -> Column:
    """The even year in which a biennium's members are elected."""
    return start - 1


def general_election_date(year: Column) -> Column:
    """The Tuesday after November's first Monday."""
    return F.date_add(F.next_day(F.make_date(year, F.lit(10), F.lit(31)), "MON"), 1)


def sweep_years(first: Column, last: Column) -> Column:
    """Odd years of a range."""
    start = first + F.when(first % 2 == 0, 1).otherwise(0)
    return F.when(start <= last, F.sequence(start, last, F.lit(2))).otherwise(F.array().cast("array<int>"))


def backoff_seconds(attempts: Column) -> Column:
    return F.least(60 * F.pow(F.lit(2.0), attempts - 1), F.lit(3600.0)).cast("bigint")


def election_years(start: Column) -> Column:
    """The years whose November can decide a biennium's House: the even one that seats it, then the
    odd one of specials."""
    return F.array(start - 1, start)


def senate_election_years(start: Column) -> Column:
    """The years whose winners sit in a biennium's Senate (terms of four years, half at a time): the
    two last even ones and the odd one of specials."""
    return F.array(start - 1, start - 3, start)


def seated_biennium(year: Column) -> Column:
    """The biennium that an election's winners sit in: an even year seats the next one, an odd one its own."""
    return biennium_label(year + F.when(year % 2 == 0, 1).otherwise(0))


# Plausible years of an annotation; month names; phrases whose years name a session
# or a district's history and no date.
YEAR_FLOOR, YEAR_CEILING = 1889, 2049
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
SESSION_NOISE = [r"to\s+serve\s+(?:the\s+)?\d{4}[^;]*", r"\b\d{4}\s+(?:\d(?:st|nd|rd|th)\s+)?ex\.?\s*s\.?", r"\b\d{4}\s+session\b", r"from\s+district\s+\d+[^;]*"]
_MONTH = r"(?:January|February|March|April|May|June|July|August|September|October|November|December|Jan|Feb|Mar|Apr|Jun|Jul|Aug|Sept?|Oct|Nov|Dec)"


def _parts(text: Column) -> tuple[Column, Column, Column, Column]:
    """Day (a date), month and year of the most precise date that a text states, and its precision."""
    bare = F.regexp_replace(text, "(?i)" + "|".join(SESSION_NOISE), " ")
    number = lambda name: F.nullif(F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(F.substring(name, 1, 3))).cast("int"), F.lit(0))
    # The parts stand apart by blanks, commas and full stops in any mixture.
    full = rf"(?i)\b({_MONTH})[\s.,]+(\d{{1,2}})[\s.,]+(\d{{4}})\b"
    year = F.regexp_extract(bare, full, 3).try_cast("int")
    iso = F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"), F.lpad(number(F.regexp_extract(bare, full, 1)).cast("string"), 2, "0"), F.lpad(F.regexp_extract(bare, full, 2), 2, "0"))
    day = F.when(year.between(YEAR_FLOOR, YEAR_CEILING), iso.try_cast("date"))
    half = rf"(?i)\b({_MONTH})[\s.,]+(\d{{4}})\b"
    month, month_year = number(F.regexp_extract(bare, half, 1)), F.regexp_extract(bare, half, 2).try_cast("int")
    alone = F.regexp_extract(bare, r"\b((?:1[89]|20)\d{2})\b", 1).try_cast("int")
    precision = F.when(day.isNotNull(), "day").when(month.isNotNull(), "month").when(alone.isNotNull(), "year").otherwise("none")
    of_day = day.isNotNull()
    return day, F.when(of_day, F.month(day)).otherwise(month), F.when(of_day, F.year(day)).when(month.isNotNull(), month_year).otherwise(alone), precision


def mixed_date(text: Column) -> Column:
    """struct(value, precision): the most precise date a clause states; impossible days and
    implausible years fall to a coarser one; session references are removed first."""
    day, _, _, precision = _parts(text)
    return F.when(text.isNotNull(), F.struct(day.alias("value"), precision.alias("precision")))


def partial_date(text: Column) -> Column:
    """struct(year, month, day, hour, minute, second): what a text states of a time, a clock time
    only after a full date; the rest null, never filled in."""
    day, month, year, _ = _parts(text)
    clock = lambda k: F.when(day.isNotNull(), F.regexp_extract(text, r"\b([01]?\d|2[0-3]):([0-5]\d)(?::([0-5]\d))?\b", k).try_cast("int"))
    return F.struct(year.alias("year"), month.alias("month"), F.dayofmonth(day).alias("day"), clock(1).alias("hour"), clock(2).alias("minute"), clock(3).alias("second"))
