"""Time parsing and bucketing. Times are UTC wall clock in TIMESTAMP_NTZ."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# A mark of a zone anywhere after the date of an ISO text.
ZONED = r"(?s)^\s*+[+-]?\d++(?:-\d++){0,2}+.*?(?:[zZ/+-]|UTC|GMT)"


def _text(column: Column) -> Column:
    return column.cast("string")


def to_time(column: Column, *formats: str) -> Column:
    """Lenient parse: text that is no time gives NULL.

    ``formats`` are tried in order before ISO text. Text with a zone is moved
    to UTC, text without one is taken as UTC.
    """
    text = _text(column)
    zoned = text.try_cast("timestamp").cast("timestamp_ntz")
    # One pattern, since Spark evaluates ``text`` anew for every reference to it.
    iso = F.when(text.rlike(ZONED), zoned).otherwise(text.try_cast("timestamp_ntz"))
    declared = [F.try_to_timestamp(text, F.lit(fmt)).cast("timestamp_ntz") for fmt in formats]
    return F.coalesce(*declared, iso)


def to_time_strict(column: Column, *formats: str) -> Column:
    """As ``to_time``, but text that is no time stops the job."""
    failed = F.raise_error(F.concat(F.lit("not a time: "), _text(column))).cast("timestamp_ntz")
    return F.coalesce(to_time(column, *formats), F.when(column.isNotNull(), failed))


def hour_of(column: Column) -> Column:
    return F.date_trunc("hour", column).cast("timestamp_ntz")


def day_of(column: Column) -> Column:
    return column.cast("date")


def day_start(day: Column) -> Column:
    return day.cast("date").cast("timestamp_ntz")


def day_end(day: Column) -> Column:
    return F.date_add(day.cast("date"), 1).cast("timestamp_ntz")


def in_day(time: Column, day: Column) -> Column:
    """True for times in [day, next day)."""
    return (time >= day_start(day)) & (time < day_end(day))


def day_range(time: Column, first: dt.date, last: dt.date) -> Column:
    """Times on the days ``first`` to ``last``, as a range that reaches the Parquet scan."""
    start = dt.datetime.combine(first, dt.time())
    stop = dt.datetime.combine(last + dt.timedelta(days=1), dt.time())
    return (time >= F.lit(str(start)).cast("timestamp_ntz")) & (time < F.lit(str(stop)).cast("timestamp_ntz"))


def day_text(column: Column) -> Column:
    return F.date_format(column, "yyyy-MM-dd")


def updated_label() -> Column:
    """The current UTC time as dashboards print it."""
    return F.date_format(F.current_timestamp(), "dd-MMM yyyy HH:mm:ss 'UTC'")
