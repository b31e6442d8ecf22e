"""Hourly figures as partial states that merge, and from which records can be taken back.

A state holds, per hour, an exact decimal sum, a count, and the first and last
value with their times. States of any cut of the rows, merged in any order, are
the state of all rows. Sums and counts can be taken back; where a record that
goes was the first or last of its hour, the hour is marked ``open`` and only it
has to be made anew.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwatt.functions.times import day_of, hour_of

VEHICLE = ("vehicle",)
HOUR = "sampleHour"
STATE = ["sum_value", "n", "first_time", "first_value", "last_time", "last_value"]


def hour_states(rows: DataFrame, time: str, value: str, by: Sequence[str] = VEHICLE, scale: int = 4) -> DataFrame:
    """The state of each hour of ``rows``. Rows without a time or a value do not count.

    Of equal times the smallest value is first and the largest last.
    """
    counted = rows.where(F.col(time).isNotNull() & F.col(value).isNotNull())
    times = counted.groupBy(*by, F.col(time).alias("_time")).agg(
        F.sum(F.col(value).cast(f"decimal(18,{scale})")).alias("_sum"), F.count("*").alias("_n"), F.min(value).alias("_low"), F.max(value).alias("_high")
    )
    return times.groupBy(*by, hour_of(F.col("_time")).alias(HOUR)).agg(
        F.sum("_sum").cast(f"decimal(38,{scale})").alias("sum_value"),
        F.sum("_n").alias("n"),
        F.min("_time").alias("first_time"),
        F.min_by("_low", "_time").alias("first_value"),
        F.max("_time").alias("last_time"),
        F.max_by("_high", "_time").alias("last_value"),
    )


def merged(states: Sequence[DataFrame], by: Sequence[str] = VEHICLE) -> DataFrame:
    """One state per hour from several; sums go by partial aggregates, so an hour in many states is one row per task."""
    rows = reduce(DataFrame.unionByName, states)
    kind = rows.schema["sum_value"].dataType.simpleString()
    # Ends at one time differ by value only, so times are settled before values.
    ends = rows.groupBy(*by, HOUR).agg(F.min("first_time").alias("_first"), F.max("last_time").alias("_last"), F.sum("sum_value").cast(kind).alias("sum_value"), F.sum("n").alias("n"))
    at_first = rows.groupBy(*by, HOUR, F.col("first_time").alias("_first")).agg(F.min("first_value").alias("first_value"))
    at_last = rows.groupBy(*by, HOUR, F.col("last_time").alias("_last")).agg(F.max("last_value").alias("last_value"))
    joined = _joined(_joined(ends, at_first, [*by, HOUR, "_first"]), at_last, [*by, HOUR, "_last"])
    return joined.select(*by, HOUR, "sum_value", "n", F.col("_first").alias("first_time"), "first_value", F.col("_last").alias("last_time"), "last_value")


def _joined(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on keys that may be NULL."""
    same = [F.col(f"left.`{key}`").eqNullSafe(F.col(f"right.`{key}`")) for key in keys]
    more = [F.col(f"right.`{name}`") for name in right.columns if name not in keys]
    return left.alias("left").join(right.alias("right"), same, how).select("left.*", *more)


def taken_back(state: DataFrame, removed: DataFrame, by: Sequence[str] = VEHICLE) -> DataFrame:
    """``state`` without the records of ``removed``, with ``open``: the hour has lost an end and must be made anew.

    Hours without records left are dropped.
    """
    gone = removed.select(*by, HOUR, *[F.col(name).alias(f"_{name}") for name in STATE])
    kind = state.schema["sum_value"].dataType.simpleString()
    none = F.lit(0)
    joined = _joined(state, gone, [*by, HOUR], "left")
    lost = (F.col("_first_time") <= F.col("first_time")) | (F.col("_last_time") >= F.col("last_time"))
    left = joined.withColumns(
        {
            "sum_value": (F.col("sum_value") - F.coalesce("_sum_value", none)).cast(kind),
            "n": F.col("n") - F.coalesce("_n", none),
            "open": F.coalesce(lost, F.lit(False)),
        }
    )
    return left.where("n > 0").select(*by, HOUR, *STATE, "open")


def updated(
    state: DataFrame, added: DataFrame, removed: DataFrame, again: Callable[[DataFrame], DataFrame], by: Sequence[str] = VEHICLE
) -> DataFrame:
    """``state`` after records were taken back and others added, both given as states.

    ``again`` gives the state of some hours (by, sampleHour) from all of their
    records; it is asked only for hours that lost an end.
    """
    left = taken_back(state, removed, by)
    hours = left.where("open").select(*by, HOUR)
    kept = merged([left.where(~F.col("open")).drop("open"), added], by)
    same = [F.col(f"kept.`{key}`").eqNullSafe(F.col(f"hours.`{key}`")) for key in (*by, HOUR)]
    return kept.alias("kept").join(hours.alias("hours"), same, "left_anti").unionByName(again(hours))


def hour_figures(state: DataFrame, by: Sequence[str] = VEHICLE) -> DataFrame:
    """Sum, mean and count per hour."""
    total = F.col("sum_value").cast("double")
    return state.select(*by, HOUR, total.alias("total"), (total / F.col("n")).alias("mean_value"), "n")


def day_ends(state: DataFrame, by: Sequence[str] = VEHICLE) -> DataFrame:
    """First and last value of each day and its sum, from the states of its hours."""
    return state.groupBy(*by, day_of(F.col(HOUR)).alias("day")).agg(
        F.min_by("first_value", HOUR).alias("first_value"),
        F.max_by("last_value", HOUR).alias("last_value"),
        F.sum("sum_value").cast("double").alias("total"),
        F.sum("n").alias("n"),
    )
