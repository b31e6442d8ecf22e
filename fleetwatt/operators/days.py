"""Per-day tables: day lists, energy, battery change and the day summary."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetwatt.functions.numbers import one_decimal, or_zero
from fleetwatt.functions.times import day_end, day_of, day_start, day_text
from fleetwatt.schemas import BATTERY_TITLE, POWER_TITLE

VEHICLE = ("vehicle",)


def days(rows: DataFrame, time: str = "sampleHour", by: Sequence[str] = VEHICLE) -> DataFrame:
    """Days with rows, with their place in the order of days.

    The window runs on the distinct days, of which a vehicle has few.
    """
    found = rows.where(F.col(time).isNotNull()).select(*by, day_of(F.col(time)).alias("day")).distinct()
    order = Window.partitionBy(*by).orderBy("day")
    return found.withColumn("day_index", (F.row_number().over(order) - 1).cast("long"))


def default_day(rows: DataFrame, as_of: dt.date | None = None, time: str = "sampleHour", by: Sequence[str] = VEHICLE) -> DataFrame:
    """The day ``as_of`` (today in UTC) where it has rows, else the last day."""
    today = F.current_date() if as_of is None else F.lit(as_of)
    day = day_of(F.col(time))
    return rows.groupBy(*by).agg(F.coalesce(F.max(F.when(day == today, day)), F.max(day)).alias("default_day"))


def flag_default_day(rows: DataFrame, time: str, defaults: DataFrame, by: Sequence[str] = VEHICLE) -> DataFrame:
    """Flag the rows on the default day of their vehicle; ``defaults`` has a row per vehicle.

    The join is on vehicle and day: without a broadcast it spreads the rows of a
    large vehicle over its days.
    """
    chosen = defaults.select(*by, F.col("default_day").alias("_day"), F.lit(True).alias("_chosen"))
    marked = rows.withColumn("_day", day_of(F.col(time))).join(chosen, [*by, "_day"], "left")
    return marked.withColumn("in_selected_day", F.when(F.col("_day").isNotNull(), F.coalesce("_chosen", F.lit(False)))).drop(
        "_day", "_chosen"
    )


def daily_energy(flows: DataFrame, by: Sequence[str] = VEHICLE) -> DataFrame:
    """Watt hours used and gained: hourly mean power summed over the hours of the day."""
    return flows.groupBy(*by, day_of(F.col("sampleHour")).alias("day")).agg(
        F.sum(or_zero(F.col("total_usage_W"))).alias("used_wh"),
        F.sum(or_zero(F.col("solar_gain_W"))).alias("gained_wh"),
    )


def first_last(series: DataFrame, time: str, value: str, by: Sequence[str] = VEHICLE) -> DataFrame:
    """First and last value of each day by time; of equal times the smallest is first and the largest last.

    Two hash aggregates: a time becomes one row before the ends of a day are
    chosen, so no task sorts. NULL values do not count beside others.
    """
    rows = series.where(F.col(time).isNotNull())
    times = rows.groupBy(*by, time).agg(F.min(value).alias("_low"), F.max(value).alias("_high"))
    return times.groupBy(*by, day_of(F.col(time)).alias("day")).agg(
        F.min_by("_low", time).alias("battery_start"), F.max_by("_high", time).alias("battery_end")
    )


def battery_change(day_list: DataFrame, ends: DataFrame, by: Sequence[str] = VEHICLE) -> DataFrame:
    """Start, end and change for each listed day; a day without battery rows has zeros."""
    joined = day_list.join(ends, [*by, "day"], "left")
    return joined.withColumns(
        {
            "battery_start": or_zero(F.col("battery_start")),
            "battery_end": or_zero(F.col("battery_end")),
            "delta": or_zero(F.col("battery_end") - F.col("battery_start")),
        }
    )


def day_summary(flows: DataFrame, battery: DataFrame, by: Sequence[str] = VEHICLE) -> DataFrame:
    """One row per vehicle and day on the spine.

    Both sides are aggregated per vehicle and day first, so the join reuses
    their partitioning and moves no raw rows.
    """
    ends = first_last(battery, "timestamp", "total_battery_power_W", by)
    summary = battery_change(daily_energy(flows, by), ends, by)
    return summary.withColumns(
        {
            "day_start": day_start(F.col("day")),
            "day_end": day_end(F.col("day")),
            "day_label": day_text(F.col("day")),
        }
    )


def with_titles(summary: DataFrame, label: str = "label") -> DataFrame:
    """Add the chart titles of each day; ``label`` is the display name of the vehicle."""
    shown = {name: one_decimal(F.col(name), plus=name == "delta") for name in ("gained_wh", "used_wh", "battery_start", "battery_end", "delta")}
    return summary.withColumns(
        {
            "title": F.format_string(POWER_TITLE, F.col(label), F.col("day_label"), shown["gained_wh"], shown["used_wh"]),
            "battery_title": F.format_string(BATTERY_TITLE, shown["battery_start"], shown["battery_end"], shown["delta"]),
        }
    )
