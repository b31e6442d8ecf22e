"""Chart data as one long table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwatt.functions.times import day_of

VEHICLE = ("vehicle",)


def points(rows: DataFrame, panel: str, series: Column, x: str, y: str, by: Sequence[str] = VEHICLE) -> DataFrame:
    """Points of one panel as (vehicle, day, panel, series, x, y)."""
    return rows.select(
        *by,
        day_of(F.col(x)).alias("day"),
        F.lit(panel).alias("panel"),
        series.alias("series"),
        F.col(x).alias("x"),
        F.col(y).alias("y"),
    )


def series_table(
    components: DataFrame, flows: DataFrame, battery: DataFrame, availability: DataFrame, by: Sequence[str] = VEHICLE
) -> DataFrame:
    """All points of the four panels.

    Bars hold only components that drew power in the hour; the three hourly
    lines come from one pass over the flows.
    """
    hourly = F.array(
        F.struct(F.lit("flows").alias("panel"), F.lit("usage").alias("series"), F.col("total_usage_W").alias("y")),
        F.struct(F.lit("flows").alias("panel"), F.lit("solar").alias("series"), F.col("solar_gain_W").alias("y")),
        F.struct(F.lit("battery").alias("panel"), F.lit("battery").alias("series"), F.col("total_battery_power_W").alias("y")),
    )
    lines = flows.select(*by, F.col("sampleHour").alias("x"), F.inline(hourly)).select(
        *by, day_of(F.col("x")).alias("day"), "panel", "series", "x", "y"
    )
    parts = [
        points(components, "bars", F.col("component"), "sampleHour", "power_W", by),
        lines.where(F.col("y").isNotNull()),
        points(battery, "mission", F.lit("battery"), "timestamp", "total_battery_power_W", by),
        points(availability, "availability", F.col("sensor"), "timestamp", "value", by),
    ]
    return reduce(DataFrame.unionByName, parts)
