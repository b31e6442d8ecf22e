"""Hourly power flows on the hours in which a vehicle draws power."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwatt.functions.times import hour_of

VEHICLE = ("vehicle",)


def hour_spine(component_rows: DataFrame, by: Sequence[str] = VEHICLE) -> DataFrame:
    return component_rows.where(F.col("sampleHour").isNotNull()).select(*by, "sampleHour").distinct()


def spine_join(spine: DataFrame, *sides: DataFrame, by: Sequence[str] = VEHICLE) -> DataFrame:
    """Left join of hourly tables, unique per hour, to the spine.

    For hourly tables that exist already. Their aggregates are partitioned by
    the join keys, so the joins add no shuffle.
    """
    result = spine
    for side in sides:
        result = result.join(side, [*by, "sampleHour"], "left")
    return result


def flows_of_rows(
    rows: DataFrame, on_spine: Column, measures: Mapping[str, Column], hour: str = "sampleHour", by: Sequence[str] = VEHICLE
) -> DataFrame:
    """The spine join from one table that holds all series, in one scan and one shuffle.

    ``on_spine`` tells the rows whose hours count; each of ``measures`` gives its
    value on the rows of its series and NULL on others.
    """
    hours = rows.where(F.col(hour).isNotNull()).groupBy(*by, F.col(hour).alias("sampleHour")).agg(
        F.max(F.coalesce(on_spine, F.lit(False))).alias("on_spine"),
        *[F.avg(value.cast("double")).alias(mean) for mean, value in measures.items()],
    )
    return hours.where("on_spine").drop("on_spine")


def hourly_flows(
    drawing: DataFrame,
    output: DataFrame,
    solar: DataFrame,
    battery: DataFrame | None = None,
    by: Sequence[str] = VEHICLE,
) -> DataFrame:
    """The spine join straight from the time series, in one shuffle.

    ``drawing`` holds the port rows above the threshold and gives the spine. All
    inputs become rows of one table that is aggregated once per hour; hours off
    the spine are dropped after it. No input is joined or sorted. Energy needs no
    battery rows, so that input may be left out.
    """
    # (input, its hour, its measure, the measure's hourly mean)
    inputs = [
        (output, hour_of(F.col("timestamp")), "total_output_power_W", "total_usage_W"),
        (solar, hour_of(F.col("timeStamp")), "solar_power_W", "solar_gain_W"),
    ]
    if battery is not None:
        inputs.append((battery, hour_of(F.col("timestamp")), "total_battery_power_W", "total_battery_power_W"))
    means = [mean for _, _, _, mean in inputs]

    def part(rows: DataFrame, hour: Column, on_spine: bool, mean: str | None = None, measure: str | None = None) -> DataFrame:
        values = [(F.col(measure) if name == mean else F.lit(None)).cast("double").alias(name) for name in means]
        return rows.select(*by, hour.alias("sampleHour"), F.lit(on_spine).alias("on_spine"), *values)

    rows = part(drawing, F.col("sampleHour"), True)
    for table, hour, measure, mean in inputs:
        rows = rows.unionByName(part(table, hour, False, mean, measure))
    return flows_of_rows(rows, F.col("on_spine"), {mean: F.col(mean) for mean in means}, by=by)
