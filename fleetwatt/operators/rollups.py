"""Hourly and per-time roll-ups.

All of them are hash aggregates with a partial step before the shuffle: a
vehicle or hour that holds most rows still sends one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwatt.functions.numbers import or_zero, total
from fleetwatt.functions.times import hour_of
from fleetwatt.schemas import POWER_THRESHOLD_W

VEHICLE = ("vehicle",)


def hourly_total(
    ports: DataFrame,
    value: str = "avg_power_W",
    hour: str | Column = "sampleHour",
    out: str = "total_output_power_W",
    by: Sequence[str] = VEHICLE,
    scale: int | None = None,
    per_port: str = "sum",
) -> DataFrame:
    """Sum over all ports of an hour; an hour with no measured value gives 0.

    Two reports of a port in one hour both count. With ``per_port='mean'`` a
    port counts once, with its mean over the hour.
    """
    hour_column = F.col(hour) if isinstance(hour, str) else hour
    rows = ports.withColumn("timestamp", hour_column).where(F.col("timestamp").isNotNull())
    if per_port == "mean":
        rows = rows.groupBy(*by, "timestamp", "domain", "slot", "port").agg(F.avg(value).alias(value))
    elif per_port != "sum":
        raise ValueError("per_port must be 'sum' or 'mean'")
    return rows.groupBy(*by, "timestamp").agg(or_zero(total(F.col(value), scale)).alias(out))


def positive_sum(
    rows: DataFrame, time: str, value: str, out: str, by: Sequence[str] = VEHICLE, scale: int | None = None
) -> DataFrame:
    """Sum per exact time of the positive values; times without any are left out."""
    positive = rows.where((F.col(value) > 0) & F.col(time).isNotNull())
    return positive.groupBy(*by, time).agg(total(F.col(value), scale).alias(out))


def hourly_mean(rows: DataFrame, time: str, value: str, out: str, by: Sequence[str] = VEHICLE) -> DataFrame:
    hours = rows.withColumn("sampleHour", hour_of(F.col(time))).where(F.col("sampleHour").isNotNull())
    return hours.groupBy(*by, "sampleHour").agg(F.avg(value).alias(out))


def above_threshold(ports: DataFrame, value: str = "avg_power_W", threshold: float = POWER_THRESHOLD_W) -> DataFrame:
    return ports.where(F.col(value) > threshold)


def component_hours(
    ports: DataFrame, value: str = "avg_power_W", by: Sequence[str] = VEHICLE, scale: int | None = None
) -> DataFrame:
    """Power per hour and component, in long form: (vehicle, sampleHour, component, power_W)."""
    rows = ports.where(F.col("sampleHour").isNotNull())
    return rows.groupBy(*by, "sampleHour", "component").agg(or_zero(total(F.col(value), scale)).alias("power_W"))


def port_hours(
    ports: DataFrame,
    value: str = "avg_power_W",
    threshold: float = POWER_THRESHOLD_W,
    by: Sequence[str] = VEHICLE,
    scale: int | None = None,
) -> DataFrame:
    """All hourly figures of the port table in one pass over it.

    ``total_W`` adds every report, ``power_W`` those above the threshold and is
    NULL where there is none. ``drawn_hours`` and ``total_hours`` derive the
    component hours and the hourly total from this much smaller table.
    """
    power = F.col(value)
    rows = ports.where(F.col("sampleHour").isNotNull())
    return rows.groupBy(*by, "sampleHour", "component").agg(
        or_zero(total(power, scale)).alias("total_W"),
        total(F.when(power > threshold, power), scale).alias("power_W"),
    )


def drawn_hours(hours: DataFrame, by: Sequence[str] = VEHICLE) -> DataFrame:
    return hours.where(F.col("power_W").isNotNull()).select(*by, "sampleHour", "component", "power_W")


def total_hours(
    hours: DataFrame, out: str = "total_output_power_W", by: Sequence[str] = VEHICLE, scale: int | None = None
) -> DataFrame:
    return hours.groupBy(*by, F.col("sampleHour").alias("timestamp")).agg(total(F.col("total_W"), scale).alias(out))


def component_pivot(
    ports: DataFrame,
    components: Sequence[str] | None = None,
    value: str = "avg_power_W",
    by: Sequence[str] = VEHICLE,
    scale: int | None = None,
    other: str | None = None,
) -> DataFrame:
    """One column per component in name order, 0 where a component has no value.

    With ``components`` this is one aggregate with one shuffle. A component that
    is not among them adds to the column ``other``, or stops the job where there
    is no such column. Without ``components`` they are the names that occur;
    these become columns, so there must be few.
    """
    rows = ports.where(F.col("sampleHour").isNotNull())
    if components is None:
        names = rows.where(F.col("component").isNotNull()).select("component").distinct().orderBy("component")
        components = [row.component for row in names.collect()]
    listed = F.col("component").isin(list(components))
    values = {name: F.when(F.col("component") == name, F.col(value)) for name in sorted(components)}
    if other is not None:
        values[other] = F.when(~listed, F.col(value))
    else:
        unknown = F.raise_error(F.concat(F.lit("component is not listed: "), F.col("component"))).cast("boolean")
        rows = rows.where(F.when(F.col("component").isNull() | listed, True).otherwise(unknown))
    sums = [or_zero(total(measure, scale)).alias(name) for name, measure in values.items()]
    return rows.groupBy(*by, "sampleHour").agg(*sums)
