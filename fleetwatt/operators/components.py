"""Component order, colours, sensor order and chart trace numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetwatt.schemas import OPTIONAL_SENSORS, PALETTE, SENSOR_ORDER

VEHICLE = ("vehicle",)


def component_colours(
    rows: DataFrame, component: str = "component", by: Sequence[str] = VEHICLE, palette: Sequence[str] = PALETTE
) -> DataFrame:
    """Distinct components in name order with their place and colour.

    The window runs on the distinct components, of which a vehicle has few.
    """
    order = Window.partitionBy(*by).orderBy(component)
    place = (F.row_number().over(order) - 1).cast("long")
    colours = F.array(*[F.lit(colour) for colour in palette])
    return (
        rows.select(*by, component)
        .distinct()
        .withColumn("component_index", place)
        .withColumn("colour_index", F.col("component_index") % F.lit(len(palette)))
        .withColumn("colour", F.get(colours, F.col("colour_index").cast("int")))
    )


def sensor_order(
    spark: SparkSession,
    availability: DataFrame,
    order: Sequence[str] = SENSOR_ORDER,
    optional: Sequence[str] = OPTIONAL_SENSORS,
) -> DataFrame:
    """Axis place of each sensor; an optional one only where some row has it."""
    always = spark.createDataFrame([(name, i) for i, name in enumerate(order)], "sensor string, rank_no long")
    names = F.array(*[F.lit(name) for name in optional])
    present = availability.where(F.col("sensor").isin(*optional)).select("sensor").distinct()
    return always.unionByName(
        present.withColumn("rank_no", F.lit(len(order)) + F.array_position(names, F.col("sensor")) - 1)
    )


def in_sensor_order(availability: DataFrame, order: Sequence[str] = (*SENSOR_ORDER, *OPTIONAL_SENSORS)) -> DataFrame:
    """Add the axis place by which a chart lists the sensors, last sensor first."""
    names = F.array(*[F.lit(name) for name in order])
    return availability.withColumn("rank_no", F.array_position(names, F.col("sensor")) - 1)


def trace_spans(day_list: DataFrame, components: DataFrame, by: Sequence[str] = VEHICLE) -> DataFrame:
    """Chart traces owned by each day as (vehicle, day, first_trace, width), one row per day.

    Traces 0 and 1 are always shown. Each day owns the next C + 3 traces: its C
    components in name order, usage, solar and battery. ``day_list`` comes from
    ``days`` and ``components`` has the distinct components.
    """
    width = components.groupBy(*by).agg((F.count("*") + 3).alias("width"))
    owned = day_list.join(width, list(by))
    return owned.select(*by, "day", (2 + F.col("day_index") * F.col("width")).alias("first_trace"), "width")


def trace_index(day_list: DataFrame, components: DataFrame, by: Sequence[str] = VEHICLE) -> DataFrame:
    """The same with a row per trace, (vehicle, day, k, trace_index), for clients that cannot count."""
    k = F.explode(F.sequence(F.lit(0).cast("long"), F.col("width") - 1))
    return trace_spans(day_list, components, by).select(*by, "day", "first_trace", k.alias("k")).select(
        *by, "day", "k", (F.col("first_trace") + F.col("k")).alias("trace_index")
    )
