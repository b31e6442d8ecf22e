"""Choice and labels of vehicles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetwatt.functions.labels import vehicle_label
from fleetwatt.schemas import VEHICLE_LABELS


EVERY = ("both", "all")


def chosen_vehicles(target: str, known: Sequence[str]) -> list[str]:
    """The target vehicle, or all ``known`` ones for 'both' and 'all'."""
    if target in EVERY:
        return list(known)
    if target not in known:
        raise ValueError(f"target must be one of {sorted([*EVERY, *known])}")
    return [target]


def select_vehicles(table: DataFrame, target: str, known: Sequence[str]) -> DataFrame:
    """Rows of the chosen vehicles; the filter reaches the scan."""
    return table.where(F.col("vehicle").isin(*chosen_vehicles(target, known)))


def label_table(spark: SparkSession, rows: Sequence[tuple[str, str]] = VEHICLE_LABELS) -> DataFrame:
    """The fixed vehicle labels, rows made in the code and so safe to broadcast."""
    return F.broadcast(spark.createDataFrame(list(rows), "vehicle string, label string"))


def with_label(table: DataFrame, labels: DataFrame) -> DataFrame:
    """Add the display label of each vehicle, its upper-case key where it has none."""
    return table.join(labels, "vehicle", "left").withColumn("label", vehicle_label(F.col("label"), F.col("vehicle")))
