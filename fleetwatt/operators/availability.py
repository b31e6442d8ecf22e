"""Times at which each sensor delivered a valid measurement."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwatt.operators.cleaning import number_column, time_column
from fleetwatt.schemas import SENSOR_SPECS, SensorSpec


def sensor_availability(
    sources: Mapping[str, DataFrame], specs: Sequence[SensorSpec] = SENSOR_SPECS, by: Sequence[str] = ("vehicle",)
) -> DataFrame:
    """(vehicle, timestamp, sensor, value) of every valid measurement.

    The sensors of one source share a scan: each of its rows gives one row per
    valid measurement. Sensors whose source is absent are left out.
    """
    shared: dict[tuple, list[SensorSpec]] = {}
    for spec in specs:
        if spec.source in sources:
            shared.setdefault((spec.source, spec.time, spec.formats), []).append(spec)
    if not shared:
        raise ValueError("no source of any sensor is given")

    def rows(source: str, time: str, formats: tuple[str, ...], group: list[SensorSpec]) -> DataFrame:
        table = sources[source]
        measured = F.array(
            *[F.struct(F.lit(s.sensor).alias("sensor"), number_column(table, s.value).alias("value")) for s in group]
        )
        timed = table.select(*by, time_column(table, time, *formats).alias("timestamp"), measured.alias("_m"))
        long = timed.where(F.col("timestamp").isNotNull()).select(*by, "timestamp", F.inline("_m"))
        return long.where(F.col("value").isNotNull())

    return reduce(DataFrame.unionByName, [rows(*key, group) for key, group in shared.items()])
