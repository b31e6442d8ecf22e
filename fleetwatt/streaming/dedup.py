"""Repeated records in a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwatt.streaming.hourly import REFETCH_HORIZON


def drop_repeats(stream: DataFrame, time: str, keys: Sequence[str], delay: str = REFETCH_HORIZON) -> DataFrame:
    """Drop exact repeats of records that arrive within ``delay`` of each other.

    This keeps the first copy. Where a later copy may hold corrected values,
    use ``streaming.restate``, which keeps the last one.
    """
    timed = stream.withColumn("_time", F.col(time).cast("timestamp")).withWatermark("_time", delay)
    return timed.dropDuplicatesWithinWatermark(list(keys)).drop("_time")
