"""Hourly statistics kept up to date by a stream, and records that arrive late."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetwatt.functions.numbers import total
from fleetwatt.functions.times import day_of, hour_of
from fleetwatt.streaming.restate import DayStore

# Raw files of yesterday and today are fetched again by every run.
REFETCH_HORIZON = "48 hours"


def hourly_stats(rows: DataFrame, time: str, value: str, by: Sequence[str], scale: int | None = None) -> DataFrame:
    """Sum, mean and count per hour, with its day.

    With ``scale`` the figures come from a decimal sum and so do not depend on
    the order of rows.
    """
    hours = rows.groupBy(*by, hour_of(F.col(time)).alias("sampleHour")).agg(
        total(F.col(value), scale).alias("total"), F.count(value).alias("n")
    )
    mean = F.try_divide("total", "n").alias("mean_value")
    return hours.select(*by, "sampleHour", "total", mean, "n", day_of(F.col("sampleHour")).alias("day"))


def hourly_store(
    spark: SparkSession,
    root: str,
    time: str,
    value: str,
    by: Sequence[str],
    keys: Sequence[str],
    order: Sequence[str] = (),
    scale: int | None = None,
) -> DayStore:
    """Hourly statistics over the last copies of records: a record fetched again counts once, a late one counts."""
    return DayStore(spark, root, time, keys, order, lambda rows: hourly_stats(rows, time, value, by, scale), list(by))


def mark_late(rows: DataFrame, time: str, batch: str = "batch", delay: str = REFETCH_HORIZON) -> DataFrame:
    """Add ``late``: the record is older, by more than ``delay``, than what earlier batches had brought.

    The window runs over one row per batch.
    """
    newest = rows.groupBy(batch).agg(F.max(time).alias("_newest"))
    before = Window.orderBy(batch).rowsBetween(Window.unboundedPreceding, -1)
    seen = newest.select(F.col(batch), F.max("_newest").over(before).alias("_seen"))
    late = F.coalesce(F.col(time) < F.col("_seen") - F.expr(f"interval {delay}"), F.lit(False))
    return rows.join(seen, batch).withColumn("late", late).drop("_seen")
