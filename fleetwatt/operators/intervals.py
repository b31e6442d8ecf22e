"""Membership of rows in intervals of any length, which may overlap."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Microseconds of the shortest bucket; each level doubles them.
SHORTEST = 60_000_000


def micros(time: Column) -> Column:
    return F.unix_micros(time.cast("timestamp"))


def interval_join(rows: DataFrame, time: str, intervals: DataFrame, start: str, end: str, by: Sequence[str] = ("vehicle",)) -> DataFrame:
    """Each row with each interval [start, end) of its group that holds its time.

    An interval lies in buckets of its own length: it meets two of them, three at
    most. A row lies in one bucket per length that occurs, so the join is on
    equality, no row meets intervals that are far from it, and an interval of
    months costs as much as one of minutes. Buckets spread the rows of a large
    group; adaptive execution splits what is left. Rows without a time and
    intervals without an end, or without extent, have no part. Columns other than
    ``by`` must differ in name.
    """
    low, high = micros(F.col(start)), micros(F.col(end))
    length = F.ceil(F.log2(F.greatest((high - low) / F.lit(float(SHORTEST)), F.lit(1.0)))).cast("int")
    wide = intervals.where(F.col(start) < F.col(end)).withColumn("_level", length)
    # At most 64 lengths: the logarithm of a time span.
    levels = sorted(row._level for row in wide.select("_level").distinct().collect())
    width = (F.lit(SHORTEST) * F.pow(F.lit(2.0), F.col("_level"))).cast("long")

    def bucket(at: Column) -> Column:
        return F.floor(at / F.col("_width"))

    spread = wide.withColumn("_width", width).withColumn("_bucket", F.explode(F.sequence(bucket(low), bucket(high - 1))))
    timed = rows.where(F.col(time).isNotNull()).withColumn("_level", F.explode(F.array(*map(F.lit, levels)).cast("array<int>")))
    placed = timed.withColumn("_width", width).withColumn("_bucket", bucket(micros(F.col(time))))
    joined = placed.drop("_width").join(spread.drop("_width"), [*by, "_level", "_bucket"])
    return joined.where((F.col(time) >= F.col(start)) & (F.col(time) < F.col(end))).drop("_level", "_bucket")
