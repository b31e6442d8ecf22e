"""Places of rows in one order, found without a task that sees them all."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetwatt.llm.common import stored

# Rows of one partition number from 0 in the low bits; the partition is above them.
PART_BITS = 33


def in_order(rows: DataFrame, by: list[str]) -> DataFrame:
    """``rows`` with ``place``, which increases along the columns ``by`` (NULL first), stored in that order.

    Ranges are sampled over all columns named, so a value of the first that a
    third of the rows share is cut by the next ones.
    """
    sorted_rows = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    return stored(sorted_rows.withColumn("place", F.monotonically_increasing_id()), "ordered")


def numbered(rows: DataFrame, group: str, by: list[str]) -> DataFrame:
    """``rows`` with ``idx``, the number from 0 of each row in its group along ``by``, and ``size`` of the group.

    ``group`` holds no NULL. Only counts by group and partition are added up.
    """
    ordered = in_order(rows, [group, *by])
    part = F.shiftright("place", PART_BITS)
    counts = ordered.groupBy(group, part.alias("part")).agg(F.count("*").alias("n"), F.min("place").alias("first"))
    before = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bounds = counts.select(
        group,
        "part",
        (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("n").over(Window.partitionBy(group)).alias("size"),
    )
    found = ordered.withColumn("part", part).join(bounds, [group, "part"])
    return found.withColumn("idx", F.col("place") + F.col("shift")).drop("part", "place", "shift")
