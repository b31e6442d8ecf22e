"""Record counts of listed items."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def census(items: DataFrame, item_key: str, rows: DataFrame, row_key: str) -> DataFrame:
    """Rows per listed item, 0 for an item without any.

    The rows are counted before the join, so an item with very many rows costs
    one row per task.
    """
    counts = rows.groupBy(F.col(row_key).alias(item_key)).agg(F.count("*").alias("n"))
    return items.select(item_key).join(counts, item_key, "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))
