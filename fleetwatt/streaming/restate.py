"""Restating the days that new records touch.

A store has two tables. ``arrivals`` holds, per day, the last copy of each
record in one of two slots: a batch that changes a day writes it anew into the
slot that is not current, so a batch repeated after a failure finds the same
state and gives the same result, and no batch adds files for ever. ``result`` is
partitioned by day and rebuilt for the changed days only. Late records need no
watermark: they restate their day like any others.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetwatt.functions.times import day_of
from fleetwatt.operators.cleaning import keep_last
from fleetwatt.sources.tables import write_parquet
from fleetwatt.streaming.ingest import drain

Build = Callable[[DataFrame], DataFrame]
# Days a clock can be right about; they bound what a batch may touch.
CALENDAR = (dt.date(2000, 1, 1), dt.date(2100, 1, 1))
# Beyond so many days the whole table is listed rather than its days one by one.
MANY_DAYS = 400


def calendar_days(rows: DataFrame) -> list[dt.date]:
    """The days present; their number is bounded by the calendar of the store, not by the rows."""
    return sorted(row.day for row in rows.select("day").distinct().collect())


class DayStore:
    """Last copies by day, and the day-partitioned result built from them."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        time: str,
        keys: Sequence[str],
        order: Sequence[str],
        build: Build,
        cluster: Sequence[str] = ("vehicle",),
        calendar: tuple[dt.date, dt.date] = CALENDAR,
    ):
        """``build`` turns the last copies per ``keys``, by batch and ``order``, into rows with a ``day``.

        ``order`` names the columns that tell the place of a record in its batch.
        Records without a time are dropped; those off the ``calendar`` are set
        aside in the table ``outside``.
        """
        self.spark = spark
        self.arrivals = f"{root}/arrivals"
        self.result = f"{root}/result"
        self.outside = f"{root}/outside"
        self.checkpoint = f"{root}/checkpoint"
        self.time, self.keys, self.order = time, list(keys), list(order)
        self.build, self.cluster, self.calendar = build, list(cluster), calendar

    def add(self, batch: DataFrame, batch_id: int) -> None:
        dated = batch.where(F.col(self.time).isNotNull()).withColumn("day", day_of(F.col(self.time)))
        inside = F.col("day").between(*map(F.lit, self.calendar))
        # One batch may hold several copies; only its last one counts.
        arrived = keep_last(dated.where(inside), self.keys, self.order or self.keys).persist()
        try:
            strange = dated.where(~inside)
            if not strange.isEmpty():
                strange.write.mode("overwrite").parquet(f"{self.outside}/batch={batch_id}")
            days = calendar_days(arrived)
            if days:
                self.merge(arrived, days, batch_id)
        finally:
            arrived.unpersist()

    def merge(self, arrived: DataFrame, days: list[dt.date], batch_id: int) -> None:
        stamped = arrived.withColumn("batch", F.lit(batch_id).cast("long"))
        known = self.current(stamped.schema, days, batch_id)
        compared = [name for name in arrived.columns if name not in self.order]
        same = [F.col(f"arrived.`{name}`").eqNullSafe(F.col(f"known.`{name}`")) for name in compared]
        changed = arrived.alias("arrived").join(known.alias("known"), same, "left_anti")
        touched = calendar_days(changed)
        if not touched:
            return
        slots = known.where(F.col("day").isin(touched)).groupBy("day").agg((1 - F.max("slot")).alias("slot"))
        rows = known.drop("slot", "stamp").unionByName(stamped).where(F.col("day").isin(touched))
        last = keep_last(rows, self.keys, ["batch", *self.order]).withColumn("stamp", F.lit(batch_id).cast("long"))
        placed = last.join(slots, "day", "left").withColumn("slot", F.coalesce("slot", F.lit(0)))
        placed.hint("rebalance", "day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "day", "slot"
        ).parquet(self.arrivals)
        fresh = self.current(stamped.schema, touched, batch_id + 1).drop("slot", "stamp", "batch")
        write_parquet(self.build(fresh), self.result, partitions=["day"], cluster=self.cluster, mode="dynamic")

    def current(self, schema: T.StructType, days: list[dt.date], before: int) -> DataFrame:
        """Last copies of some days as batches earlier than ``before`` left them, with their slot and stamp."""
        kinds = T.StructType([*schema.fields, T.StructField("stamp", T.LongType()), T.StructField("slot", T.IntegerType())])
        paths = [f"{self.arrivals}/day={{{','.join(map(str, days))}}}"] if len(days) <= MANY_DAYS else [self.arrivals]
        try:
            found = self.spark.read.schema(kinds).option("basePath", self.arrivals).parquet(*paths)
            found.columns  # noqa: B018  the path is looked up here
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], kinds)
        found = found.where(F.col("day").isin(days) & (F.col("stamp") < before))
        newest = found.groupBy("day").agg(F.max("stamp").alias("stamp"))
        return found.join(newest, ["day", "stamp"]).select(*kinds.names)

    def follow(self, stream: DataFrame) -> None:
        """Process all new input of the stream."""
        drain(stream, self.checkpoint).foreachBatch(self.add).start().awaitTermination()

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.result)

    def last_copies(self) -> DataFrame:
        """The last copy of every record, with the batch that brought it."""
        found = self.spark.read.parquet(self.arrivals)
        newest = found.groupBy("day").agg(F.max("stamp").alias("stamp"))
        return found.join(newest, ["day", "stamp"]).drop("stamp", "slot")
