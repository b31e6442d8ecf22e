"""The last copy of every record of a stream, also where a correction moves it to another day.

The state of a streaming aggregate knows, per key, the last copy and all days on
which the record has been. Every batch gives the records that it changed, and
the store rewrites the days that these were on and the day they are on now.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetwatt.functions.times import day_of
from fleetwatt.streaming.day_tables import DayTables, Table, distinct_days
from fleetwatt.streaming.ingest import drain

RECORDS = "records"


def last_copies(stream: DataFrame, time: str, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """The last copy of each record, with ``day`` and the ``days`` it has been on; for output mode update.

    Later batches win over earlier ones, then ``order`` decides, then the values.
    Records without a time are dropped. The state holds one row per key.
    """
    names = stream.columns
    # The time of the batch is the same for all of its rows, and the same again when it is repeated.
    place = F.struct(F.current_timestamp().alias("batch"), *order)
    dated = stream.where(F.col(time).isNotNull()).select(*keys, day_of(F.col(time)).alias("_day"), F.struct(place.alias("place"), F.struct(*names).alias("row")).alias("_copy"))
    known = dated.groupBy(*keys).agg(F.max("_copy").alias("_last"), F.collect_set("_day").alias("days"))
    return known.select("_last.row.*", "days").withColumn("day", day_of(F.col(time)))


class RecordStore:
    """Last copies by day, and tables built from them; keys need not hold the time."""

    def __init__(self, spark: SparkSession, root: str, time: str, keys: Sequence[str], order: Sequence[str], tables: Sequence[Table]):
        self.time, self.keys, self.order = time, list(keys), list(order)
        self.checkpoint = f"{root}/checkpoint"
        self.tables = DayTables(spark, f"{root}/tables", [], tables)

    def add(self, batch: DataFrame, batch_id: int) -> None:
        """Replace the records of a batch on all days they have been on; a batch that is repeated changes nothing more."""
        arrived = batch.persist()
        try:
            inside = [F.lit(day) for day in self.tables.calendar]
            touched = distinct_days(arrived.select(F.explode("days").alias("day")).where(F.col("day").between(*inside)))
            if not touched:
                return
            fresh = arrived.drop("days").where(F.col("day").isin(touched))
            if RECORDS in self.tables.schemas:
                keys = [F.col(f"old.`{key}`").eqNullSafe(F.col(f"new.`{key}`")) for key in self.keys]
                old = self.tables.read(RECORDS, touched).alias("old").join(arrived.select(*self.keys).alias("new"), keys, "left_anti")
                fresh = old.unionByName(fresh)
            self.tables.replace({RECORDS: (fresh, touched)})
        finally:
            arrived.unpersist()

    def follow(self, stream: DataFrame) -> None:
        """Process all new input of the stream."""
        found = last_copies(stream, self.time, self.keys, self.order)
        drain(found, self.checkpoint, "update").foreachBatch(self.add).start().awaitTermination()

    def read(self, name: str = RECORDS) -> DataFrame:
        return self.tables.read(name)
