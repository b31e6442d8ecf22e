"""Tables by day that follow files which are fetched again under their names.

A ledger knows every file with its length, its change time and, per day, the
number and a hash of its records. A refresh lists the files, reads those whose
length or time differs, and compares their days with the ledger: a day is
touched where a file brings other records than before, records that are gone
included. Touched days of the records are written anew, and the tables built
from them follow through the graph, day by day. Other days are not read.

Each day of a table has two slots. A refresh writes the slot that is not
current, and the state that names the current ones is replaced last. A refresh
that fails leaves the former state as it was, and is simply run again.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetwatt.sources.json_records import SOURCE_ORDER
from fleetwatt.sources.tables import write_parquet
from fleetwatt.streaming.restate import CALENDAR

FILE_DAYS = "array<struct<day: date, n: bigint, digest: bigint>>"
LEDGER = f"source string, file string, bytes bigint, changed timestamp, outside bigint, days {FILE_DAYS}"
# Columns of the stored tables only.
SLOT, STAMP = "turn_slot", "turn_stamp"
INDEX = "name string, day date, slot int"


@dataclass(frozen=True)
class Source:
    """Files of one product. ``read`` gives the records of some of them, with ``day`` and their place in ``source_order``."""

    name: str
    paths: Sequence[str]
    read: Callable[[Sequence[str]], DataFrame]


@dataclass(frozen=True)
class Table:
    """A table with ``day``, each day of which is built from the same day of its ``inputs``."""

    name: str
    inputs: Sequence[str]
    build: Callable[..., DataFrame]
    cluster: Sequence[str] = ("vehicle",)


def found(read: Callable[[], DataFrame]) -> DataFrame | None:
    """A table, or nothing where its folder does not exist yet."""
    try:
        table = read()
        table.columns  # noqa: B018  the path is looked up here
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    return table


def distinct_days(rows: DataFrame) -> list[dt.date]:
    """The days present; the calendar bounds their number."""
    return sorted(row.day for row in rows.select("day").distinct().collect())


class DayTables:
    """Records of files, and tables built from them, refreshed by the days that changed.

    Records without a time are in no day and are left out; those off the
    ``calendar`` are counted in the ledger. ``tables`` are listed inputs first.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        sources: Sequence[Source],
        tables: Sequence[Table],
        calendar: tuple[dt.date, dt.date] = CALENDAR,
    ):
        self.spark, self.root, self.calendar = spark, root, calendar
        self.sources, self.tables = list(sources), list(tables)
        self.load()

    # --- state ---

    def load(self) -> None:
        """Take up the state of the last refresh that ended."""
        self.run, self.turn = 0, 1
        for turn in (0, 1):
            done = found(lambda at=turn: self.spark.read.schema("run bigint").parquet(f"{self.root}/state-{at}/done"))
            run = done.first() if done else None
            if run and run.run > self.run:
                self.run, self.turn = run.run, turn
        self.current: dict[str, dict[dt.date, int]] = {}
        self.schemas: dict[str, T.StructType] = {}
        if self.run:
            state = f"{self.root}/state-{self.turn}"
            for row in self.spark.read.schema(INDEX).parquet(f"{state}/index").collect():
                self.current.setdefault(row.name, {})[row.day] = row.slot
            for row in self.spark.read.schema("name string, json string").parquet(f"{state}/schemas").collect():
                self.schemas[row.name] = T.StructType.fromJson(json.loads(row.json))

    def ledger(self) -> DataFrame:
        """The files read, with the days and hashes of their records."""
        if not self.run:
            return self.spark.createDataFrame([], LEDGER)
        return self.spark.read.schema(LEDGER).parquet(f"{self.root}/state-{self.turn}/ledger")

    def commit(self, ledger: DataFrame) -> None:
        turn, run = 1 - self.turn, self.run + 1
        state = f"{self.root}/state-{turn}"
        index = [(name, day, slot) for name, days in self.current.items() for day, slot in days.items()]
        ledger.write.mode("overwrite").parquet(f"{state}/ledger")
        self.spark.createDataFrame(index, INDEX).coalesce(1).write.mode("overwrite").parquet(f"{state}/index")
        kinds = [(name, schema.json()) for name, schema in self.schemas.items()]
        self.spark.createDataFrame(kinds, "name string, json string").coalesce(1).write.mode("overwrite").parquet(f"{state}/schemas")
        self.spark.createDataFrame([(run,)], "run bigint").coalesce(1).write.mode("overwrite").parquet(f"{state}/done")
        self.run, self.turn = run, turn

    # --- days ---

    def days(self, name: str) -> list[dt.date]:
        return sorted(self.current.get(name, {}))

    def read(self, name: str, days: Iterable[dt.date] | None = None) -> DataFrame:
        """A table, or some days of it; only the folders of these are listed."""
        slots = self.current.get(name, {})
        chosen = slots if days is None else [day for day in days if day in slots]
        kinds = self.schemas[name]
        if not chosen:
            return self.spark.createDataFrame([], kinds)
        paths = [f"{self.root}/{name}/day={day}/{SLOT}={slots[day]}" for day in sorted(chosen)]
        whole = T.StructType([*kinds.fields, T.StructField(SLOT, T.IntegerType())])
        rows = self.spark.read.schema(whole).option("basePath", f"{self.root}/{name}").parquet(*paths)
        return rows.select(*kinds.names)

    def write(self, name: str, rows: DataFrame, days: Sequence[dt.date], cluster: Sequence[str] = ("vehicle",)) -> None:
        """Replace ``days`` of a table by ``rows``; days without rows are gone from it."""
        self.schemas[name] = rows.schema
        before = self.current.get(name, {})
        slots = [(day, 1 - before[day] if day in before else 0) for day in days]
        placed = rows.join(F.broadcast(self.spark.createDataFrame(slots, f"day date, {SLOT} int")), "day")
        stamp = uuid.uuid4().hex
        stamped = placed.withColumn(STAMP, F.lit(stamp))
        write_parquet(stamped, f"{self.root}/{name}", (), ["day", SLOT], [c for c in cluster if c in rows.columns], "dynamic")
        # A slot without new rows may still hold those of an earlier refresh, or of one that failed, which the stamp tells.
        kinds = f"{STAMP} string, day date, {SLOT} int"
        written = found(lambda: self.spark.read.schema(kinds).parquet(f"{self.root}/{name}"))
        own = dict(slots)
        pairs = written.where((F.col(STAMP) == stamp) & F.col("day").isin(list(days))).select("day", F.col(SLOT).alias("slot")).distinct().collect() if written else []
        kept = {day: slot for day, slot in before.items() if day not in own}
        self.current[name] = kept | {row.day: row.slot for row in pairs if own[row.day] == row.slot}

    # --- refresh ---

    def changed_records(self, source: Source) -> tuple[list[dt.date], DataFrame | None]:
        """Touched days of a source, which are written, and its new ledger (nothing if it is as before)."""
        listed = (
            self.spark.read.format("binaryFile")
            .load(list(source.paths))
            .select(F.col("_metadata.file_path").alias("file"), "path", F.col("length").alias("bytes"), F.col("modificationTime").alias("changed"))
        )
        known = self.ledger().where(F.col("source") == source.name)
        # Spark holds the list of files in the driver for any scan; this is a part of it.
        suspects = listed.join(known, ["file", "bytes", "changed"], "left_anti").collect()
        gone = known.join(listed, "file", "left_anti")
        if not suspects and gone.isEmpty():
            return [], None
        files = self.spark.createDataFrame([(s.file, s.bytes, s.changed) for s in suspects], "file string, bytes bigint, changed timestamp")
        staging = f"{self.root}/staging/{source.name}"
        fresh = None
        if suspects:
            read = source.read([s.path for s in suspects]).where(F.col("day").isNotNull())
            read.write.mode("overwrite").parquet(staging)
            fresh = self.spark.read.schema(read.schema).parquet(staging)
            inside = F.col("day").between(*map(F.lit, self.calendar))
            by_day = fresh.withColumn("file", F.col(f"{SOURCE_ORDER}.file")).groupBy("file", F.when(inside, F.col("day")).alias("day")).agg(
                F.count("*").alias("n"), F.bit_xor(F.xxhash64(*fresh.columns)).alias("digest")
            )
            per_file = by_day.groupBy("file").agg(
                F.coalesce(F.sum(F.when(F.col("day").isNull(), F.col("n"))), F.lit(0)).alias("outside"),
                F.array_sort(F.filter(F.collect_list(F.struct("day", "n", "digest")), lambda x: x["day"].isNotNull())).alias("days"),
            )
            entries = files.join(per_file, "file", "left").select(
                F.lit(source.name).alias("source"), "file", "bytes", "changed", F.coalesce("outside", F.lit(0)).alias("outside"),
                F.coalesce("days", F.array().cast(FILE_DAYS)).alias("days"),
            )
            entries.write.mode("overwrite").parquet(f"{staging}-ledger")
            entries = self.spark.read.schema(LEDGER).parquet(f"{staging}-ledger")
        else:
            entries = self.spark.createDataFrame([], LEDGER)

        def content(ledger: DataFrame) -> DataFrame:
            return ledger.select("file", F.inline("days"))

        former = known.join(files, "file", "left_semi")
        differing = content(entries).exceptAll(content(former)).unionByName(content(former).exceptAll(content(entries))).unionByName(content(gone))
        touched = distinct_days(differing)
        if touched:
            if source.name in self.schemas:
                replaced = files.select("file").unionByName(gone.select("file"))
                old = self.read(source.name, touched)
                old = old.withColumn("_file", F.col(f"{SOURCE_ORDER}.file")).join(replaced.withColumnRenamed("file", "_file"), "_file", "left_anti").drop("_file")
                rows = old if fresh is None else old.unionByName(fresh.where(F.col("day").isin(touched)))
            else:
                rows = fresh.where(F.col("day").isin(touched))
            self.write(source.name, rows, touched)
        kept = known.join(files, "file", "left_anti").join(gone.select("file"), "file", "left_anti")
        return touched, kept.select(entries.columns).unionByName(entries)

    def refresh(self) -> dict[str, list[dt.date]]:
        """Follow the files and return the days written per table; nothing is written if no record changed."""
        touched: dict[str, list[dt.date]] = {}
        ledgers = []
        for source in self.sources:
            days, ledger = self.changed_records(source)
            touched[source.name] = days
            if source.name not in self.schemas and ledger is not None:
                self.schemas[source.name] = self.spark.read.parquet(f"{self.root}/staging/{source.name}").schema
            ledgers.append((source.name, ledger))
        if all(ledger is None for _, ledger in ledgers):
            return {name.name: [] for name in (*self.sources, *self.tables)}
        self.propagate(touched)
        former = self.ledger()
        whole = former.where(~F.col("source").isin([name for name, ledger in ledgers if ledger is not None]))
        for _, ledger in ledgers:
            if ledger is not None:
                whole = whole.unionByName(ledger)
        self.commit(whole)
        return touched

    def propagate(self, touched: dict[str, list[dt.date]]) -> None:
        """Write the days of all tables that ``touched`` inputs change, and add these to it."""
        for table in self.tables:
            days = sorted({day for name in table.inputs for day in touched[name]})
            touched[table.name] = days
            if days or table.name not in self.schemas:
                rows = table.build(**{name: self.read(name, days) for name in table.inputs})
                self.write(table.name, rows, days, table.cluster)

    def replace(self, changes: dict[str, tuple[DataFrame, list[dt.date]]]) -> dict[str, list[dt.date]]:
        """Replace days of tables without a source, and what is built from them; returns the days written per table."""
        touched = {}
        for name, (rows, days) in changes.items():
            self.write(name, rows, days)
            touched[name] = days
        self.propagate(touched)
        self.commit(self.ledger())
        return touched
