"""The whole run: raw files of all vehicles to result tables.

``root`` holds one folder per vehicle with its product files. Every product is
read in one scan over all vehicles. Tables that several later ones need are
written as Parquet first and read back, so no stage is computed twice and a
lost executor costs at most the stage that was running. Tables that do not need
each other are written at the same time.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetwatt.functions.times import day_of, updated_label
from fleetwatt.operators.availability import sensor_availability
from fleetwatt.operators.cleaning import require_fields
from fleetwatt.operators.components import sensor_order
from fleetwatt.operators.fleet import chosen_vehicles, label_table
from fleetwatt.operators.flows import hourly_flows
from fleetwatt.operators.ports import sensor_table, with_component
from fleetwatt.operators.rollups import drawn_hours, port_hours, total_hours
from fleetwatt.plans.dashboard import day_tables
from fleetwatt.plans.environment import waves, weather
from fleetwatt.plans.power_tables import PORT_POWER_ORDER, port_power, solar_power, summary_battery_power
from fleetwatt.schemas import (
    BATTERY_REQUIRED,
    FILE_PATTERNS,
    OUTPUT_RECORD,
    OUTPUT_SLOTS,
    PANEL_RECORD,
    VEHICLE_LABELS,
    WAVE_RECORD,
    WEATHER_RECORD,
    csv_fields,
)
from fleetwatt.session import prepare, shuffle_partitions
from fleetwatt.sources.json_records import (
    ALL_FIELDS,
    BARE_LIST,
    places_beyond,
    read_payloads,
    records,
    require_records,
    vehicle_from_path,
)
from fleetwatt.sources.tables import (
    file_counts,
    list_files,
    read_vehicle_csv,
    row_counts,
    write_csv,
    write_json,
    write_parquet,
)


@dataclass
class Inputs:
    """Where the raw files are and which vehicles to process."""

    root: str
    vehicles: Sequence[str] = tuple(key for key, _ in VEHICLE_LABELS)
    target: str = "both"
    folder: str = "{vehicle}/json"
    csv_sources: dict[str, Sequence[str]] = field(
        default_factory=lambda: {"airsea": ["wg1169", "wg1170"], "vegas": ["wg1170"]}
    )
    # False: one payload per line, as compacted landing files hold them; Spark can split these.
    whole_file: bool = True

    def chosen(self) -> list[str]:
        return chosen_vehicles(self.target, self.vehicles)

    def paths(self, product: str) -> list[str]:
        return [f"{self.root}/{self.folder.format(vehicle=v)}/{FILE_PATTERNS[product]}" for v in self.chosen()]

    def csv_paths(self, product: str) -> dict[str, str]:
        return {
            v: f"{self.root}/{self.folder.format(vehicle=v)}/{FILE_PATTERNS[product]}"
            for v in self.chosen()
            if v in self.csv_sources.get(product, ())
        }

    def vehicle_pattern(self) -> str:
        return "/" + self.folder.format(vehicle="([^/]+)") + "/[^/]*$"


def product_payloads(spark: SparkSession, inputs: Inputs, product: str) -> DataFrame:
    return vehicle_from_path(read_payloads(spark, inputs.paths(product), inputs.whole_file), inputs.vehicle_pattern())


def stored(
    table: DataFrame, path: str, order: Sequence[str] = (), partitions: Sequence[str] = (), cluster: Sequence[str] = ("vehicle",)
) -> DataFrame:
    """Write a table and read it back."""
    write_parquet(table, path, order, partitions, cluster)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def at_once(*steps: Callable[[], dict[str, DataFrame]]) -> dict[str, DataFrame]:
    """Tables of steps that do not need each other; their jobs share the cluster."""
    with ThreadPoolExecutor(len(steps)) as pool:
        parts = [pool.submit(step) for step in steps]
    return {name: table for part in parts for name, table in part.result().items()}


def port_tables(spark: SparkSession, inputs: Inputs, out: str) -> dict[str, DataFrame]:
    reports = records(product_payloads(spark, inputs, "output_power"), OUTPUT_RECORD)
    by_day = port_power(reports, sensor_table(spark)).withColumn("day", day_of(F.col("timestamp")))
    ports = stored(by_day, f"{out}/port_power", PORT_POWER_ORDER, ["day"])
    # The largest table is read once more only: all hourly figures come from its hours.
    hours = stored(port_hours(with_component(ports)), f"{out}/port_hours", ["sampleHour", "component"])
    output = stored(total_hours(hours), f"{out}/output_power_hourly", ["timestamp"])
    return {"port_power": ports, "port_hours": hours, "output_power_hourly": output}


def solar_tables(spark: SparkSession, inputs: Inputs, out: str) -> dict[str, DataFrame]:
    power = solar_power(records(product_payloads(spark, inputs, "solar"), PANEL_RECORD))
    return {"solar_power": stored(power, f"{out}/solar_power", ["timeStamp"])}


def battery_tables(spark: SparkSession, inputs: Inputs, out: str) -> dict[str, DataFrame]:
    summaries = records(product_payloads(spark, inputs, "battery"), ALL_FIELDS)
    power = stored(summary_battery_power(summaries), f"{out}/battery_power", ["timestamp"])
    # Rows exist only where both fields do, so the raw files are searched for them only without any.
    if power.isEmpty() and not summaries.isEmpty():
        require_fields(summaries, "fields", BATTERY_REQUIRED)
    return {"battery_power": power}


def power_tables(spark: SparkSession, inputs: Inputs, out: str) -> dict[str, DataFrame]:
    """Write and return port, output, solar and battery power."""
    return at_once(*[partial(step, spark, inputs, out) for step in (port_tables, solar_tables, battery_tables)])


def environment_table(
    spark: SparkSession, inputs: Inputs, out: str, product: str, schema: T.StructType, build: Callable[[DataFrame], DataFrame]
) -> dict[str, DataFrame]:
    found = records(product_payloads(spark, inputs, product), schema, envelopes=(BARE_LIST,))
    table = stored(build(found), f"{out}/{product}", ["timeStamp"])
    if table.isEmpty():
        require_records(found, product)
    return {product: table}


def decoded_tables(spark: SparkSession, inputs: Inputs) -> dict[str, DataFrame]:
    tables = {}
    for product in ("airsea", "vegas"):
        paths = inputs.csv_paths(product)
        if paths:
            tables[product] = read_vehicle_csv(spark, paths, csv_fields(product))
    return tables


def sensor_tables(spark: SparkSession, inputs: Inputs, out: str) -> dict[str, DataFrame]:
    """Write and return weather, waves, and what the sensors report."""
    sources = at_once(
        partial(environment_table, spark, inputs, out, "weather", WEATHER_RECORD, weather),
        partial(environment_table, spark, inputs, out, "waves", WAVE_RECORD, waves),
        partial(decoded_tables, spark, inputs),
    )
    available = stored(sensor_availability(sources), f"{out}/sensor_availability", ["timestamp"])
    order = stored(sensor_order(spark, available), f"{out}/sensor_order", cluster=["rank_no"])
    return {"weather": sources["weather"], "waves": sources["waves"], "sensor_availability": available, "sensor_order": order}


def widen(spark: SparkSession, files: dict[str, DataFrame]) -> None:
    """Set the shuffle width from the bytes of the raw files; adaptive execution lowers it, but cannot raise it."""
    listed = file_counts(files).agg(F.sum("bytes").alias("bytes")).first().bytes
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions(listed, at_least=width)))


def run(spark: SparkSession, inputs: Inputs, out: str, as_of: dt.date | None = None) -> dict[str, DataFrame]:
    """Build all tables below ``out`` and return them by name."""
    prepare(spark)
    found = {name: list_files(spark, inputs.paths(name)) for name in ("output_power", "solar", "battery")}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    widen(spark, found)
    try:
        return build_tables(spark, inputs, out, as_of, found)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def build_tables(
    spark: SparkSession, inputs: Inputs, out: str, as_of: dt.date | None, found: dict[str, DataFrame]
) -> dict[str, DataFrame]:
    tables = at_once(partial(power_tables, spark, inputs, out), partial(sensor_tables, spark, inputs, out))
    components = drawn_hours(tables["port_hours"])
    series = [tables[name] for name in ("output_power_hourly", "solar_power", "battery_power")]
    flows = stored(hourly_flows(components, *series), f"{out}/hourly_flows", ["sampleHour"])
    board = day_tables(components, flows, tables["battery_power"], tables["sensor_availability"], label_table(spark), as_of)

    def points() -> dict[str, DataFrame]:
        made = stored(board.series, f"{out}/series", ["panel", "series", "x"], ["day"])
        write_json(made, f"{out}/series_json", ["vehicle"], ["day", "panel", "series", "x"])
        return {"series": made}

    def keep(name: str, table: DataFrame, order: Sequence[str] = ()) -> dict[str, DataFrame]:
        return {name: stored(table, f"{out}/{name}", order)}

    tables |= {"component_hours": components, "hourly_flows": flows}
    tables |= at_once(
        points,
        partial(keep, "day_summary", board.summary, ["day"]),
        partial(keep, "default_day", board.default_day),
        partial(keep, "component_colours", board.colours, ["component_index"]),
        partial(keep, "trace_index", board.traces, ["day"]),
    )

    def rows() -> dict[str, DataFrame]:
        row_counts(tables).withColumn("updated", updated_label()).write.mode("overwrite").parquet(f"{out}/job_rows")
        return {}

    def files() -> dict[str, DataFrame]:
        file_counts(found).write.mode("overwrite").parquet(f"{out}/job_files")
        return {}

    def beyond() -> dict[str, DataFrame]:
        reports = product_payloads(spark, inputs, "output_power")
        places_beyond(reports, OUTPUT_SLOTS).write.mode("overwrite").parquet(f"{out}/job_places")
        return {}

    at_once(rows, files, beyond)
    return tables


def export_csv(tables: dict[str, DataFrame], out: str) -> None:
    """The result tables as CSV, one folder per vehicle."""
    orders = {
        "port_power": PORT_POWER_ORDER,
        "output_power_hourly": ["timestamp"],
        "solar_power": ["timeStamp"],
        "battery_power": ["timestamp"],
        "weather": ["timeStamp"],
        "waves": ["timeStamp"],
        "sensor_availability": ["timestamp"],
    }
    for name, order in orders.items():
        if name in tables:
            write_csv(tables[name].drop("day"), f"{out}/{name}", order=order)
