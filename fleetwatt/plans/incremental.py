"""The whole run kept up to date: new and changed raw files restate the days they touch, in every table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetwatt.functions.times import day_of, to_time, to_time_strict
from fleetwatt.operators.availability import sensor_availability
from fleetwatt.operators.components import component_colours, trace_spans
from fleetwatt.operators.days import day_summary, days, default_day, with_titles
from fleetwatt.operators.fleet import label_table, with_label
from fleetwatt.operators.flows import hourly_flows
from fleetwatt.operators.ports import sensor_table, with_component
from fleetwatt.operators.rollups import drawn_hours, port_hours, total_hours
from fleetwatt.operators.series import series_table
from fleetwatt.plans.environment import waves, weather
from fleetwatt.plans.job import Inputs
from fleetwatt.plans.power_tables import port_power, solar_power, summary_battery_power
from fleetwatt.schemas import OUTPUT_RECORD, PANEL_RECORD, SENSOR_SPECS, WAVE_RECORD, WEATHER_RECORD, csv_fields
from fleetwatt.session import prepare
from fleetwatt.sources.json_records import ALL_FIELDS, BARE_LIST, ENVELOPES, SOURCE_ORDER, read_payloads, records, vehicle_from_path
from fleetwatt.sources.tables import CSV_OPTIONS
from fleetwatt.streaming.day_tables import DayTables, Source, Table

JSON_PRODUCTS: dict[str, tuple[T.StructType | T.MapType, Sequence[str], Callable[[], Column]]] = {
    "output_power": (OUTPUT_RECORD, ENVELOPES, lambda: to_time_strict(F.col("timeStamp"))),
    "solar": (PANEL_RECORD, ENVELOPES, lambda: to_time_strict(F.col("timeStamp"))),
    "battery": (ALL_FIELDS, ENVELOPES, lambda: to_time_strict(F.col("fields")["gliderTimeStamp"])),
    "weather": (WEATHER_RECORD, (BARE_LIST,), lambda: to_time(F.col("timeStamp"))),
    "waves": (WAVE_RECORD, (BARE_LIST,), lambda: to_time(F.col("timeStamp"))),
}


def json_source(spark: SparkSession, inputs: Inputs, product: str) -> Source:
    schema, envelopes, time = JSON_PRODUCTS[product]

    def read(paths: Sequence[str]) -> DataFrame:
        payloads = vehicle_from_path(read_payloads(spark, list(paths), inputs.whole_file), inputs.vehicle_pattern())
        found = records(payloads, schema, envelopes).withColumn("day", day_of(time()))
        # A map has no hash that a ledger could keep; its entries in order have.
        return found.withColumn("fields", F.map_entries("fields")) if "fields" in found.columns else found

    return Source(f"{product}_records", inputs.paths(product), read)


def csv_source(spark: SparkSession, inputs: Inputs, product: str) -> Source:
    """A decoded file holds the whole history; days whose rows are as before are not touched."""
    spec = next(spec for spec in SENSOR_SPECS if spec.source == product)

    def read(paths: Sequence[str]) -> DataFrame:
        header = spark.read.options(**CSV_OPTIONS).csv(list(paths))
        names = csv_fields(product).names
        missing = sorted(set(names) - set(header.columns))
        if missing:
            raise KeyError(f"missing CSV columns: {missing}")
        place = F.struct(F.col("_metadata.file_path").alias("file"), F.lit(0).alias("pos"))
        rows = header.select(place.alias(SOURCE_ORDER), *[F.col(f"`{name}`") for name in names])
        vehicle = F.regexp_extract(f"{SOURCE_ORDER}.file", inputs.vehicle_pattern(), 1)
        return rows.select(vehicle.alias("vehicle"), "*", day_of(to_time(F.col(f"`{spec.time}`"), *spec.formats)).alias("day"))

    return Source(f"{product}_rows", list(inputs.csv_paths(product).values()), read)


def by_day(rows: DataFrame, time: str) -> DataFrame:
    return rows.where(F.col(time).isNotNull()).withColumn("day", day_of(F.col(time)))


def job_tables(spark: SparkSession, inputs: Inputs, root: str) -> DayTables:
    """All tables of ``plans.job.run`` that have days, below ``root``; ``refresh`` follows the raw files."""
    prepare(spark)
    products = [p for p in ("airsea", "vegas") if inputs.csv_paths(p)]
    sources = [json_source(spark, inputs, p) for p in JSON_PRODUCTS] + [csv_source(spark, inputs, p) for p in products]
    sensors, labels = sensor_table(spark), label_table(spark)

    def available(**tables: DataFrame) -> DataFrame:
        named = {name.removesuffix("_rows"): table.drop("day", SOURCE_ORDER) for name, table in tables.items()}
        return by_day(sensor_availability(named), "timestamp")

    def battery(battery_records: DataFrame) -> DataFrame:
        maps = battery_records.withColumn("fields", F.map_from_entries("fields"))
        return by_day(summary_battery_power(maps), "timestamp")

    def flows(port_hours: DataFrame, output_power_hourly: DataFrame, solar_power: DataFrame, battery_power: DataFrame) -> DataFrame:
        series = [t.drop("day") for t in (output_power_hourly, solar_power, battery_power)]
        return by_day(hourly_flows(drawn_hours(port_hours.drop("day")), *series), "sampleHour")

    def summary(hourly_flows: DataFrame, battery_power: DataFrame) -> DataFrame:
        return with_titles(with_label(day_summary(hourly_flows.drop("day"), battery_power.drop("day")), labels))

    def series(port_hours: DataFrame, hourly_flows: DataFrame, battery_power: DataFrame, sensor_availability: DataFrame) -> DataFrame:
        parts = [t.drop("day") for t in (hourly_flows, battery_power, sensor_availability)]
        return series_table(drawn_hours(port_hours.drop("day")), *parts)

    tables = [
        Table("port_power", ["output_power_records"], lambda output_power_records: by_day(port_power(output_power_records.drop("day"), sensors), "timestamp")),
        Table("port_hours", ["port_power"], lambda port_power: by_day(port_hours(with_component(port_power)), "sampleHour")),
        Table("output_power_hourly", ["port_hours"], lambda port_hours: by_day(total_hours(port_hours), "timestamp")),
        Table("solar_power", ["solar_records"], lambda solar_records: by_day(solar_power(solar_records.drop("day")), "timeStamp")),
        Table("battery_power", ["battery_records"], battery),
        Table("weather", ["weather_records"], lambda weather_records: by_day(weather(weather_records.drop("day")), "timeStamp")),
        Table("waves", ["waves_records"], lambda waves_records: by_day(waves(waves_records.drop("day")), "timeStamp")),
        Table("sensor_availability", ["weather", "waves", *[f"{p}_rows" for p in products]], available),
        Table("hourly_flows", ["port_hours", "output_power_hourly", "solar_power", "battery_power"], flows),
        Table("day_summary", ["hourly_flows", "battery_power"], summary),
        Table("series", ["port_hours", "hourly_flows", "battery_power", "sensor_availability"], series),
    ]
    return DayTables(spark, root, sources, tables)


def overview(tables: DayTables, as_of=None) -> dict[str, DataFrame]:
    """The small tables without days: default day, component colours and traces, from the hourly tables."""
    flows, components = tables.read("hourly_flows"), drawn_hours(tables.read("port_hours"))
    colours = component_colours(components)
    return {
        "default_day": default_day(flows, as_of),
        "component_colours": colours,
        "trace_index": trace_spans(days(flows), colours),
    }
