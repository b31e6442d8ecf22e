"""The operators bound to the given tables, one query per operator.

``events`` plays the telemetry: five users make a vehicle, ``event_type`` is the
component and names the role of a row (error: ports that draw power, view:
output, click: solar, purchase: battery). ``lineitem`` plays the port reports,
``orders`` the weather reports.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetwatt.functions.numbers import scaled, to_number, total
from fleetwatt.functions.times import day_of, day_range, hour_of, to_time
from fleetwatt.operators.availability import sensor_availability
from fleetwatt.operators.census import census
from fleetwatt.operators.cleaning import blank_marks, keep_last, missing_fields
from fleetwatt.operators.components import component_colours, in_sensor_order, sensor_order, trace_index
from fleetwatt.operators.days import (
    battery_change,
    daily_energy,
    day_summary,
    days,
    default_day,
    first_last,
    flag_default_day,
    with_titles,
)
from fleetwatt.operators.fleet import label_table, select_vehicles, with_label
from fleetwatt.operators.flows import flows_of_rows, hour_spine, hourly_flows, spine_join
from fleetwatt.operators.intervals import interval_join
from fleetwatt.operators.order import first_rows
from fleetwatt.operators.partials import hour_figures, hour_states, merged, updated
from fleetwatt.operators.ports import label_ports, sensor_table, unpivot_ports, with_component
from fleetwatt.operators.rollups import (
    above_threshold,
    component_hours,
    component_pivot,
    hourly_mean,
    hourly_total,
    port_hours,
    positive_sum,
)
from fleetwatt.operators.series import series_table
from fleetwatt.plans.environment import waves, weather
from fleetwatt.plans.power_tables import PORT_POWER_ORDER, battery_power, port_power, solar_power
from fleetwatt.schemas import OUTPUT_RECORD, PANEL_RECORD, POWER_THRESHOLD_W, WAVE_RECORD, WEATHER_RECORD, SensorSpec, text_fields
from fleetwatt.session import prepare, shared_dir
from fleetwatt.sources.json_records import (
    ALL_FIELDS,
    BARE_LIST,
    SOURCE_ORDER,
    file_census,
    read_payloads,
    records,
    vehicle_from_path,
)
from fleetwatt.sources.tables import file_counts, list_files, read_csv, row_counts, write_bucketed, write_csv, write_ordered, write_parquet
from fleetwatt.streaming.day_tables import DayTables, Source, Table
from fleetwatt.streaming.dedup import drop_repeats
from fleetwatt.streaming.hourly import hourly_store, mark_late
from fleetwatt.streaming.ingest import drain
from fleetwatt.streaming.moved import RECORDS, RecordStore
from fleetwatt.streaming.restate import DayStore

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
AS_OF = dt.date(2024, 1, 15)
SCALE = 4

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def vehicle_key() -> Column:
    return F.concat(F.lit("wg"), F.floor(F.col("user_id") / 5).cast("string"))


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry_rows(table(spark, sf_dir, "events"))


def telemetry_rows(events: DataFrame) -> DataFrame:
    return events.select(
        vehicle_key().alias("vehicle"),
        "event_id",
        "ts",
        hour_of(F.col("ts")).alias("sampleHour"),
        F.col("event_type").alias("component"),
        "value",
        "props",
    )


def role(rows: DataFrame, component: str, time: str, value: str) -> DataFrame:
    """The time series that one component plays."""
    return rows.where(F.col("component") == component).select(
        "vehicle", F.col("ts").alias(time), F.col("value").alias(value)
    )


def drawing_rows(rows: DataFrame) -> DataFrame:
    return above_threshold(rows.where("component = 'error'"), "value")


def power_series(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    return (
        role(rows, "view", "timestamp", "total_output_power_W"),
        role(rows, "click", "timeStamp", "solar_power_W"),
        role(rows, "purchase", "timestamp", "total_battery_power_W"),
    )


def rounded(frame: DataFrame, *names: str, places: int = 6) -> DataFrame:
    return frame.withColumns({name: F.round(name, places) for name in names})


def props_k(column: str = "props") -> Column:
    return F.get_json_object(column, "$.k")


# --- roll-ups ---


def q_hourly_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = telemetry(spark, sf_dir)
    return hourly_total(rows, "value", "sampleHour", "total_value", scale=SCALE)


def q_hourly_total_per_port(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = telemetry(spark, sf_dir).selectExpr("*", "component as domain", "0 as slot", "0 as port")
    return rounded(hourly_total(rows, "value", "sampleHour", "total_value", per_port="mean"), "total_value")


def q_hourly_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = hourly_mean(telemetry(spark, sf_dir), "ts", "value", "mean_value", by=["vehicle", "component"])
    return rounded(means, "mean_value").withColumnRenamed("sampleHour", "sample_hour")


def q_positive_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").withColumnsRenamed({"l_returnflag": "vehicle", "l_shipdate": "ts"})
    return positive_sum(rows, "ts", "l_discount", "positive_sum", scale=SCALE)


def q_component_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = above_threshold(telemetry(spark, sf_dir), "value")
    # One component is off the list.
    return component_pivot(rows, EVENT_TYPES[:-1], "value", scale=SCALE, other="other").withColumnRenamed("sampleHour", "sample_hour")


def q_component_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = above_threshold(telemetry(spark, sf_dir), "value")
    return component_hours(rows, "value", scale=SCALE).withColumnsRenamed(
        {"sampleHour": "sample_hour", "power_W": "power_w"}
    )


def q_port_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = port_hours(telemetry(spark, sf_dir), "value", threshold=10.0, scale=SCALE)
    return hours.withColumnsRenamed({"sampleHour": "sample_hour", "total_W": "total_w", "power_W": "power_w"})


# --- flows and days ---


def flow_names(flows: DataFrame) -> DataFrame:
    return rounded(flows, "total_usage_W", "solar_gain_W", "total_battery_power_W").withColumnsRenamed(
        {
            "sampleHour": "sample_hour",
            "total_usage_W": "total_usage",
            "solar_gain_W": "solar_gain",
            "total_battery_power_W": "battery",
        }
    )


MEASURES = {"total_usage_W": "view", "solar_gain_W": "click", "total_battery_power_W": "purchase"}


def flows(spark: SparkSession, sf_dir: str, battery: bool = True) -> DataFrame:
    return roles(table(spark, sf_dir, "events"), battery)


def roles(events: DataFrame, battery: bool = False) -> DataFrame:
    """All series come from one table, so their roles are told apart in one scan."""
    component, value = F.col("component"), F.col("value")
    measures = {mean: F.when(component == name, value) for mean, name in list(MEASURES.items())[: 3 if battery else 2]}
    return flows_of_rows(telemetry_rows(events), (component == "error") & (value > POWER_THRESHOLD_W), measures)


def q_spine_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = telemetry(spark, sf_dir)
    output, solar, battery = power_series(rows)
    joined = spine_join(
        hour_spine(drawing_rows(rows)),
        hourly_mean(output, "timestamp", "total_output_power_W", "total_usage_W"),
        hourly_mean(solar, "timeStamp", "solar_power_W", "solar_gain_W"),
        hourly_mean(battery, "timestamp", "total_battery_power_W", "total_battery_power_W"),
    )
    return flow_names(joined)


def q_hourly_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = telemetry(spark, sf_dir)
    return flow_names(hourly_flows(drawing_rows(rows), *power_series(rows)))


def q_flows_of_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flow_names(flows(spark, sf_dir))


def q_daily_energy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(daily_energy(flows(spark, sf_dir, battery=False)), "used_wh", "gained_wh")


def q_first_last_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = telemetry(spark, sf_dir)
    ends = first_last(role(rows, "purchase", "timestamp", "power"), "timestamp", "power")
    change = battery_change(days(rows, "ts").drop("day_index"), ends)
    return rounded(change, "delta")


def q_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return days(telemetry(spark, sf_dir), "ts")


def q_default_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return default_day(telemetry(spark, sf_dir), AS_OF, "ts")


def q_day_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    battery = power_series(telemetry(spark, sf_dir))[2]
    return rounded(day_summary(flows(spark, sf_dir, battery=False), battery), "used_wh", "gained_wh", "delta")


def q_day_window_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = telemetry(spark, sf_dir).select("vehicle", "event_id", "ts")
    return flag_default_day(rows, "ts", default_day(rows, AS_OF, "ts")).select("event_id", "in_selected_day")


def q_trace_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = telemetry(spark, sf_dir)
    return trace_index(days(rows, "ts"), rows.select("vehicle", "component").distinct())


def q_series_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = telemetry(spark, sf_dir)
    bars = component_hours(above_threshold(rows, "value"), "value", scale=SCALE)
    available = sensor_availability(
        {"events": rows.withColumn("k", props_k())}, [SensorSpec("k", "events", "ts", "k")]
    )
    series = series_table(bars, flows(spark, sf_dir), power_series(rows)[2], available)
    return rounded(series, "y")


# --- ports ---


def q_port_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each lineitem as a wide record of four places, some of them unused."""
    wide = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        "l_linenumber as portNumber1",
        "5 as moduleNumber1",
        "l_quantity as reading1",
        "if(l_returnflag = 'N', 0, 2) as portNumber2",
        "if(l_linestatus = 'O', 0, 5) as moduleNumber2",
        "l_extendedprice as reading2",
        "0 as portNumber3",
        "l_linenumber - 1 as moduleNumber3",
        "l_discount as reading3",
        "cast(null as int) as portNumber4",
        "if(l_tax > 0, 7, null) as moduleNumber4",
        "l_tax as reading4",
    )
    return unpivot_ports(wide, ["reading"], 4).withColumnsRenamed({"portNumber": "port", "moduleNumber": "module"})


def q_port_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.broadcast(
        spark.createDataFrame(
            [("N", "O", " open "), ("R", "F", "returned"), ("A", "F", "  ")], "slot string, port string, sensor string"
        )
    )
    ports = table(spark, sf_dir, "lineitem").selectExpr(
        "l_linenumber as domain", "l_returnflag as slot", "l_linestatus as port"
    )
    return with_component(label_ports(ports, names)).groupBy("component").agg(F.count("*").alias("n"))


PORT_COLUMNS = (
    "vehicle timestamp sampleHour domain slot port sensor avg_power_W avg_voltage_V avg_current_A port_status".split()
)


def port_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each lineitem as a raw report of two ports, one of them with a name."""
    return payloads(
        table(spark, sf_dir, "lineitem"),
        "l_returnflag",
        """struct(cast(l_shipdate as string) as timeStamp, l_linenumber as powerDomain,
        l_partkey as portNumber1, l_suppkey as moduleNumber1, l_quantity as avgPower1, l_extendedprice as avgVoltage1,
        l_discount as avgCurrent1, l_linenumber as portStatus1,
        1 as portNumber33, l_linenumber as moduleNumber33, l_tax as avgPower33, 'n/a' as avgVoltage33)""",
    )


def q_port_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns of the port table from raw JSON reports."""
    ports = port_power(records(port_reports(spark, sf_dir), OUTPUT_RECORD), sensor_table(spark))
    return ports.select(*[F.col(name).alias(re.sub("(?<!^)([A-Z])", r"_\1", name).lower().replace("__", "_")) for name in PORT_COLUMNS])


def q_port_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The port table as its files hold it, and whether any row's sort key falls below that of the row before."""
    out = shared_dir(spark, "ports")
    ports = port_power(records(port_reports(spark, sf_dir), OUTPUT_RECORD), sensor_table(spark))
    write_parquet(ports, out, PORT_POWER_ORDER)
    # A number in place of the path, which is long, the same in its first bytes, and would travel with every row.
    rows = spark.read.parquet(out).select(
        "*", F.xxhash64("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_place")
    )
    inside = Window.partitionBy("_file", "vehicle").orderBy("_place")
    before = F.struct(*[F.lag(name).over(inside).alias(name) for name in PORT_POWER_ORDER])
    falls = F.col("_before.timestamp").isNotNull() & (F.struct(*PORT_POWER_ORDER) < F.col("_before"))
    return rows.withColumn("_before", before).groupBy("vehicle").agg(
        F.count("*").alias("n"), F.count_if(falls).alias("out_of_order")
    )


def q_top20(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_quantity", "l_extendedprice"
    )
    return first_rows(rows, rows.columns)


def payloads(rows: DataFrame, vehicle: str, record: str) -> DataFrame:
    """Each row as the JSON payload of one record, in the form a file scan delivers.

    Reports of an order stand in one place, as those of a day do in a file. This
    deals the rows out in the same way at every size.
    """
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    text = F.concat(F.lit('{"recordData":['), F.to_json(F.expr(record)), F.lit("]}"))
    zero = F.lit(0).cast("long")
    return rows.repartition(tasks, "l_orderkey").select(
        F.col(vehicle).alias("vehicle"),
        F.lit("row").alias("file"),
        zero.alias("chunk"),
        zero.alias("line"),
        text.alias("value"),
    )


def q_port_power(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw JSON port reports to power per hour and component."""
    reports = payloads(
        table(spark, sf_dir, "lineitem"),
        "l_returnflag",
        """struct(cast(l_shipdate as string) as timeStamp, l_linenumber as powerDomain,
        l_linenumber as portNumber1, 5 as moduleNumber1, l_quantity as avgPower1,
        if(l_linestatus = 'O', 3, 9) as portNumber2, 32 as moduleNumber2, l_discount * 10 as avgPower2,
        0 as portNumber3, 0 as moduleNumber3, 99.0D as avgPower3,
        107 as portNumber33, 32 as moduleNumber33, l_tax * 10 as avgPower33)""",
    )
    ports = port_power(records(reports, OUTPUT_RECORD), sensor_table(spark))
    hours = component_hours(with_component(above_threshold(ports)), scale=SCALE)
    return hours.withColumnsRenamed({"sampleHour": "sample_hour", "power_W": "power_w"})


def q_solar_power(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw JSON solar reports to solar power per report time."""
    reports = payloads(
        table(spark, sf_dir, "lineitem"),
        "l_returnflag",
        """struct(cast(l_shipdate as string) as timeStamp, 1 as portNumber1, 2 as moduleNumber1, l_discount as panelPower1,
        2 as portNumber2, 2 as moduleNumber2, if(l_linestatus = 'O', -l_tax, l_tax) as panelPower2,
        0 as portNumber3, 0 as moduleNumber3, 50.0D as panelPower3)""",
    )
    power = solar_power(records(reports, PANEL_RECORD), scale=SCALE)
    return power.withColumnsRenamed({"timeStamp": "ts", "solar_power_W": "solar_power_w"})


# --- cleaning ---


def q_dedup_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = telemetry(spark, sf_dir).select("vehicle", F.col("sampleHour").alias("key_hour"), "ts", "event_id", "value")
    return keep_last(rows, ["vehicle", "key_hour"], ["ts", "event_id"]).drop("ts")


def q_numeric_coerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = (
        F.when(F.col("event_type") == "view", F.concat(F.lit("  "), props_k(), F.lit(" ")))
        .when(F.col("event_type") == "error", F.lit("NaN"))
        .when(F.col("event_type") == "signup", F.concat(props_k(), F.lit("d")))
        .when(F.col("event_type") == "purchase", F.concat(props_k(), F.lit("e1")))
        .otherwise(props_k())
    )
    return table(spark, sf_dir, "events").select("event_id", to_number(text).alias("k"))


def q_time_coerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    plain = F.col("ts").cast("string")
    text = (
        F.when(F.col("event_type") == "click", F.date_format("ts", "dd/MM/yyyy HH:mm:ss"))
        .when(F.col("event_type") == "signup", F.replace(plain, F.lit(" "), F.lit("T")))
        .when(F.col("event_type") == "purchase", F.concat(F.lit(" " * 70), plain, F.lit("+02:00")))
        .when(F.col("event_type") == "error", F.lit("bad"))
        .otherwise(plain)
    )
    parsed = table(spark, sf_dir, "events").select("event_id", to_time(text, "dd/MM/yyyy HH:mm:ss").alias("ts2"))
    return parsed.na.drop(subset=["ts2"])


def q_sentinel_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = blank_marks(table(spark, sf_dir, "lineitem"), ["l_quantity"], [1.0, 50.0])
    return rows.groupBy("l_linenumber").agg(
        F.count("*").alias("n"), F.count("l_quantity").alias("n_valid"), F.round(F.avg("l_quantity"), 6).alias("mean_valid")
    )


def q_unit_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("value").alias("wind_speed_kt"),
        F.round(scaled(F.col("value"), 0.514444), 8).alias("wind_speed_ms"),
    )


def q_milli_to_unit(spark: SparkSession, sf_dir: str) -> DataFrame:
    power = battery_power(F.col("ts"), props_k(), telemetry(spark, sf_dir))
    return power.withColumnRenamed("total_battery_power_W", "k_unit")


def q_schema_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(F.from_json("props", ALL_FIELDS).alias("fields"))
    return missing_fields(rows, "fields", ["k", "gliderTimeStamp", "totalBatteryPower"])


def weather_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as raw weather reports; most dates repeat, the highest order key comes last."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("vehicle"),
        F.struct("o_orderkey").alias(SOURCE_ORDER),
        F.col("o_orderdate").cast("string").alias("timeStamp"),
        F.col("o_custkey").cast("string").alias("latitude"),
        F.col("o_orderpriority").alias("avgTemp(C)"),
        F.col("o_totalprice").cast("string").alias("avgWindSpeed(kt)"),
    )


def q_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = weather_rows(spark, sf_dir)
    raw = rows.select("*", *[F.lit(None).cast("string").alias(n) for n in WEATHER_RECORD.names if n not in rows.columns])
    cleaned = weather(raw)
    return rounded(cleaned, "wind_speed_ms").select(
        "vehicle", F.col("timeStamp").alias("ts"), "latitude", "air_temperature", "wind_speed_kt", "wind_speed_ms"
    )


def q_waves(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("vehicle"),
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice").alias(SOURCE_ORDER),
        F.col("l_shipdate").cast("string").alias("timeStamp"),
        F.col("l_extendedprice").cast("string").alias("latitude"),
        F.expr("case l_quantity when 1 then '9999.0' when 50 then '-9999' else string(l_quantity) end").alias("hs (m)"),
        F.expr("if(l_linenumber = 7, 'n/a', string(l_linenumber))").alias("samples"),
    )
    raw = rows.select("*", *[F.lit(None).cast("string").alias(n) for n in WAVE_RECORD.names if n not in rows.columns])
    return waves(raw).select(
        "vehicle", F.col("timeStamp").alias("ts"), "latitude", "significant_wave_height_m", "n_samples"
    )


# --- availability, components, fleet ---


def q_availability(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = {
        "events": telemetry(spark, sf_dir).withColumn("k", props_k()),
        "orders": table(spark, sf_dir, "orders").withColumnRenamed("o_orderstatus", "vehicle"),
        "lineitem": table(spark, sf_dir, "lineitem").withColumnRenamed("l_returnflag", "vehicle"),
    }
    specs = [
        SensorSpec("value", "events", "ts", "value"),
        SensorSpec("props_k", "events", "ts", "k"),
        SensorSpec("priority", "orders", "o_orderdate", "o_orderpriority"),
        SensorSpec("order", "orders", "o_orderdate", "o_totalprice"),
        SensorSpec("ship", "lineitem", "l_shipdate", "l_quantity"),
        SensorSpec("not fitted", "vegas", "sensor_time", "Ocean CO2 Ave"),
    ]
    return sensor_availability(sources, specs)


def q_availability_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sensor times with the place of their sensor on the axis, as a chart sorts them."""
    found = sensor_availability(
        {"events": telemetry(spark, sf_dir).withColumn("k", props_k())},
        [SensorSpec("Vaisala", "events", "ts", "value"), SensorSpec("pCO2", "events", "ts", "k")],
    )
    return in_sensor_order(found).groupBy("vehicle", "sensor", "rank_no").agg(
        F.count("*").alias("n"), F.min("timestamp").alias("first_time"), F.max("timestamp").alias("last_time")
    )


def q_sensor_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    sensors = table(spark, sf_dir, "events").select(F.col("event_type").alias("sensor"))
    return sensor_order(spark, sensors, ["view", "click", "signup", "purchase"], ["error"])


def q_component_colour(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").withColumnsRenamed({"p_brand": "vehicle", "p_name": "component"})
    return component_colours(rows).select("vehicle", "component", "colour_index")


def q_vehicle_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = (
        telemetry(spark, sf_dir)
        .groupBy("vehicle", day_of(F.col("ts")).alias("day"))
        .agg(total(F.col("value"), SCALE).alias("total"))
    )
    labels = label_table(spark, [("wg0", "Alpha"), ("wg1", "Beta")])
    return with_label(daily, labels).select(F.col("label").alias("vehicle"), "day", "total")


def q_target_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly totals of one chosen vehicle beside those of both."""
    rows = telemetry(spark, sf_dir)

    def totals(chosen: DataFrame, target: str) -> DataFrame:
        return hourly_total(chosen, "value", "sampleHour", "total_value", scale=SCALE).withColumn("target", F.lit(target))

    # Both means every vehicle of the table, so there is nothing to choose.
    return totals(select_vehicles(rows, "wg1", ["wg1"]), "wg1").unionByName(totals(rows, "both"))


def q_day_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The figures that the titles of a day show, read back from their text."""
    battery = power_series(telemetry(spark, sf_dir))[2]
    summary = day_summary(flows(spark, sf_dir, battery=False), battery)
    titled = with_titles(with_label(summary, label_table(spark, [("wg0", "Alpha")])))

    def figure(column: str, lead: str) -> Column:
        return F.round(F.regexp_extract(column, lead + r" ([-+0-9.]+) ", 1).cast("double"), 0)

    return titled.select(
        "vehicle",
        "day",
        F.regexp_extract("title", "^([^:]*):", 1).alias("label"),
        F.regexp_extract("title", r"Date: ([0-9-]+) ", 1).alias("day_text"),
        *[
            (F.abs(figure(column, lead) - F.col(value)) <= 0.56).alias(f"shows_{value}")
            for column, lead, value in [
                ("title", "Daily gained:", "gained_wh"),
                ("title", "Daily used:", "used_wh"),
                ("battery_title", "Start:", "battery_start"),
                ("battery_title", "End:", "battery_end"),
                ("battery_title", "Daily gain/loss:", "delta"),
            ]
        ],
    )


def q_title_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles of made days, as text; many figures lie half way between two tenths."""
    price = F.col("l_extendedprice")
    figures = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_returnflag").alias("label"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("day_label"),
        (F.col("l_quantity") / 8).alias("gained_wh"),
        (price / 64).alias("used_wh"),
        (F.col("l_discount") - 0.05).alias("battery_start"),
        (F.col("l_quantity") / 20).alias("battery_end"),
        ((F.col("l_tax") - 0.04) * F.col("l_quantity") / 4).alias("delta"),
    )
    return with_titles(figures).select("l_orderkey", "l_linenumber", "title", "battery_title")


def q_interval_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and their sum in each of many overlapping intervals of five minutes to 45 days."""
    rows = telemetry(spark, sf_dir)
    lengths = F.array(*[F.expr(f"interval {text}") for text in ("5 minutes", "1 hour", "6 hours", "1 day", "3 days", "14 days", "45 days")])
    length = F.element_at(lengths, (F.col("event_id") % 7 + 1).cast("int"))
    intervals = rows.where("component = 'signup'").select(
        "vehicle", F.col("event_id").alias("interval_id"), F.col("ts").alias("start"), (F.col("ts") + length).alias("stop")
    )
    held = interval_join(rows.select("vehicle", "ts", "value"), "ts", intervals, "start", "stop")
    return held.groupBy("interval_id").agg(F.count("*").alias("n"), total(F.col("value"), SCALE).alias("total"))


def q_partial_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly figures from states of parts, merged, after some records were taken back and corrected ones added."""
    rows = table(spark, sf_dir, "events").select("event_type", "event_id", "ts", "value")
    by = ["event_type"]
    parts = [hour_states(rows.where(F.col("event_id") % 3 == n), "ts", "value", by, SCALE) for n in (2, 0, 1)]
    wrong = rows.where(F.col("event_id") % 11 == 0)
    right = wrong.withColumn("value", F.col("value") + 2)
    corrected = rows.where(F.col("event_id") % 11 > 0).unionByName(right)

    def again(hours: DataFrame) -> DataFrame:
        hour = hour_of(F.col("ts")).alias("sampleHour")
        found = corrected.select("*", hour).join(hours, ["event_type", "sampleHour"], "left_semi")
        return hour_states(found.drop("sampleHour"), "ts", "value", by, SCALE)

    state = updated(merged(parts, by), hour_states(right, "ts", "value", by, SCALE), hour_states(wrong, "ts", "value", by, SCALE), again, by)
    return hour_figures(state, by).join(state.select("event_type", "sampleHour", "first_value", "last_value"), ["event_type", "sampleHour"]).select(
        "event_type", F.col("sampleHour").alias("sample_hour"), "total", "mean_value", "n", "first_value", "last_value"
    )


# --- sources and sinks ---


def q_global_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ports as their files hold them, read in the order of their names: rows, and rows that fall below the one before."""
    out = shared_dir(spark, "ordered")
    names = ["l_returnflag", "l_shipdate", "l_linenumber", "l_suppkey", "l_partkey", "l_orderkey"]
    write_ordered(table(spark, sf_dir, "lineitem").select(*names), out, names)
    file = F.col("_metadata.file_path").alias("_file")
    rows = spark.read.parquet(out).select(F.struct(*names).alias("key"), file, F.monotonically_increasing_id().alias("_place"))
    inside = Window.partitionBy("_file").orderBy("_place")
    falls = rows.withColumn("falls", F.col("key") < F.lag("key").over(inside)).groupBy("_file").agg(
        F.count("*").alias("n"), F.count_if("falls").alias("falls"), F.min("key").alias("low"), F.max("key").alias("high")
    )
    # One row per file.
    borders = falls.withColumn("border", (F.col("low") < F.lag("high").over(Window.orderBy("_file"))).cast("long"))
    return borders.agg(F.sum("n").alias("n"), F.sum(F.col("falls") + F.coalesce("border", F.lit(0))).alias("out_of_order"))


def q_bucketed_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spine join of hourly tables that are stored in buckets of vehicle and hour, and so joined where they lie."""
    rows = telemetry(spark, sf_dir)
    output, solar, battery = power_series(rows)
    by = ["vehicle", "sampleHour"]
    hourly = [
        hour_spine(drawing_rows(rows)),
        hourly_mean(output, "timestamp", "total_output_power_W", "total_usage_W"),
        hourly_mean(solar, "timeStamp", "solar_power_W", "solar_gain_W"),
        hourly_mean(battery, "timestamp", "total_battery_power_W", "total_battery_power_W"),
    ]
    out = shared_dir(spark, "buckets")
    name = f"hourly_{out.rsplit('-', 1)[1]}"
    stored = [write_bucketed(side, f"{out}/{n}", f"{name}_{n}", by, 8) for n, side in enumerate(hourly)]
    # Sides of no proven size are joined by their buckets, not broadcast.
    joined = spine_join(stored[0], *[side.hint("merge") for side in stored[1:]])
    return flow_names(joined)


def q_file_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    return census(table(spark, sf_dir, "orders"), "o_orderkey", table(spark, sf_dir, "lineitem"), "l_orderkey")


def q_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_counts({name: table(spark, sf_dir, name) for name in TABLES})


def landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written as payload lines in both envelopes, some with elements that are no records, and scanned."""
    record = F.to_json(F.struct("event_id", "user_id", "event_type", "value"))
    text = (
        F.when(F.col("event_type") == "error", F.concat(F.lit("["), record, F.lit("]")))
        .when(F.col("event_type") == "click", F.concat(F.lit('[5, '), record, F.lit(', "z", [1], null]')))
        .when(F.col("event_type") == "signup", F.concat(F.lit('{"recordData": ['), record, F.lit(", 7]}")))
        .when(F.col("event_type") == "purchase", F.concat(F.lit('{"recordData": ['), record, F.lit(", "), record, F.lit("]}")))
        .otherwise(F.concat(F.lit('{"recordData":['), record, F.lit('], "x": 1}')))
    )
    landing = shared_dir(spark, "landing")
    table(spark, sf_dir, "events").select(text.alias("value")).write.text(landing)
    return read_payloads(spark, f"{landing}/*.txt", whole_file=False)


EVENT_RECORD = text_fields(["event_id", "user_id", "event_type", "value"])


def q_json_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = landed(spark, sf_dir)
    loaders = [
        records(found, EVENT_RECORD).withColumn("loader", F.lit("both")),
        records(found, EVENT_RECORD, envelopes=(BARE_LIST,)).withColumn("loader", F.lit("list")),
    ]
    return loaders[0].unionByName(loaders[1]).select(
        "loader",
        F.col("event_id").cast("long").alias("event_id"),
        F.col("user_id").cast("long").alias("user_id"),
        "event_type",
        to_number(F.col("value")).alias("value"),
    )


def q_payload_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    return file_census(landed(spark, sf_dir)).agg(F.sum("n").alias("n"))


def daily_files(spark: SparkSession, sf_dir: str) -> str:
    """Events as daily product files in vehicle folders, whole payloads, also files without any record."""
    out = shared_dir(spark, "files")
    rows = table(spark, sf_dir, "events").select(
        F.concat(F.lit("wg"), F.pmod("user_id", F.lit(2)).cast("string")).alias("vehicle"),
        F.when(F.col("event_type") == "click", "amps-solar").otherwise("amps").alias("product"),
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
        F.when(F.dayofmonth("ts") % 7 > 0, F.struct("event_id", "ts", "value")).alias("record"),
        "event_id",
    )
    listed = F.transform(F.array_sort(F.collect_list(F.struct("event_id", "record"))), lambda x: x["record"])
    files = rows.groupBy("vehicle", "product", "day").agg(F.filter(listed, lambda x: x.isNotNull()).alias("found"))
    # Every seventh day has files without a record.
    text = F.concat(F.lit('{"recordData":'), F.to_json("found"), F.lit("}")).alias("value")
    files.select("vehicle", "product", "day", text).repartition(4, "vehicle", "product", "day").write.partitionBy(
        "vehicle", "product", "day"
    ).text(out)
    return out


def q_daily_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole daily files of one product: vehicle from the path, last copy by file order, records per file."""
    out = daily_files(spark, sf_dir)
    found = vehicle_from_path(read_payloads(spark, f"{out}/vehicle=*/product=amps/day=*/*.txt"), "/vehicle=([^/]+)/product=")
    day = F.regexp_extract("file", "/day=([^/]+)/", 1)
    return file_census(found).select("vehicle", day.alias("day"), "n")


def q_source_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files found per source; the pattern of one product does not take in the other's."""
    out = daily_files(spark, sf_dir)
    sources = {name: list_files(spark, f"{out}/vehicle=*/product={name}/day=*/*.txt") for name in ("amps", "amps-solar")}
    return file_counts(sources).drop("bytes")


def q_empty_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files without any record, which the guard on empty content is about."""
    return q_daily_files(spark, sf_dir).where("n = 0").groupBy("vehicle").agg(F.count("*").alias("empty_files"))


def q_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shared_dir(spark, "csv")
    rows = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("vehicle"), "event_id", "ts", "value", "props"
    )
    write_csv(rows, out, order=["ts"])
    back = read_csv(spark, out, text_fields(["vehicle", "event_id", "ts", "value", "props"]))
    return back.select(
        F.col("vehicle").alias("event_type"),
        F.col("event_id").cast("long").alias("event_id"),
        to_time(F.col("ts")).alias("ts"),
        to_number(F.col("value")).alias("value"),
        "props",
    )


# --- streams ---


def arrivals(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The events in three files that arrive in no order of time, with repeats and corrections.

    The second file repeats a part of the first one. The last one brings
    corrected values, and for some records two copies of which the later one is
    what the first file had.
    """
    events = table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value", F.lit(0).alias("pos"))
    thirds = [events.where(F.col("event_id") % 3 == n) for n in range(3)]
    again = thirds[0].where(F.col("event_id") % 2 == 0)
    corrected = thirds[0].where(F.col("event_id") % 7 == 0).withColumn("value", F.col("value") + 1)
    wavering = thirds[0].where(F.col("event_id") % 7 == 1)
    last = [thirds[2], corrected, wavering.withColumn("value", F.col("value") + 5), wavering.withColumn("pos", F.lit(1))]
    return [thirds[0], thirds[1].unionByName(again), reduce(DataFrame.unionByName, last)]


def follow_files(spark: SparkSession, store: DayStore, files: list[DataFrame], landing: str) -> None:
    """Land the files one after another and let the store follow the stream of them."""
    for number, rows in enumerate(files):
        rows.write.parquet(f"{landing}/file={number}")
        store.follow(spark.readStream.schema(rows.schema).parquet(f"{landing}/*"))


def followed(spark: SparkSession, sf_dir: str, purpose: str) -> DayStore:
    prepare(spark)
    out = shared_dir(spark, purpose)
    store = hourly_store(spark, out, "ts", "value", ["event_type"], ["event_id", "ts"], ["pos"], SCALE)
    follow_files(spark, store, arrivals(spark, sf_dir), f"{out}/landing")
    return store


def q_stream_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly figures of a stream of several files out of time order: each record counts once, with its last value."""
    return followed(spark, sf_dir, "stream-hourly").read().select(
        "event_type", F.col("sampleHour").alias("sample_hour"), "total", "mean_value", "n"
    )


def q_stream_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records per file of a stream, and how many came later than the delay; all of them are kept."""
    kept = mark_late(followed(spark, sf_dir, "stream-late").last_copies(), "ts")
    return kept.groupBy("batch").agg(F.count("*").alias("n"), F.count_if("late").alias("n_late"))


def q_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files in order of time, each with every record twice and the last day of the file before once more."""
    prepare(spark)
    rows = table(spark, sf_dir, "events").select("event_id", "ts", "value")
    ends = rows.agg(F.min(day_of(F.col("ts"))).alias("low"), F.max(day_of(F.col("ts"))).alias("high")).first()
    out = shared_dir(spark, "stream-dedup")
    for number in range(3 if ends.low else 0):
        span = (ends.high - ends.low).days + 1
        first, last = (ends.low + dt.timedelta(days=span * n // 3) for n in (number, number + 1))
        again = first - dt.timedelta(days=1 if number else 0)
        part = rows.where(day_range(F.col("ts"), again, last - dt.timedelta(days=1)))
        part.unionByName(part).write.parquet(f"{out}/landing/file={number}")
        stream = spark.readStream.schema(rows.schema).parquet(f"{out}/landing/*")
        once = drop_repeats(stream, "ts", ["event_id"])
        drain(once, f"{out}/checkpoint").format("parquet").start(f"{out}/result").awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{out}/result")


def q_restate_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days arrive, then the last two again with corrected values, some of them taken back in the same batch."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", "value", F.lit(0).alias("pos"))
    out = shared_dir(spark, "restate")

    def build(rows: DataFrame) -> DataFrame:
        return rows.groupBy("day").agg(total(F.col("value"), SCALE).alias("total"))

    store = DayStore(spark, out, "ts", ["event_id", "ts"], ["pos"], build, cluster=[])
    last = events.agg(F.max(day_of(F.col("ts"))).alias("day")).first().day
    again = events.where(day_range(F.col("ts"), last - dt.timedelta(days=1), last))
    corrected = again.withColumn("value", F.col("value") + 1)
    taken_back = again.where(F.col("event_id") % 5 == 0).withColumn("pos", F.lit(1))
    follow_files(spark, store, [events, corrected.unionByName(taken_back)], f"{out}/landing")
    return store.read()


def q_stream_moved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All records arrive, a fifth of them again with a later time, of these half once more with the first time and another value."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "ts", "value")
    prepare(spark)
    out = shared_dir(spark, "moved")

    def build(records: DataFrame) -> DataFrame:
        return records.groupBy("event_type", "day").agg(total(F.col("value"), SCALE).alias("total"), F.count("*").alias("n"))

    store = RecordStore(spark, out, "ts", ["event_id"], [], [Table("daily", [RECORDS], build, ["event_type"])])
    moved = events.where(F.col("event_id") % 5 == 0).withColumn("ts", F.col("ts") + F.expr("interval 30 hours"))
    back = events.where(F.col("event_id") % 10 == 0).withColumn("value", F.col("value") + 1)
    for number, rows in enumerate((events, moved, back)):
        rows.write.parquet(f"{out}/landing/file={number}")
        store.follow(spark.readStream.schema(rows.schema).parquet(f"{out}/landing/*"))
    return store.read("daily")


def put_file(spark: SparkSession, lines: DataFrame, path: str) -> None:
    """Write lines as the one file ``path``, in place of one that is there."""
    made = shared_dir(spark, "file")
    lines.coalesce(1).write.text(made)
    hadoop = spark._jvm.org.apache.hadoop.fs
    files = hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    [part] = files.globStatus(hadoop.Path(f"{made}/part-*"))
    files.delete(hadoop.Path(path), False)
    files.mkdirs(hadoop.Path(path).getParent())
    files.rename(part.getPath(), hadoop.Path(path))


def q_refetched_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily files of two vehicles, of which one is fetched again with corrected records and one with fewer, under their names."""
    prepare(spark)
    out = shared_dir(spark, "refetched")
    rows = table(spark, sf_dir, "events").select(
        F.concat(F.lit("wg"), F.pmod("user_id", F.lit(2)).cast("string")).alias("vehicle"), day_of(F.col("ts")).alias("day"), "event_id", "ts", "value"
    )
    ends = rows.agg(F.min("day").alias("first"), F.max("day").alias("last")).first()
    rewritten = [("wg0", ends.first), ("wg1", ends.last)]

    def lines(found: DataFrame) -> Column:
        return F.concat(F.lit('{"recordData":['), F.to_json(F.struct("event_id", "ts", "value")), F.lit("]}")).alias("line")

    def daily(vehicle: str, day: dt.date) -> DataFrame:
        return rows.where((F.col("vehicle") == vehicle) & (F.col("day") == F.lit(day)))

    def path(vehicle: str, day: dt.date) -> str:
        return f"{out}/raw/vehicle={vehicle}/day={day}/records.txt"

    def read(paths) -> DataFrame:
        payloads = vehicle_from_path(read_payloads(spark, list(paths), whole_file=False), "/vehicle=([^/]+)/")
        return records(payloads, text_fields(["event_id", "ts", "value"])).withColumn("day", day_of(to_time(F.col("ts"))))

    def build(readings: DataFrame) -> DataFrame:
        last = keep_last(readings, ["vehicle", "event_id"], [SOURCE_ORDER])
        return last.groupBy("vehicle", "day").agg(total(to_number(F.col("value")), SCALE).alias("total"), F.count("*").alias("n"))

    source = Source("readings", [f"{out}/raw/vehicle=*/day=*/*.txt"], read)
    tables = DayTables(spark, f"{out}/tables", [source], [Table("daily", ["readings"], build)])
    if ends.first is None:
        return spark.createDataFrame([], "vehicle string, day date, total double, n bigint")
    others = ~F.struct("vehicle", "day").isin([F.struct(F.lit(v).alias("vehicle"), F.lit(d).alias("day")) for v, d in rewritten])
    rows.where(others).select("vehicle", "day", lines(rows)).write.partitionBy("vehicle", "day").text(f"{out}/raw")
    for vehicle, day in rewritten:
        put_file(spark, daily(vehicle, day).select(lines(rows)), path(vehicle, day))
    tables.refresh()
    put_file(spark, daily(*rewritten[0]).withColumn("value", F.col("value") + 1).select(lines(rows)), path(*rewritten[0]))
    put_file(spark, daily(*rewritten[1]).where("event_id % 2 = 0").select(lines(rows)), path(*rewritten[1]))
    tables.refresh()
    return tables.read("daily")


def q_refresh_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours, flows and day summary of all days but the last, refreshed once the last day has arrived."""
    prepare(spark)
    out = shared_dir(spark, "refresh")
    events = table(spark, sf_dir, "events").withColumn("day", day_of(F.col("ts")))
    last = events.agg(F.max("day").alias("day")).first().day
    names = events.drop("day").columns

    def read(paths) -> DataFrame:
        place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("chunk")).alias(SOURCE_ORDER)
        return spark.read.schema(events.select(*names).schema).parquet(*paths).select(*names, place).withColumn("day", day_of(F.col("ts")))

    def hours(records: DataFrame) -> DataFrame:
        return roles(records.drop("day", SOURCE_ORDER)).withColumn("day", day_of(F.col("sampleHour")))

    def battery(records: DataFrame) -> DataFrame:
        return power_series(telemetry_rows(records))[2].withColumn("day", day_of(F.col("timestamp")))

    def summary(hours: DataFrame, battery: DataFrame) -> DataFrame:
        return day_summary(hours.drop("day"), battery.drop("day"))

    graph = [
        Table("hours", ["records"], hours),
        Table("battery", ["records"], battery),
        Table("summary", ["hours", "battery"], summary),
    ]
    tables = DayTables(spark, f"{out}/tables", [Source("records", [f"{out}/raw/*/*.parquet"], read)], graph)
    for turn, part in enumerate((F.col("day") < F.lit(last), F.col("day") == F.lit(last))):
        events.where(part).select(*names).write.parquet(f"{out}/raw/turn={turn}")
        tables.refresh()
    return rounded(tables.read("summary"), "used_wh", "gained_wh", "delta")


def queries() -> dict[str, Query]:
    return {name: query for name, query in globals().items() if name.startswith("q_")}
