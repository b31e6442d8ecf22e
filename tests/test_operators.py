import datetime as dt

import pytest
from pyspark.sql import functions as F

from fleetwatt.operators.availability import sensor_availability
from fleetwatt.operators.census import census
from fleetwatt.operators.cleaning import (
    blank_marks,
    clean_time,
    keep_last,
    missing_fields,
    require_columns,
    require_fields,
    to_numbers,
)
from fleetwatt.operators.components import component_colours, in_sensor_order, sensor_order, trace_index, trace_spans
from fleetwatt.operators.days import battery_change, daily_energy, day_summary, days, default_day, first_last, with_titles
from fleetwatt.operators.fleet import label_table, select_vehicles, with_label
from fleetwatt.operators.flows import hour_spine, hourly_flows, spine_join
from fleetwatt.operators.ports import base_columns, label_ports, sensor_table, unpivot_ports, with_component
from fleetwatt.operators.rollups import (
    above_threshold,
    component_hours,
    component_pivot,
    drawn_hours,
    hourly_mean,
    hourly_total,
    port_hours,
    positive_sum,
    total_hours,
)
from fleetwatt.schemas import PALETTE, PORT_SENSORS, SensorSpec
from tests.conftest import plan, rows

V = "wg1"


def at(text):
    return dt.datetime.fromisoformat(text)


H10, H11, H12 = at("2026-07-03 10:00"), at("2026-07-03 11:00"), at("2026-07-03 12:00")
D3, D4 = dt.date(2026, 7, 3), dt.date(2026, 7, 4)


def test_unpivot_drops_unused_places(spark):
    wide = spark.createDataFrame(
        [("t", "7", "1", "5", "0.63", "0", "0", "9", "0", "5", "1.5", None, None)],
        "timeStamp string, powerDomain string, portNumber1 string, moduleNumber1 string, avgPower1 string,"
        "portNumber2 string, moduleNumber2 string, avgPower2 string,"
        "portNumber3 string, moduleNumber3 string, avgPower3 string, portNumber4 string, moduleNumber4 string",
    )
    long = unpivot_ports(wide, ["avgPower"], 5)
    assert long.columns == ["timeStamp", "powerDomain", "place", "portNumber", "moduleNumber", "avgPower"]
    assert rows(long) == [("t", "7", 1, "1", "5", "0.63"), ("t", "7", 3, "0", "5", "1.5")]


def test_places_are_told_once_by_compiled_conditions(spark):
    fields = [f"{name}{i}" for i in range(1, 34) for name in ("portNumber", "moduleNumber", "avgPower")]
    made = [
        ("used", {"portNumber1": "1", "moduleNumber1": "5", "avgPower1": "0.5", "moduleNumber33": "7"}),
        ("forms of zero", dict.fromkeys(fields[:15], "0.0") | {"portNumber9": "false", "moduleNumber9": "", "portNumber8": "-0.0"}),
        ("nothing", {}),
        (None, {"portNumber2": " 0", "avgPower2": None}),
    ]
    wide = spark.createDataFrame([(key, *map(values.get, fields)) for key, values in made], f"key string, {', '.join(f'{f} string' for f in fields)}")
    long = unpivot_ports(wide, ["avgPower"], 33)
    assert rows(long) == rows(spark.createDataFrame(
        [("used", 1, "1", "5", "0.5"), ("used", 33, None, "7", None), (None, 2, " 0", None, None)],
        "key string, place int, portNumber string, moduleNumber string, avgPower string",
    ))
    text = plan(long)
    # A lambda has Spark interpret the array of all places, a test of its size makes it a second time.
    assert "lambda" not in text and "size(" not in text


def test_base_columns():
    columns = ["timeStamp", "avgPower1", "avgPowerTotal", "portNumber12", "recordData", "portNumber"]
    assert base_columns(columns, ["avgPower", "portNumber"]) == ["timeStamp", "avgPowerTotal", "portNumber"]


def test_unpivot_undoes_a_pivot(spark, sf_dir):
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_orderkey", "l_linenumber").agg(
        F.sum("l_quantity").alias("q")
    )
    wide = items.groupBy("l_orderkey").agg(
        *[F.max(F.when(F.col("l_linenumber") == i, F.col("l_linenumber"))).alias(f"portNumber{i}") for i in range(1, 8)],
        *[F.max(F.when(F.col("l_linenumber") == i, F.col("q"))).alias(f"q{i}") for i in range(1, 8)],
    )
    back = unpivot_ports(wide, ["q"], 7).select("l_orderkey", F.col("portNumber").alias("l_linenumber"), "q")
    assert rows(back) == rows(items)


def test_port_labels(spark):
    assert len({(slot, port) for slot, port, _ in PORT_SENSORS}) == 21
    ports = spark.createDataFrame(
        [(1, 1, 1), (1, 13, 1), (1, 32, 106), (2, 5, 5), (1, None, 1)], "domain int, slot int, port int"
    )
    labelled = label_ports(ports, sensor_table(spark))
    found = {(r.slot, r.port): r.sensor for r in labelled.collect()}
    assert found == {
        (1, 1): "GPSWaves",
        (13, 1): None,
        (32, 106): "CCU: Tegra TX1 SOM module",
        (5, 5): "RBR CTD",
        (None, 1): None,
    }
    assert "BroadcastHashJoin" in plan(labelled)
    assert [r.component for r in with_component(labelled).where("slot = 13").collect()] == ["D1-S13-P1"]


def port_rows(spark, values):
    return spark.createDataFrame([(V, h, c, p) for h, c, p in values], "vehicle string, sampleHour timestamp_ntz, component string, avg_power_W double")


def test_threshold_is_strict(spark):
    found = above_threshold(port_rows(spark, [(H10, "a", 0.2), (H10, "a", 0.21), (H10, "a", None)]))
    assert [r.avg_power_W for r in found.collect()] == [0.21]


def test_hourly_total(spark):
    table = port_rows(spark, [(H10, "a", 1.0), (H10, "b", 2.0), (H10, "b", None), (H11, "a", None), (None, "a", 5.0)])
    assert rows(hourly_total(table)) == [(V, H10, 3.0), (V, H11, 0.0)]
    assert hourly_total(table.limit(0)).count() == 0


def test_hourly_total_counts_a_port_once_by_its_mean(spark):
    table = port_rows(spark, [(H10, "a", 1.0), (H10, "a", 3.0), (H10, "b", 5.0)]).selectExpr(
        "*", "component as domain", "0 as slot", "0 as port"
    )
    assert rows(hourly_total(table, per_port="mean")) == [(V, H10, 7.0)]
    assert rows(hourly_total(table)) == [(V, H10, 9.0)]
    with pytest.raises(ValueError):
        hourly_total(table, per_port="max")


def test_positive_sum(spark):
    table = spark.createDataFrame(
        [(V, H10, 5.0), (V, H10, 0.0), (V, H10, 2.0), (V, H11, 0.0), (V, H11, None), (V, H11, -1.0)],
        "vehicle string, t timestamp_ntz, p double",
    )
    assert rows(positive_sum(table, "t", "p", "s")) == [(V, H10, 7.0)]


def test_hourly_mean(spark):
    table = spark.createDataFrame(
        [(V, at("2026-07-03 10:05"), 2.0), (V, at("2026-07-03 10:50"), 4.0), (V, at("2026-07-03 11:10"), None), (V, None, 1.0)],
        "vehicle string, t timestamp_ntz, p double",
    )
    assert rows(hourly_mean(table, "t", "p", "m")) == [(V, H10, 3.0), (V, H11, None)]


def test_component_pivot(spark):
    table = port_rows(spark, [(H10, "a", 1.0), (H10, "a", 2.0), (H11, "b", 3.0)])
    wide = component_pivot(table, ["b", "a"])
    assert wide.columns == ["vehicle", "sampleHour", "a", "b"]
    assert rows(wide) == [(V, H10, 3.0, 0.0), (V, H11, 0.0, 3.0)]
    assert plan(wide).count("Exchange") == 1
    assert rows(component_hours(table)) == [(V, H10, "a", 3.0), (V, H11, "b", 3.0)]


def test_component_pivot_shows_or_stops_at_what_is_off_the_list(spark):
    table = port_rows(spark, [(H10, "a", 1.0), (H10, "new", 2.0), (H11, "b", 3.0)])
    wide = component_pivot(table, ["b", "a"], other="other")
    assert wide.columns[2:] == ["a", "b", "other"]
    assert rows(wide) == [(V, H10, 1.0, 0.0, 2.0), (V, H11, 0.0, 3.0, 0.0)]
    with pytest.raises(Exception, match="not listed: new"):
        component_pivot(table, ["b", "a"]).collect()
    assert component_pivot(table).columns[2:] == ["a", "b", "new"]


def test_port_hours_hold_totals_and_component_hours(spark):
    table = port_rows(spark, [(H10, "a", 1.0), (H10, "a", 0.1), (H10, "b", 0.2), (H11, "b", 3.0), (H11, "c", None), (H12, "c", None)])
    hours = port_hours(table)
    assert rows(total_hours(hours)) == rows(hourly_total(table)) == [(V, H10, pytest.approx(1.3)), (V, H11, 3.0), (V, H12, 0.0)]
    assert rows(drawn_hours(hours)) == rows(component_hours(above_threshold(table))) == [(V, H10, "a", 1.0), (V, H11, "b", 3.0)]


def test_pivot_columns_add_up_to_the_hourly_total(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr(
        "'wg1' as vehicle", "date_trunc('hour', ts) as sampleHour", "event_type as component", "value as avg_power_W"
    )
    drawn = above_threshold(events)
    names = [r.component for r in drawn.select("component").distinct().collect()]
    wide = component_pivot(drawn, names, scale=4)
    added = wide.select("vehicle", "sampleHour", F.round(sum(F.col(name) for name in names), 4))
    assert rows(added) == rows(hourly_total(drawn, scale=4))


def flow_inputs(spark):
    drawing = port_rows(spark, [(H10, "a", 1.0), (H10, "b", 1.0), (H11, "a", 1.0)])
    output = spark.createDataFrame([(V, H10, 5.0), (V, H12, 9.0)], "vehicle string, timestamp timestamp_ntz, total_output_power_W double")
    solar = spark.createDataFrame(
        [(V, at("2026-07-03 11:05"), 1.0), (V, at("2026-07-03 11:55"), 3.0)], "vehicle string, timeStamp timestamp_ntz, solar_power_W double"
    )
    battery = spark.createDataFrame(
        [(V, at("2026-07-03 12:00"), 7.0), (V, at("2026-07-03 10:00"), 9.0), (V, at("2026-07-03 11:00"), 100.0)],
        "vehicle string, timestamp timestamp_ntz, total_battery_power_W double",
    )
    return drawing, output, solar, battery


EXPECTED_FLOWS = [(V, H10, 5.0, None, 9.0), (V, H11, None, 2.0, 100.0)]


def test_flows_in_one_shuffle_equal_the_spine_join(spark):
    drawing, output, solar, battery = flow_inputs(spark)
    flows = hourly_flows(drawing, output, solar, battery)
    joined = spine_join(
        hour_spine(drawing),
        hourly_mean(output, "timestamp", "total_output_power_W", "total_usage_W"),
        hourly_mean(solar, "timeStamp", "solar_power_W", "solar_gain_W"),
        hourly_mean(battery, "timestamp", "total_battery_power_W", "total_battery_power_W"),
    )
    assert rows(flows) == rows(joined) == EXPECTED_FLOWS
    assert plan(flows).count("Exchange") == 1 and "Join" not in plan(flows)
    assert rows(hourly_flows(drawing, output, solar)) == [row[:4] for row in EXPECTED_FLOWS]


def test_day_summary(spark):
    drawing, output, solar, battery = flow_inputs(spark)
    other_day = port_rows(spark, [(at("2026-07-04 03:00"), "a", 1.0)])
    flows = hourly_flows(drawing.unionByName(other_day), output, solar, battery)
    assert rows(daily_energy(flows)) == [(V, D3, 5.0, 2.0), (V, D4, 0.0, 0.0)]
    summary = day_summary(flows, battery)
    assert rows(summary.select("day", "used_wh", "gained_wh", "battery_start", "battery_end", "delta")) == [
        (D3, 5.0, 2.0, 9.0, 7.0, -2.0),
        (D4, 0.0, 0.0, 0.0, 0.0, 0.0),
    ]
    bounds = summary.where(F.col("day") == D3).select("day_start", "day_end", "day_label").first()
    assert tuple(bounds) == (at("2026-07-03"), at("2026-07-04"), "2026-07-03")
    titles = with_titles(with_label(summary, label_table(spark, [(V, "One")]))).where(F.col("day") == D3).first()
    assert "One: " in titles.title and "Daily gained: 2.0 Wh | Daily used: 5.0 Wh" in titles.title
    assert titles.battery_title.endswith("Start: 9.0 W | End: 7.0 W | Daily gain/loss: -2.0 W")


def test_battery_only_days_are_not_listed(spark):
    ends = first_last(flow_inputs(spark)[3], "timestamp", "total_battery_power_W")
    listed = spark.createDataFrame([(V, D4)], "vehicle string, day date")
    assert rows(battery_change(listed, ends)) == [(V, D4, 0.0, 0.0, 0.0)]


def test_first_last_ties_are_fixed(spark):
    table = spark.createDataFrame([(V, H10, 3.0), (V, H10, 1.0), (V, H10, 2.0)], "vehicle string, t timestamp_ntz, p double")
    assert rows(first_last(table, "t", "p")) == [(V, D3, 1.0, 3.0)]
    times = spark.createDataFrame([(V, H10, 3.0), (V, H11, 1.0), (V, H11, 1.0)], table.schema)
    assert rows(first_last(times, "t", "p")) == [(V, D3, 3.0, 1.0)]
    assert "SortAggregate" not in plan(first_last(times, "t", "p"))


def test_days_and_default_day(spark):
    table = spark.createDataFrame(
        [("wg1", H10), ("wg1", H11), ("wg1", at("2026-07-05 01:00")), ("wg2", H10)], "vehicle string, sampleHour timestamp_ntz"
    )
    assert rows(days(table)) == [("wg1", D3, 0), ("wg1", dt.date(2026, 7, 5), 1), ("wg2", D3, 0)]
    assert rows(default_day(table, D3)) == [("wg1", D3), ("wg2", D3)]
    assert rows(default_day(table, D4)) == [("wg1", dt.date(2026, 7, 5)), ("wg2", D3)]
    assert rows(default_day(table)) == [("wg1", dt.date(2026, 7, 5)), ("wg2", D3)]


def test_keep_last(spark):
    table = spark.createDataFrame(
        [(V, "2026-07-03 10:00", "f1", 0, "a"), (V, "2026-07-03 10:00", "f2", 0, "b"), (V, "2026-07-03 10:00", "f2", 1, "c"), (V, "bad", "f3", 0, "d")],
        "vehicle string, timeStamp string, file string, pos int, x string",
    ).withColumn("source_order", F.struct("file", "pos"))
    cleaned = clean_time(table, "timeStamp")
    assert [r.x for r in cleaned.collect()] == ["c"]
    assert rows(clean_time(cleaned, "timeStamp")) == rows(cleaned)


def test_keep_last_cuts_a_hot_key_before_the_shuffle(spark):
    table = spark.range(1000).selectExpr("id div 1000 as k", "id as o")
    assert plan(keep_last(table, ["k"], ["o"])).count("WindowGroupLimit") == 2
    assert rows(keep_last(table, ["k"], ["o"])) == [(0, 999)]


def test_cleaning_by_column_list(spark):
    table = spark.createDataFrame([("1.5", "x", 9999.0)], "`hs (m)` string, b string, c double")
    converted = to_numbers(table, ["hs (m)", "b", "absent"])
    assert rows(blank_marks(converted, ["c"], (9999.0,))) == [(1.5, None, None)]


def test_required_fields(spark):
    table = spark.createDataFrame([({"gliderTimeStamp": "t"},), ({"x": "1"},)], "fields map<string,string>")
    required = ["totalBatteryPower", "gliderTimeStamp"]
    assert rows(missing_fields(table, "fields", required)) == [("totalBatteryPower",)]
    with pytest.raises(KeyError, match="totalBatteryPower"):
        require_fields(table, "fields", required)
    with pytest.raises(KeyError, match=r"\['a', 'b'\]"):
        require_columns(table, ["b", "fields", "a"])
    assert require_columns(table, ["fields"]) is table


def test_component_colours(spark):
    table = spark.createDataFrame([(V, f"c{i:02}") for i in range(15)] * 2, "vehicle string, component string")
    found = {r.component: (r.component_index, r.colour_index, r.colour) for r in component_colours(table).collect()}
    assert len(found) == 15 and len(PALETTE) == 14
    assert found["c00"] == (0, 0, PALETTE[0]) and found["c13"][2] == PALETTE[13] and found["c14"] == (14, 0, PALETTE[0])


def test_sensor_order(spark):
    plain = spark.createDataFrame([("SPN1",)], "sensor string")
    assert sensor_order(spark, plain).count() == 6
    with_gas = plain.unionByName(spark.createDataFrame([("pCO2",), ("pCO2",)], "sensor string"))
    assert ("pCO2", 6) in rows(sensor_order(spark, with_gas))
    assert sensor_order(spark, with_gas).count() == 7
    assert rows(in_sensor_order(with_gas)) == [("SPN1", 1), ("pCO2", 6), ("pCO2", 6)]


def test_trace_index(spark):
    hours = spark.createDataFrame([(V, H10), (V, at("2026-07-04 10:00"))], "vehicle string, sampleHour timestamp_ntz")
    components = spark.createDataFrame([(V, "a"), (V, "b")], "vehicle string, component string")
    found = {(r.day, r.k): r.trace_index for r in trace_index(days(hours), components).collect()}
    assert [found[D3, k] for k in range(5)] == [2, 3, 4, 5, 6]
    assert [found[D4, k] for k in range(5)] == [7, 8, 9, 10, 11]
    assert rows(trace_spans(days(hours), components)) == [(V, D3, 2, 5), (V, D4, 7, 5)]


def test_availability(spark):
    airsea = spark.createDataFrame(
        [(V, "2026-07-03 10:00", "1.0", "5"), (V, "2026-07-03 11:00", "x", None), (V, "bad", "2.0", "6")],
        "vehicle string, Logger_DateTime string, SPN1_Raw_Total_Avg string, RBR_Temp_Avg string",
    )
    vegas = spark.createDataFrame([(V, "03/07/2026 12:00:00", "400")], "vehicle string, sensor_time string, `Ocean CO2 Ave` string")
    specs = [
        SensorSpec("SPN1", "airsea", "Logger_DateTime", "SPN1_Raw_Total_Avg"),
        SensorSpec("RBR CTD", "airsea", "Logger_DateTime", "RBR_Temp_Avg"),
        SensorSpec("pCO2", "vegas", "sensor_time", "Ocean CO2 Ave", ("dd/MM/yyyy HH:mm:ss",)),
    ]
    found = sensor_availability({"airsea": airsea, "vegas": vegas}, specs)
    assert rows(found) == [(V, H10, "RBR CTD", 5.0), (V, H10, "SPN1", 1.0), (V, H12, "pCO2", 400.0)]
    assert rows(sensor_availability({"airsea": airsea}, specs)) == [(V, H10, "RBR CTD", 5.0), (V, H10, "SPN1", 1.0)]
    with pytest.raises(ValueError):
        sensor_availability({}, specs)


def test_vehicle_choice(spark):
    table = spark.createDataFrame([("wg1",), ("wg2",), ("wg3",)], "vehicle string")
    assert rows(select_vehicles(table, "both", ["wg1", "wg2"])) == [("wg1",), ("wg2",)]
    assert rows(select_vehicles(table, "wg2", ["wg1", "wg2"])) == [("wg2",)]
    with pytest.raises(ValueError, match="target must be"):
        select_vehicles(table, "wg9", ["wg1", "wg2"])
    labelled = with_label(table, label_table(spark, [("wg1", "One")]))
    assert rows(labelled) == [("wg1", "One"), ("wg2", "WG2"), ("wg3", "WG3")]


def test_census_lists_empty_items(spark):
    items = spark.createDataFrame([(1,), (2,)], "k int")
    found = spark.createDataFrame([(1,), (1,)], "r int")
    assert rows(census(items, "k", found, "r")) == [(1, 2), (2, 0)]
