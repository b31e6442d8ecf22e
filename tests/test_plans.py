import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from fleetwatt.plans.environment import waves, weather
from fleetwatt.plans.job import Inputs, export_csv, power_tables, product_payloads, run
from fleetwatt.operators.order import first_rows
from fleetwatt.plans.power_tables import PORT_POWER_ORDER, port_power, summary_battery_power
from fleetwatt.operators.ports import sensor_table
from fleetwatt.schemas import OUTPUT_RECORD, WAVE_RECORD, WEATHER_RECORD, text_fields
from fleetwatt.sources.json_records import BARE_LIST, places_beyond, read_payloads, records, vehicle_from_path
from fleetwatt.sources.tables import read_csv
from tests.conftest import plan, rows

D30 = dt.date(2026, 6, 30)


def at(text):
    return dt.datetime.fromisoformat(text)


def ports(time, *used, domain=1):
    """A wide record; places that are not given are reported as unused."""
    record = {"timeStamp": time, "powerDomain": domain}
    for i in range(1, 34):
        slot, port, power, volts, amps, status = used[i - 1] if i <= len(used) else (0, 0, 0.0, 0.0, 0.0, 0)
        record |= {
            f"moduleNumber{i}": slot,
            f"portNumber{i}": port,
            f"avgPower{i}": power,
            f"avgVoltage{i}": volts,
            f"avgCurrent{i}": amps,
            f"portStatus{i}": status,
            f"sampleTime{i}": time,
        }
    return record


# A report as vehicles send it, with the labels it has to get.
REPORT = [
    (4, 1, 1.02, 13.43, 0.07, 1, "Airmar WS200"),
    (4, 2, 0.0, 0.0, 0.0, 0, None),
    (4, 3, 0.0, 0.0, 0.0, 0, "lightBar"),
    (4, 5, 0.66, 13.43, 0.05, 1, "airmarWaterspeedDevice"),
    (7, 2, 0.0, 0.0, 0.0, 0, "pCO2"),
    (7, 4, 1.38, 13.52, 0.1, 1, "AIS"),
    (13, 1, 0.04, 19.26, 0.0, 1, None),
    (32, 1, 0.36, 19.26, 0.01, 32769, "CCU: UNKNOWN"),
    (32, 2, 0.21, 19.25, 0.01, 32769, None),
    (32, 3, 4.82, 19.27, 0.25, 32769, "VMC"),
    (32, 106, 1.88, 18.76, 0.1, 0, "CCU: Tegra TX1 SOM module"),
    (32, 107, 0.03, 5.03, 0.0, 0, None),
    (32, 108, 0.13, 3.29, 0.03, 0, "CCU: mSATA Drive, SDCARD, discrete ICs"),
    (32, 110, 1.3, 3.4, 0.39, 0, "CCU: UARTs, HS/LS USB Hubs, Ethernet"),
]


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")

    def put(vehicle, name, content):
        folder = root / vehicle / "json"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / name).write_text(content if isinstance(content, str) else json.dumps(content))

    first = ports("2026-06-30 09:44:13", *[row[:6] for row in REPORT])
    second = ports("2026-06-30 10:44:13", (5, 5, 2.0, 13.0, 0.1, 1), (5, 5, None, None, None, 1), domain=2)
    low = ports("2026-07-01 10:44:13", (5, 5, 0.1, 13.0, 0.1, 1))
    next_day = ports("2026-07-01 11:44:13", (5, 2, 3.0, 13.0, 0.1, 1))
    for vehicle in ("wg1169", "wg1170"):
        put(vehicle, "waveglider-amps-output-power-status_2026-06-30.json", {"recordData": [first, second]})
        put(vehicle, "waveglider-amps-output-power-status_2026-07-01.json", [low, next_day])
        panels = {"timeStamp": "2026-06-30 09:50:00"}
        for i, power in enumerate([10.0, 6.5, 0.0], start=1):
            panels |= {f"portNumber{i}": i, f"moduleNumber{i}": 2, f"panelPower{i}": power}
        night = {"timeStamp": "2026-06-30 23:50:00", "portNumber1": 1, "moduleNumber1": 2, "panelPower1": 0}
        put(vehicle, "waveglider-amps-solar_2026-06-30.json", {"recordData": [panels, night]})
        battery = [
            {"gliderTimeStamp": "2026-06-30 09:43:33", "totalBatteryPower": 2737947, "other": 1},
            {"gliderTimeStamp": "2026-06-30 10:43:33", "totalBatteryPower": "2736519"},
            {"gliderTimeStamp": "2026-06-30 10:43:33", "totalBatteryPower": "2736519"},
            {"gliderTimeStamp": "2026-06-30 11:43:33", "totalBatteryPower": "x"},
            {"gliderTimeStamp": None, "totalBatteryPower": 5},
        ]
        put(vehicle, "waveglider-amps_2026-06-30.json", {"recordData": battery})
        put(vehicle, "waveglider-amps_2026-07-01.json", [])
        put(
            vehicle,
            "waveglider-weather_2026-06-30.json",
            [
                {"timeStamp": "2026-06-30 09:00:00", "avgWindSpeed(kt)": "10.0", "avgTemp(C)": "5"},
                {"timeStamp": "2026-06-30 09:00:00", "avgWindSpeed(kt)": "20.0", "avgTemp(C)": "n/a"},
                {"timeStamp": "bad", "avgWindSpeed(kt)": "30.0"},
            ],
        )
        put(
            vehicle,
            "waveglider-waves_2026-06-30.json",
            [
                {"timeStamp": "2026-06-30 09:20:00", "hs (m)": 0.769, "dp (deg)": 9999.0, "latitude": 9999.0},
                {"timeStamp": "2026-06-30 09:00:00", "hs (m)": -9999, "dp (deg)": 190.5, "samples": 4799},
            ],
        )
        put(
            vehicle,
            "AirSeaWHIRLS_Decoded.csv",
            "Logger_DateTime,other,SPN1_Raw_Total_Avg,RBR_Temp_Avg,wind_speed_Max,Ux_gill_Avg\n"
            "2026-06-30 09:00:00,1,5.5,NAN,7.5,\n",
        )
    put("wg1170", "VeGAS_decoded.csv", "sensor_time,Ocean CO2 Ave\n30/06/2026 09:10:00,400.5\nbad,1\n")
    return str(root)


def product(spark, raw, name, schema, **options):
    scan = vehicle_from_path(read_payloads(spark, f"{raw}/*/json/{name}"), "/([^/]+)/json/[^/]*$")
    return records(scan, schema, **options)


def test_port_power(spark, raw):
    found = port_power(product(spark, raw, "waveglider-amps-output-power-status_*.json", OUTPUT_RECORD), sensor_table(spark))
    one = found.where("vehicle = 'wg1169' and timestamp = '2026-06-30 09:44:13'")
    expected = [
        ("wg1169", at("2026-06-30 09:44:13"), at("2026-06-30 09:00"), 1, slot, port, sensor, power, volts, amps, status)
        for slot, port, power, volts, amps, status, sensor in REPORT
    ]
    assert sorted(map(tuple, one.collect()), key=lambda r: r[4:6]) == expected
    text = plan(found)
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text and "Python" not in text


def test_weather(spark, raw):
    found = weather(product(spark, raw, "waveglider-weather_*.json", WEATHER_RECORD, envelopes=(BARE_LIST,)))
    picked = found.where("vehicle = 'wg1169'").select("timeStamp", "air_temperature", "wind_speed_kt", "wind_speed_ms")
    assert rows(picked) == [(at("2026-06-30 09:00"), None, 20.0, pytest.approx(10.28888))]


def test_waves(spark, raw):
    found = waves(product(spark, raw, "waveglider-waves_*.json", WAVE_RECORD, envelopes=(BARE_LIST,)))
    picked = found.where("vehicle = 'wg1169'").select(
        "timeStamp", "latitude", "significant_wave_height_m", "peak_wave_direction_deg", "n_samples"
    )
    assert rows(picked) == [
        (at("2026-06-30 09:00"), None, None, 190.5, 4799.0),
        (at("2026-06-30 09:20"), 9999.0, 0.769, None, None),
    ]


def test_whole_run(spark, raw, tmp_path):
    out = f"{tmp_path}/out"
    tables = run(spark, Inputs(raw), out, as_of=D30)

    def of(name, *columns):
        return rows(tables[name].where("vehicle = 'wg1170'").select(*columns))

    total = sum(row[2] for row in REPORT)
    assert of("output_power_hourly", "timestamp", "total_output_power_W") == [
        (at("2026-06-30 09:00"), pytest.approx(total)),
        (at("2026-06-30 10:00"), 2.0),
        (at("2026-07-01 10:00"), 0.1),
        (at("2026-07-01 11:00"), 3.0),
    ]
    assert of("solar_power", "timeStamp", "solar_power_W") == [(at("2026-06-30 09:50"), 16.5)]
    assert of("battery_power", "timestamp", "total_battery_power_W") == [
        (at("2026-06-30 09:43:33"), 2737.947),
        (at("2026-06-30 10:43:33"), 2736.519),
        (at("2026-06-30 10:43:33"), 2736.519),
    ]
    # The hour in which no port draws more than the threshold is off the spine.
    assert of("hourly_flows", "sampleHour", "total_usage_W", "solar_gain_W") == [
        (at("2026-06-30 09:00"), pytest.approx(total), 16.5),
        (at("2026-06-30 10:00"), 2.0, None),
        (at("2026-07-01 11:00"), 3.0, None),
    ]
    summary = of("day_summary", "day", "used_wh", "gained_wh", "battery_start", "battery_end", "delta", "label")
    assert summary == [
        (D30, pytest.approx(total + 2), 16.5, 2737.947, 2736.519, pytest.approx(-1.428), "WG1170 - Melktert"),
        (dt.date(2026, 7, 1), 3.0, 0.0, 0.0, 0.0, 0.0, "WG1170 - Melktert"),
    ]
    assert of("default_day", "default_day") == [(D30,)]
    assert {r.component for r in tables["component_hours"].collect()} >= {"VMC", "D1-S32-P2", "RBR CTD"}
    assert rows(tables["sensor_availability"].select("vehicle", "sensor", "value")) == [
        ("wg1169", "Airmar WS200", 20.0),
        ("wg1169", "GPSWaves", 0.769),
        ("wg1169", "SPN1", 5.5),
        ("wg1169", "Vaisala", 7.5),
        ("wg1170", "Airmar WS200", 20.0),
        ("wg1170", "GPSWaves", 0.769),
        ("wg1170", "SPN1", 5.5),
        ("wg1170", "Vaisala", 7.5),
        ("wg1170", "pCO2", 400.5),
    ]
    panels = {r.panel for r in tables["series"].select("panel").distinct().collect()}
    assert panels == {"bars", "flows", "battery", "mission", "availability"}
    assert spark.read.json(f"{out}/series_json").count() == tables["series"].count()
    counts = {r.tbl: r.n for r in spark.read.parquet(f"{out}/job_rows").collect()}
    assert counts["battery_power"] == 6 and counts["day_summary"] == 4
    assert rows(spark.read.parquet(f"{out}/job_files").drop("bytes")) == [("battery", 4), ("output_power", 4), ("solar", 2)]

    export_csv(tables, f"{out}/csv")
    back = read_csv(spark, f"{out}/csv/solar_power", text_fields(["vehicle", "timeStamp", "solar_power_W"]))
    assert rows(back) == [("wg1169", "2026-06-30 09:50:00", "16.5"), ("wg1170", "2026-06-30 09:50:00", "16.5")]


def test_one_target(spark, raw, tmp_path):
    tables = power_tables(spark, Inputs(raw, target="wg1169"), f"{tmp_path}/out")
    assert {r.vehicle for r in tables["battery_power"].collect()} == {"wg1169"}
    with pytest.raises(ValueError, match="target must be"):
        Inputs(raw, target="wg1").chosen()


def test_missing_battery_field_stops(spark, tmp_path, raw):
    folder = tmp_path / "wg1169" / "json"
    folder.mkdir(parents=True)
    for name, content in [
        ("waveglider-amps-output-power-status_1.json", [ports("2026-06-30 09:44:13", (5, 5, 1.0, 1.0, 1.0, 1))]),
        ("waveglider-amps-solar_1.json", []),
        ("waveglider-amps_1.json", [{"gliderTimeStamp": "2026-06-30 09:43:33"}]),
    ]:
        (folder / name).write_text(json.dumps(content))
    with pytest.raises(KeyError, match="totalBatteryPower"):
        power_tables(spark, Inputs(str(tmp_path), target="wg1169"), f"{tmp_path}/out")


def test_empty_power_files_give_empty_tables(spark, tmp_path):
    folder = tmp_path / "wg1169" / "json"
    folder.mkdir(parents=True)
    for product in ("amps-output-power-status", "amps-solar", "amps"):
        (folder / f"waveglider-{product}_1.json").write_text("[]")
    tables = power_tables(spark, Inputs(str(tmp_path), target="wg1169"), f"{tmp_path}/out")
    assert {name: table.count() for name, table in tables.items()} == dict.fromkeys(tables, 0)
    assert tables["output_power_hourly"].columns == ["vehicle", "timestamp", "total_output_power_W"]


def test_battery_repeats_are_dropped_on_request(spark):
    row = ("wg1169", {"gliderTimeStamp": "2026-06-30 09:43:33", "totalBatteryPower": "1000"})
    twice = spark.createDataFrame([row, row], "vehicle string, fields map<string,string>")
    assert summary_battery_power(twice).count() == 2
    assert rows(summary_battery_power(twice, distinct=True)) == [("wg1169", at("2026-06-30 09:43:33"), 1.0)]


def test_a_bad_battery_time_stops_and_a_missing_one_is_dropped(spark):
    def power(*times):
        rows_ = [("wg1169", {"gliderTimeStamp": t, "totalBatteryPower": "1000"}) for t in times]
        return summary_battery_power(spark.createDataFrame(rows_, "vehicle string, fields map<string,string>"))

    assert rows(power("2026-06-30 09:43:33", None)) == [("wg1169", at("2026-06-30 09:43:33"), 1.0)]
    with pytest.raises(Exception, match="not a time: bad"):
        power("bad").collect()


def test_payloads_by_line_give_the_same_tables(spark, tmp_path):
    report = ports("2026-06-30 09:44:13", (5, 5, 1.0, 1.0, 1.0, 1))
    beyond = {**report, "timeStamp": "2026-06-30 09:45:13", "portNumber34": 3, "moduleNumber34": 3}
    found = []
    for name, whole in (("whole", True), ("lines", False)):
        folder = tmp_path / name / "wg1169" / "json"
        folder.mkdir(parents=True)
        payloads = [json.dumps({"recordData": [r]}) for r in (report, beyond)]
        files = [[json.dumps([report, beyond])]] if whole else [payloads]
        for product_name, content in (("amps-output-power-status", files[0]), ("amps-solar", ["[]"]), ("amps", ["[]"])):
            (folder / f"waveglider-{product_name}_1.json").write_text("\n".join(content))
        inputs = Inputs(str(tmp_path / name), target="wg1169", whole_file=whole)
        found.append(rows(power_tables(spark, inputs, f"{tmp_path}/out-{name}")["port_power"]))
        [high] = places_beyond(product_payloads(spark, inputs, "output_power"), 33).collect()
        assert (high.vehicle, high.payloads, high.highest) == ("wg1169", 1, 34)
    assert found[0] == found[1] and len(found[0]) == 2


def test_first_ports_are_sorted(spark, raw):
    found = port_power(product(spark, raw, "waveglider-amps-output-power-status_*.json", OUTPUT_RECORD), sensor_table(spark))
    first = first_rows(found.where("vehicle = 'wg1169'"), PORT_POWER_ORDER, 5)
    assert [(r.slot, r.port) for r in first.collect()] == [row[:2] for row in REPORT[:5]]
    assert "TakeOrderedAndProject" in first._jdf.queryExecution().executedPlan().toString()
