"""Declared input schemas and the fixed values of the telemetry products."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- Fixed values: they have to equal the producer's to give the same results ---

# (slot, port) -> sensor name.
PORT_SENSORS = [
    (1, 1, "GPSWaves"),
    (1, 2, "Iridium"),
    (1, 3, "SMC"),
    (1, 4, "CR6"),
    (1, 7, "ADCP"),
    (4, 1, "Airmar WS200"),
    (4, 3, "lightBar"),
    (4, 5, "airmarWaterspeedDevice"),
    (5, 1, "SPN1 Heater"),
    (5, 2, "SPN1"),
    (5, 3, "Vaisala WXT530 Heater"),
    (5, 4, "Vaisala WXT530"),
    (5, 5, "RBR CTD"),
    (5, 6, "Gill R3-50"),
    (7, 2, "pCO2"),
    (7, 4, "AIS"),
    (32, 1, "CCU: UNKNOWN"),
    (32, 3, "VMC"),
    (32, 106, "CCU: Tegra TX1 SOM module"),
    (32, 108, "CCU: mSATA Drive, SDCARD, discrete ICs"),
    (32, 110, "CCU: UARTs, HS/LS USB Hubs, Ethernet"),
]

# Component colours, assigned in name order and reused after the last one.
PALETTE = [
    "#0072B2",
    "#E69F00",
    "#009E73",
    "#D55E00",
    "#CC79A7",
    "#56B4E9",
    "#F0E442",
    "#000000",
    "#332288",
    "#88CCEE",
    "#44AA99",
    "#117733",
    "#999933",
    "#AA4499",
]

# Vehicle key -> display label.
VEHICLE_LABELS = [
    ("wg1169", "WG1169 - Vetkoek"),
    ("wg1170", "WG1170 - Melktert"),
]

# Order of the sensors on the availability axis; pCO2 only where it reports.
SENSOR_ORDER = ["GPSWaves", "SPN1", "RBR CTD", "Vaisala", "Gill R3-50", "Airmar WS200"]
OPTIONAL_SENSORS = ["pCO2"]

# Daily files of each product.
FILE_PATTERNS = {
    "output_power": "waveglider-amps-output-power-status_*.json",
    "solar": "waveglider-amps-solar_*.json",
    "battery": "waveglider-amps_*.json",
    "weather": "waveglider-weather_*.json",
    "waves": "waveglider-waves_*.json",
    "airsea": "AirSeaWHIRLS_Decoded.csv",
    "vegas": "VeGAS_decoded.csv",
}

POWER_THRESHOLD_W = 0.2
# Chart titles of a day: label, day, gained, used; battery start, end, change.
POWER_TITLE = "%s: Average Power Usage (Watts) with Total Usage and Solar Gain<br>Date: %s | Daily gained: %s Wh | Daily used: %s Wh"
BATTERY_TITLE = "Total Battery Power | Start: %s W | End: %s W | Daily gain/loss: %s W"
KNOTS_TO_MS = 0.514444
MISSING_MARKS = (9999.0, -9999.0)

OUTPUT_SLOTS = 33
SOLAR_SLOTS = 4
OUTPUT_FIELDS = ["portStatus", "avgPower", "avgVoltage", "avgCurrent", "sampleTime"]
BATTERY_REQUIRED = ["gliderTimeStamp", "totalBatteryPower"]

# Input field -> output column.
WEATHER_COLUMNS = {
    "latitude": "latitude",
    "longitude": "longitude",
    "avgTemp(C)": "air_temperature",
    "avgPress(mbar)": "air_pressure",
    "avgWindSpeed(kt)": "wind_speed_kt",
    "stdDevWindSpeed(kt)": "wind_speed_std",
    "avgWindDir(deg)": "wind_dir_deg",
    "stdDevWindDir(deg)": "wind_dir_std_deg",
    "gustSpeed(kt)": "gust_speed_kt",
    "gustDir(deg)": "gust_dir_deg",
    "gustTime(hour)": "gust_hour",
    "gustTime(minute)": "gust_minute",
    "numValidWindSamples": "num_valid_wind_samples",
}
WAVE_COLUMNS = {
    "latitude": "latitude",
    "longitude": "longitude",
    "hs (m)": "significant_wave_height_m",
    "ta (s)": "average_wave_period_s",
    "tp (s)": "peak_wave_period_s",
    "dp (deg)": "peak_wave_direction_deg",
    "samples": "n_samples",
    "fs (Hz)": "sampling_frequency_hz",
    "sample Gaps": "sample_gaps",
}
WAVE_MARKED = [
    "significant_wave_height_m",
    "average_wave_period_s",
    "peak_wave_period_s",
    "peak_wave_direction_deg",
]
DAY_FIRST_FORMATS = ("dd/MM/yyyy HH:mm:ss", "dd/MM/yyyy HH:mm", "dd-MM-yyyy HH:mm:ss", "dd/MM/yyyy")


@dataclass(frozen=True)
class SensorSpec:
    """One availability sensor: where its measurement and time come from."""

    sensor: str
    source: str
    time: str
    value: str
    formats: tuple[str, ...] = ()


SENSOR_SPECS = [
    SensorSpec("GPSWaves", "waves", "timeStamp", "significant_wave_height_m"),
    SensorSpec("SPN1", "airsea", "Logger_DateTime", "SPN1_Raw_Total_Avg"),
    SensorSpec("RBR CTD", "airsea", "Logger_DateTime", "RBR_Temp_Avg"),
    SensorSpec("Vaisala", "airsea", "Logger_DateTime", "wind_speed_Max"),
    SensorSpec("Gill R3-50", "airsea", "Logger_DateTime", "Ux_gill_Avg"),
    SensorSpec("Airmar WS200", "weather", "timeStamp", "wind_speed_kt"),
    SensorSpec("pCO2", "vegas", "sensor_time", "Ocean CO2 Ave", DAY_FIRST_FORMATS),
]

# --- Input schemas: raw fields are text, converted by explicit expressions ---


def text_fields(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def numbered(fields: list[str], slots: int) -> list[str]:
    return [f"{field}{slot}" for slot in range(1, slots + 1) for field in fields]


PORT_KEYS = ["portNumber", "moduleNumber"]
# The parser makes every declared field, so only the fields that are read are declared.
OUTPUT_READ = [name for name in OUTPUT_FIELDS if name != "sampleTime"]
OUTPUT_RECORD = text_fields(["timeStamp", "powerDomain", *numbered(PORT_KEYS + OUTPUT_READ, OUTPUT_SLOTS)])
PANEL_RECORD = text_fields(["timeStamp", *numbered(PORT_KEYS + ["panelPower"], SOLAR_SLOTS)])
WEATHER_RECORD = text_fields(["timeStamp", *WEATHER_COLUMNS])
WAVE_RECORD = text_fields(["timeStamp", *WAVE_COLUMNS])


def csv_fields(source: str) -> T.StructType:
    """Columns of a decoded CSV source that the sensor specs read."""
    specs = [spec for spec in SENSOR_SPECS if spec.source == source]
    return text_fields(list(dict.fromkeys([spec.time for spec in specs] + [spec.value for spec in specs])))
