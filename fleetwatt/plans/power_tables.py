"""Power tables from raw port, solar and battery records.

Raw records carry ``vehicle`` and ``source_order``; see ``sources.json_records``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwatt.functions.numbers import milli_to_unit, to_integer, to_number
from fleetwatt.functions.times import hour_of, to_time_strict
from fleetwatt.operators.ports import label_ports, port_rows, unpivot_ports, used_places
from fleetwatt.operators.rollups import positive_sum
from fleetwatt.schemas import OUTPUT_READ, OUTPUT_SLOTS, SOLAR_SLOTS
from fleetwatt.sources.json_records import SOURCE_ORDER

PORT_POWER_ORDER = ["timestamp", "domain", "slot", "port"]


def port_power(output_records: DataFrame, sensors: DataFrame) -> DataFrame:
    """Every reported port of every record, unlabelled ports included.

    A narrow plan: records are expanded and labelled where they are read.
    """
    # Hundreds of fields become one array first, so that no later step carries them. The time is the same for all
    # ports of a record: parse it before they are expanded.
    narrow = used_places(output_records.drop(SOURCE_ORDER), OUTPUT_READ, OUTPUT_SLOTS).withColumns(
        {"timeStamp": to_time_strict(F.col("timeStamp")), "powerDomain": to_integer(F.col("powerDomain"))}
    )
    ports = port_rows(narrow.withColumn("sampleHour", hour_of(F.col("timeStamp"))))
    typed = ports.select(
        "vehicle",
        F.col("timeStamp").alias("timestamp"),
        "sampleHour",
        F.col("powerDomain").alias("domain"),
        to_integer(F.col("moduleNumber")).alias("slot"),
        to_integer(F.col("portNumber")).alias("port"),
        to_number(F.col("avgPower")).alias("avg_power_W"),
        to_number(F.col("avgVoltage")).alias("avg_voltage_V"),
        to_number(F.col("avgCurrent")).alias("avg_current_A"),
        to_integer(F.col("portStatus")).alias("port_status"),
    )
    return label_ports(typed, sensors).select(
        "vehicle",
        "timestamp",
        "sampleHour",
        "domain",
        "slot",
        "port",
        "sensor",
        "avg_power_W",
        "avg_voltage_V",
        "avg_current_A",
        "port_status",
    )


def solar_power(solar_records: DataFrame, scale: int | None = None) -> DataFrame:
    """Power of the panels that deliver any, per report time; ``PANEL_RECORD`` has all fields this needs."""
    timed = solar_records.drop(SOURCE_ORDER).withColumn("timeStamp", to_time_strict(F.col("timeStamp")))
    panels = unpivot_ports(timed, ["panelPower"], SOLAR_SLOTS).withColumn("panelPower", to_number(F.col("panelPower")))
    return positive_sum(panels, "timeStamp", "panelPower", "solar_power_W", scale=scale)


def battery_power(time: Column, milliwatts: Column, records: DataFrame, distinct: bool = False) -> DataFrame:
    """Battery power in watts; rows without a time or a value are dropped, repeats only with ``distinct``.

    A time that is no time stops the job.
    """
    power = records.select(
        "vehicle", to_time_strict(time).alias("timestamp"), milli_to_unit(to_number(milliwatts)).alias("total_battery_power_W")
    ).na.drop(subset=["timestamp", "total_battery_power_W"])
    return power.distinct() if distinct else power


def summary_battery_power(battery_records: DataFrame, distinct: bool = False) -> DataFrame:
    """Battery power from summary records in a map column ``fields``."""
    fields = F.col("fields")
    return battery_power(fields["gliderTimeStamp"], fields["totalBatteryPower"], battery_records, distinct)
