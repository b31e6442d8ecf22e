"""Weather and wave tables from raw records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwatt.functions.numbers import scaled
from fleetwatt.operators.cleaning import blank_marks, clean_time, rename, to_numbers
from fleetwatt.schemas import KNOTS_TO_MS, MISSING_MARKS, WAVE_COLUMNS, WAVE_MARKED, WEATHER_COLUMNS


def weather(records: DataFrame) -> DataFrame:
    cleaned = to_numbers(clean_time(records, "timeStamp"), WEATHER_COLUMNS)
    renamed = rename(cleaned, WEATHER_COLUMNS, keep=["vehicle", "timeStamp"])
    return renamed.withColumn("wind_speed_ms", scaled(F.col("wind_speed_kt"), KNOTS_TO_MS))


def waves(records: DataFrame) -> DataFrame:
    cleaned = to_numbers(clean_time(records, "timeStamp"), WAVE_COLUMNS)
    return blank_marks(rename(cleaned, WAVE_COLUMNS, keep=["vehicle", "timeStamp"]), WAVE_MARKED, MISSING_MARKS)
