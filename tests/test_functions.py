import datetime as dt
import itertools
import re

import pytest
from pyspark.sql import functions as F

from fleetwatt.functions.labels import component_name, strip, vehicle_label
from fleetwatt.functions.numbers import NUMBER, marked_missing, milli_to_unit, nan_to_null, scaled, to_integer, to_number, total
from fleetwatt.functions.times import day_of, day_range, hour_of, in_day, to_time, to_time_strict


def one(spark, schema, values, *columns):
    frame = spark.createDataFrame([(value,) for value in values], schema)
    return [tuple(row) if len(columns) > 1 else row[0] for row in frame.select(*columns).collect()]


def test_numbers_from_text(spark):
    texts = [" 1.5 ", "1e3", "abc", "", "NaN", "1d", "1f", "0x10", "1_000", "inf", "-Infinity", ".5", "5.", "+2", None]
    expected = [1.5, 1000.0] + [None] * 7 + [float("inf"), float("-inf"), 0.5, 5.0, 2.0, None]
    assert one(spark, "x string", texts, to_number(F.col("x"))) == expected


def test_number_pattern_never_goes_back():
    plain = re.compile(r"^\s*[+-]?(([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?|(?i:inf|infinity))\s*$")
    found = re.compile(NUMBER)
    assert found.groups == 0
    texts = ["".join(t) for n in range(7) for t in itertools.product("1.e-\n ", repeat=n)]
    texts += [a + b + c for a in ("", "-", " +") for b in ("inf", "Infinity", "infi", "INFINITY", "infinity1", "inf inity") for c in ("", "\n", "\r\n", "x")]
    assert [t for t in texts if bool(found.search(t)) != bool(plain.search(t))] == []


def test_integers_from_text(spark):
    assert one(spark, "x string", ["7", "7.0", " 7 ", "x", None], to_integer(F.col("x"))) == [7, 7, 7, None, None]


def test_nan_and_marks_become_null(spark):
    values = [9999.0, -9999.0, 3.2, None, float("nan")]
    assert one(spark, "x double", values[:4], marked_missing(F.col("x"), (9999.0, -9999.0))) == [None, None, 3.2, None]
    assert one(spark, "x double", [1.0, float("nan"), None], nan_to_null(F.col("x"))) == [1.0, None, None]


def test_unit_conversion(spark):
    assert one(spark, "x string", ["2737947", "x"], milli_to_unit(to_number(F.col("x")))) == [2737.947, None]
    assert one(spark, "x double", [10.0], scaled(F.col("x"), 0.514444)) == [pytest.approx(5.14444)]


def test_decimal_total_is_exact(spark):
    frame = spark.createDataFrame([(0.1,)] * 10 + [(None,)], "x double")
    assert frame.agg(total(F.col("x"), 4)).first()[0] == 1.0


def test_times_from_text(spark):
    at = dt.datetime(2026, 7, 3, 10, 20, 30)
    texts = [
        "2026-07-03 10:20:30",
        "2026-07-03T10:20:30",
        "2026-07-03T10:20:30Z",
        "2026-07-03T12:20:30+02:00",
        "2026-7-3 12:20:30+02:00",
        "2026-07-03 08:20:30-02:00",
        "bad",
        "10:20",
        None,
    ]
    assert one(spark, "x string", texts, to_time(F.col("x"))) == [at] * 6 + [None] * 3
    day_first = ["03/07/2026 10:20:30", "2026-07-03 10:20:30", "31/31/2026 10:20:30"]
    assert one(spark, "x string", day_first, to_time(F.col("x"), "dd/MM/yyyy HH:mm:ss")) == [at, at, None]


def test_fractions_are_kept(spark):
    assert one(spark, "x string", ["2026-07-03 10:20:30.123456"], to_time(F.col("x")))[0].microsecond == 123456


def test_strict_time_stops(spark):
    assert one(spark, "x string", [None], to_time_strict(F.col("x"))) == [None]
    with pytest.raises(Exception, match="not a time: bad"):
        one(spark, "x string", ["bad"], to_time_strict(F.col("x")))


def test_buckets(spark):
    times = [dt.datetime(2026, 7, 3, 23, 59, 59, 5)]
    frame = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz")
    row = frame.select(hour_of(F.col("t")).alias("h"), day_of(F.col("t")).alias("d")).first()
    assert (row.h, row.d) == (dt.datetime(2026, 7, 3, 23), dt.date(2026, 7, 3))
    assert frame.select(hour_of(F.col("t")).alias("h")).schema["h"].dataType.simpleString() == "timestamp_ntz"


def test_in_day_takes_the_start_and_not_the_end(spark):
    times = [dt.datetime(2026, 7, 3), dt.datetime(2026, 7, 3, 23, 59, 59), dt.datetime(2026, 7, 4)]
    flag = in_day(F.col("x"), F.lit(dt.date(2026, 7, 3)))
    assert one(spark, "x timestamp_ntz", times, flag) == [True, True, False]


def test_day_range_reaches_the_scan(spark, sf_dir):
    from tests.conftest import plan

    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    picked = events.where(day_range(F.col("ts"), dt.date(2024, 1, 15), dt.date(2024, 1, 16))).select("ts")
    assert "GreaterThanOrEqual(ts" in plan(picked) and "LessThan(ts" in plan(picked)
    assert {row.ts.day for row in picked.collect()} == {15, 16}


def test_labels(spark):
    frame = spark.createDataFrame(
        [("GPSWaves", 1, 1, 1), (None, 1, 13, 1), (" \t ", 6, 1, 5), (" open\n", 1, 1, 1), (None, None, 1, 1)],
        "sensor string, domain int, slot int, port int",
    )
    name = component_name(F.col("sensor"), F.col("domain"), F.col("slot"), F.col("port"))
    assert [row[0] for row in frame.select(name).collect()] == ["GPSWaves", "D1-S13-P1", "D6-S1-P5", "open", "D-S1-P1"]
    assert one(spark, "x string", [None], strip(F.col("x"))) == [""]
    assert one(spark, "x string", ["wg7"], vehicle_label(F.lit(None), F.col("x"))) == ["WG7"]


def test_a_zone_is_found_behind_any_space(spark):
    texts = ["2026-07-03 10:20:30+02:00", " " * 70 + "2026-07-03 10:20:30+02:00", "2026-07-03T10:20:30Z", "2026-07-03 10:20:30"]
    table = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [str(r.t) for r in table.select(to_time(F.col("t")).alias("t")).collect()] == [
        "2026-07-03 08:20:30",
        "2026-07-03 08:20:30",
        "2026-07-03 10:20:30",
        "2026-07-03 10:20:30",
    ]
