import datetime as dt
import json
import random

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetwatt.functions.numbers import to_number
from fleetwatt.functions.times import to_time
from fleetwatt.operators.days import first_last
from fleetwatt.operators.rollups import hourly_mean
from fleetwatt.schemas import text_fields
from fleetwatt.sources.json_records import (
    ALL_FIELDS,
    BARE_LIST,
    RECORD_DATA,
    file_census,
    malformed,
    read_payloads,
    records,
    require_records,
    vehicle_from_path,
)
from fleetwatt.sources.tables import file_counts, list_files, read_csv, read_vehicle_csv, row_counts, write_csv, write_json, write_parquet
from tests.conftest import rows

A = text_fields(["a"])


def payloads(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, value string")
    zero = F.lit(0).cast("long")
    return frame.select(F.concat(F.lit("f"), F.col("i").cast("string")).alias("file"), zero.alias("chunk"), zero.alias("line"), "value")


def values(frame):
    return [row.a for row in frame.orderBy("source_order").collect()]


def test_envelopes(spark):
    texts = ['{"recordData":[{"a":1}]}', ' [{"a":2}]', "[]", '{"x":1}', '{"recordData":[]}', '{"recordData":null}', "5"]
    assert values(records(payloads(spark, texts), A)) == ["1", "2"]
    assert values(records(payloads(spark, texts), A, (BARE_LIST,))) == ["2"]
    assert values(records(payloads(spark, texts), A, (RECORD_DATA,))) == ["1"]


def test_elements_that_are_no_objects_are_skipped(spark):
    texts = ['[{"a":1},5,"z",[1],null,{"a":3}]', '{"recordData":[{"a":4},7]}', '[{"a":{"n":1}},{"b":1}]']
    assert values(records(payloads(spark, texts), A)) == ["1", "3", "4", '{"n":1}', None]


def test_all_fields(spark):
    found = records(payloads(spark, ['[{"a":1,"b":"x"}]', "[5]"]), ALL_FIELDS)
    assert [row.fields for row in found.collect()] == [{"a": "1", "b": "x"}]


@pytest.mark.parametrize("text", ["bad", '[{"a":1},', '{"recordData":[{"a":1}', ""])
def test_malformed_text_stops(spark, text):
    broken = payloads(spark, [text])
    assert broken.select(malformed(F.col("value"))).first()[0]
    with pytest.raises(Exception, match="malformed JSON payload in f0"):
        records(broken, A).collect()
    assert records(broken, A, lenient=True).count() == 0


def test_file_scan(spark, tmp_path):
    for vehicle, name, content in [
        ("wg1", "waveglider-amps_1.json", {"recordData": [{"a": 1}, {"a": 2}]}),
        ("wg1", "waveglider-amps_2.json", [{"a": 3}]),
        ("wg1", "waveglider-amps-solar_1.json", [{"a": 99}]),
        ("wg2", "waveglider-amps_1.json", []),
    ]:
        folder = tmp_path / vehicle / "json"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / name).write_text(json.dumps(content, indent=2))
    scan = vehicle_from_path(read_payloads(spark, f"{tmp_path}/*/json/waveglider-amps_*.json"), "/([^/]+)/json/[^/]*$")
    found = records(scan, A)
    assert [(r.vehicle, r.a) for r in found.orderBy("source_order").collect()] == [("wg1", "1"), ("wg1", "2"), ("wg1", "3")]
    census = file_census(scan).select("vehicle", F.element_at(F.split("file", "/"), -1).alias("file"), "n")
    assert rows(census) == [
        ("wg1", "waveglider-amps_1.json", 2),
        ("wg1", "waveglider-amps_2.json", 1),
        ("wg2", "waveglider-amps_1.json", 0),
    ]
    files = list_files(spark, f"{tmp_path}/*/json/waveglider-amps_*.json")
    assert rows(file_counts({"battery": files}).drop("bytes")) == [("battery", 3)]


def test_no_matching_file_stops(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_payloads(spark, f"{tmp_path}/nothing_*.json")


def test_files_without_records_stop(spark):
    with pytest.raises(ValueError, match="no wave records"):
        require_records(records(payloads(spark, ["[]", "{}"]), A), "wave")


def test_payload_lines_keep_their_order(spark, tmp_path):
    (tmp_path / "a.txt").write_text('[{"a":1},{"a":2}]\n{"recordData":[{"a":3}]}\n')
    (tmp_path / "b.txt").write_text('[{"a":4}]\n')
    assert values(records(read_payloads(spark, str(tmp_path), whole_file=False), A)) == ["1", "2", "3", "4"]


def test_csv_round_trip(spark, tmp_path):
    table = spark.createDataFrame(
        [("wg1", "2026-07-03 10:00:00.123456", ' a "quoted", text ', 1.5), ("wg2", "2026-07-03 10:00:00", None, None)],
        "vehicle string, t string, note string, `value (W)` double",
    ).withColumn("t", F.col("t").cast("timestamp_ntz"))
    write_csv(table, f"{tmp_path}/out", order=["t"])
    back = read_csv(spark, f"{tmp_path}/out", text_fields(["vehicle", "t", "note", "value (W)"]))
    assert rows(back) == [
        ("wg1", "2026-07-03 10:00:00.123456", ' a "quoted", text ', "1.5"),
        ("wg2", "2026-07-03 10:00:00", None, None),
    ]


def test_csv_columns_by_name(spark, tmp_path):
    (tmp_path / "x.csv").write_text("b,a\n1,2\n")
    assert rows(read_csv(spark, f"{tmp_path}/x.csv", text_fields(["a"]))) == [("2",)]
    with pytest.raises(KeyError, match="Ocean CO2 Ave"):
        read_csv(spark, f"{tmp_path}/x.csv", text_fields(["Ocean CO2 Ave"]))
    (tmp_path / "y").mkdir()
    (tmp_path / "y" / "1.csv").write_text("a,b\n1,2\n")
    (tmp_path / "y" / "2.csv").write_text("b,a\n1,2\n")
    with pytest.raises(Exception, match="header"):
        read_csv(spark, f"{tmp_path}/y", text_fields(["a", "b"])).collect()
    both = read_vehicle_csv(spark, {"wg1": f"{tmp_path}/x.csv", "wg2": f"{tmp_path}/x.csv"}, text_fields(["a", "b"]))
    assert rows(both) == [("wg1", "2", "1"), ("wg2", "2", "1")]


def test_parquet_replaces_only_the_days_written(spark, tmp_path):
    path = f"{tmp_path}/t"
    first = spark.createDataFrame([("wg1", 1, "d1"), ("wg1", 2, "d2")], "vehicle string, x int, day string")
    write_parquet(first, path, ["x"], ["day"])
    again = spark.createDataFrame([("wg1", 3, "d2")], "vehicle string, x int, day string")
    write_parquet(again, path, ["x"], ["day"], mode="dynamic")
    assert rows(spark.read.parquet(path).select("day", "x")) == [("d1", 1), ("d2", 3)]
    write_parquet(again, path, ["x"], ["day"])
    assert rows(spark.read.parquet(path).select("day", "x")) == [("d2", 3)]


def test_json_sink_and_row_counts(spark, tmp_path):
    table = spark.createDataFrame([("wg1", 1.0), ("wg2", 2.0)], "vehicle string, y double")
    write_json(table, f"{tmp_path}/j")
    assert rows(spark.read.json(f"{tmp_path}/j/vehicle=wg2")) == [(2.0,)]
    assert rows(row_counts({"a": table, "b": table.where("y > 1")})) == [("a", 2), ("b", 1)]


def test_a_hot_day_is_written_in_several_tasks(spark, tmp_path):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "64k")
    try:
        table = spark.range(0, 200_000, 1, 8).selectExpr(
            "'wg1' as vehicle", "uuid() as x", "if(id % 3 = 0, 'hot', concat('d', id % 20)) as day"
        )
        write_parquet(table, f"{tmp_path}/t", ["x"], ["day"])
    finally:
        spark.conf.set(key, before)
    assert len(list((tmp_path / "t" / "day=hot").glob("*.parquet"))) > 4
    assert spark.read.parquet(f"{tmp_path}/t").count() == 200_000


def test_days_of_csv_tables_equal_sql(spark, tmp_path):
    """Hourly and per-report tables of 48 days, with gaps, nights, repeats and blank values, as CSV."""
    rng = random.Random(3)
    start = dt.datetime(2026, 6, 30, 9)
    hours = [start + dt.timedelta(hours=h) for h in range(48 * 24) if rng.random() > 0.08]
    output = [(h, round(rng.uniform(0, 70), 3) if rng.random() > 0.02 else None) for h in hours]
    reports = [h + dt.timedelta(minutes=43, seconds=rng.randint(0, 59)) for h in hours if rng.random() > 0.2]
    battery = [(t, round(rng.uniform(2000, 2800), 3)) for t in [*reports, *reports[400:402]]]

    def put(name, rows_):
        text = "".join(f"{t},{'' if v is None else v}\n" for t, v in rows_)
        (tmp_path / name).write_text("timestamp,value\n" + text)
        found = read_csv(spark, str(tmp_path / name), text_fields(["timestamp", "value"]))
        return found.select(F.lit("wg1").alias("vehicle"), to_time(F.col("timestamp")).alias("timestamp"), to_number(F.col("value")).alias("value"))

    means = hourly_mean(put("output.csv", output), "timestamp", "value", "mean")
    ends = first_last(put("battery.csv", battery), "timestamp", "value")

    def sql(text):
        return sorted(duckdb.sql(text).fetchall())

    expected = sql(f"select 'wg1', date_trunc('hour', timestamp), avg(value) from '{tmp_path}/output.csv' group by 2")
    assert sorted((r[0], r[1], None if r[2] is None else pytest.approx(r[2])) for r in map(tuple, means.collect())) == expected
    expected = sql(
        f"""select 'wg1', timestamp::date, min(value) filter (timestamp = low), max(value) filter (timestamp = high)
        from (select *, min(timestamp) over d as low, max(timestamp) over d as high from '{tmp_path}/battery.csv'
              window d as (partition by timestamp::date)) group by 2"""
    )
    assert rows(ends) == expected and len(expected) > 40
