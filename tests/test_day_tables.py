import datetime as dt
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from bench import raw_files
from fleetwatt.functions.times import day_of, to_time
from fleetwatt.plans.incremental import job_tables, overview
from fleetwatt.plans.job import Inputs, run
from fleetwatt.schemas import text_fields
from fleetwatt.sources.json_records import SOURCE_ORDER, read_payloads, records, vehicle_from_path
from fleetwatt.streaming.day_tables import DayTables, Source, Table
from tests.conftest import rows


def day(text):
    return dt.date.fromisoformat(text)


@pytest.fixture
def store(spark, tmp_path):
    """Values by day and vehicle of JSON files in vehicle folders."""
    folder = tmp_path / "raw" / "wg1"
    folder.mkdir(parents=True)

    def read(paths):
        payloads = vehicle_from_path(read_payloads(spark, list(paths)), "/([^/]+)/[^/]*$")
        found = records(payloads, text_fields(["t", "v"]))
        return found.withColumn("day", day_of(to_time(F.col("t"))))

    def sums(readings):
        return readings.groupBy("vehicle", "day").agg(F.sum(F.col("v").cast("double")).alias("total"), F.count("*").alias("n"))

    def peaks(daily):
        return daily.where("total > 5").select("vehicle", "day", "total")

    def make():
        source = Source("readings", [f"{tmp_path}/raw/*/*.json"], read)
        return DayTables(spark, f"{tmp_path}/out", [source], [Table("daily", ["readings"], sums), Table("peaks", ["daily"], peaks)])

    def put(name, *values):
        (folder / name).write_text(json.dumps([{"t": t, "v": v} for t, v in values]))

    return make, put, folder


def test_files_fetched_again_under_their_name_replace_their_records(store):
    make, put, folder = store
    put("a.json", ("2026-07-01 10:00", 1), ("2026-07-01 11:00", 2))
    put("b.json", ("2026-07-02 10:00", 4), ("2026-07-03 10:00", 9))
    put("c.json", ("2026-07-05 10:00", 7))
    tables = make()
    assert tables.refresh()["daily"] == [day(f"2026-07-0{n}") for n in (1, 2, 3, 5)]
    # One file is corrected, one is shortened, one has vanished, one is new and late, and one has moved a record.
    put("a.json", ("2026-07-01 10:00", 1), ("2026-07-01 11:00", 30))
    put("b.json", ("2026-07-02 10:00", 4))
    os.remove(folder / "c.json")
    put("d.json", ("2026-06-01 10:00", 8))
    tables = make()
    assert tables.refresh() == {
        "readings": [day(f"2026-0{t}") for t in ("6-01", "7-01", "7-03", "7-05")],
        "daily": [day(f"2026-0{t}") for t in ("6-01", "7-01", "7-03", "7-05")],
        "peaks": [day(f"2026-0{t}") for t in ("6-01", "7-01", "7-03", "7-05")],
    }
    expected = [("wg1", day("2026-06-01"), 8.0), ("wg1", day("2026-07-01"), 31.0), ("wg1", day("2026-07-02"), 4.0)]
    assert rows(tables.read("daily").select("vehicle", "day", "total")) == expected
    assert rows(tables.read("peaks").select("vehicle", "day", "total")) == [expected[0], expected[1]]
    # A state that is taken up again is the same.
    assert rows(make().read("daily").select("vehicle", "day", "total")) == expected


def test_content_that_is_the_same_touches_nothing(store):
    make, put, folder = store
    put("a.json", ("2026-07-01 10:00", 1))
    tables = make()
    tables.refresh()
    assert tables.refresh() == {"readings": [], "daily": [], "peaks": []} and tables.run == 1
    later = time.time() + 100
    os.utime(folder / "a.json", (later, later))
    assert tables.refresh()["daily"] == [] and tables.run == 2  # the ledger takes the new time
    assert tables.refresh()["daily"] == [] and tables.run == 2


def test_a_refresh_that_fails_changes_nothing(store, spark):
    make, put, _ = store
    put("a.json", ("2026-07-01 10:00", 1))
    make().refresh()
    put("a.json", ("2026-07-01 10:00", 2))
    broken = make()

    def fails(readings):
        raise RuntimeError("lost")

    broken.tables[0] = Table("daily", ["readings"], fails)
    with pytest.raises(RuntimeError):
        broken.refresh()
    again = make()
    assert [r.total for r in again.read("daily").collect()] == [1.0]
    assert [r.v for r in again.read("readings").collect()] == ["1"]
    put("a.json", ("2026-07-04 10:00", 3))  # the failed refresh had written another day
    again.refresh()
    assert rows(again.read("daily").select("day", "total")) == [(day("2026-07-04"), 3.0)]


def test_days_off_the_calendar_and_files_without_records(store):
    make, put, _ = store
    put("a.json", ("2026-07-01 10:00", 1), ("1970-01-01 00:00", 5), ("no time", 6))
    put("b.json")
    tables = make()
    tables.refresh()
    assert tables.days("daily") == [day("2026-07-01")]
    assert sorted(r.outside for r in tables.ledger().collect()) == [0, 1]


def comparable(frame):
    rounded = frame.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in sorted(frame.dtypes)])
    return rows(rounded)


def test_the_whole_job_follows_one_more_day(spark, tmp_path):
    """Files of four days, then a fifth and a corrected one: all tables equal those of a whole run, and other days are not read."""
    raw_files(f"{tmp_path}/all", days=5, ports=4)
    inputs = Inputs(f"{tmp_path}/all")
    last = "2026-07-04"
    held = {}
    for vehicle in ("wg1169", "wg1170"):
        folder = tmp_path / "all" / vehicle / "json"
        for file in list(folder.iterdir()):
            text = file.read_text()
            if last in file.name:
                held[file] = text
                os.remove(file)
            elif file.suffix == ".csv":
                held[file] = text
                file.write_text("\n".join(line for line in text.split("\n") if last not in line and "04/07/2026" not in line))
    tables = job_tables(spark, inputs, f"{tmp_path}/tables")
    tables.refresh()
    for file, text in held.items():
        file.write_text(text)
    corrected = tmp_path / "all" / "wg1169" / "json" / "waveglider-amps-solar_2026-07-01.json"
    found = json.loads(corrected.read_text())
    found["recordData"] = found["recordData"][:-3]
    corrected.write_text(json.dumps(found))
    touched = tables.refresh()
    assert touched["port_power"] == [day(last)] and touched["sensor_availability"] == [day(last)]
    assert touched["hourly_flows"] == touched["series"] == [day("2026-07-01"), day(last)]
    whole = run(spark, inputs, f"{tmp_path}/whole", as_of=day("2026-07-01"))
    for table in tables.tables:
        if table.name in whole:
            names = [c for c in whole[table.name].columns if c != "day"]
            assert comparable(tables.read(table.name).select(names)) == comparable(whole[table.name].select(names)), table.name
    for name, table in overview(tables, day("2026-07-01")).items():
        assert comparable(table) == comparable(whole[name]), name
    # Only the folders of a touched day are scanned.
    scanned = tables.read("port_power", [day(last)]).inputFiles()
    assert scanned and all(f"day={last}" in file for file in scanned)
