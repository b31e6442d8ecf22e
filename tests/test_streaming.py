import datetime as dt
import json

from pyspark.sql import functions as F

from fleetwatt.functions.numbers import total
from fleetwatt.operators.rollups import hourly_mean
from fleetwatt.schemas import text_fields
from fleetwatt.streaming.dedup import drop_repeats
from fleetwatt.streaming.hourly import hourly_store, mark_late
from fleetwatt.streaming.ingest import drain, stream_parquet, stream_records
from fleetwatt.streaming.restate import DayStore
from tests.conftest import rows


def at(text):
    return dt.datetime.fromisoformat(text)


def put(spark, path, values):
    spark.createDataFrame([("wg1", at(t), v) for t, v in values], "vehicle string, ts timestamp_ntz, value double").coalesce(
        1
    ).write.mode("append").parquet(path)


def test_stream_of_records(spark, tmp_path):
    folder = tmp_path / "wg1"
    folder.mkdir()

    def scan():
        found = stream_records(spark, f"{tmp_path}/*/*.json", text_fields(["a"]), "/([^/]+)/[^/]*$")
        drain(found.select("vehicle", "a"), f"{tmp_path}/cp").format("parquet").start(f"{tmp_path}/out").awaitTermination()
        return rows(spark.read.parquet(f"{tmp_path}/out"))

    (folder / "1.json").write_text(json.dumps({"recordData": [{"a": 1}, {"a": 2}]}))
    assert scan() == [("wg1", "1"), ("wg1", "2")]
    (folder / "2.json").write_text(json.dumps([{"a": 3}]))
    assert scan() == [("wg1", "1"), ("wg1", "2"), ("wg1", "3")]


def test_hourly_stream_equals_the_batch(spark, tmp_path):
    source = f"{tmp_path}/in"
    store = hourly_store(spark, f"{tmp_path}/store", "ts", "value", ["vehicle"], ["vehicle", "ts"])

    def follow():
        store.follow(stream_parquet(spark, source, 1))
        return rows(store.read().select("vehicle", "sampleHour", "mean_value"))

    def batch():
        return rows(hourly_mean(spark.read.parquet(source).distinct(), "ts", "value", "m"))

    put(spark, source, [("2026-07-03 10:05", 2.0), ("2026-07-03 10:50", 4.0), ("2026-07-03 11:10", 1.0)])
    assert follow() == batch()
    # A record that is fetched again counts once.
    put(spark, source, [("2026-07-03 10:05", 2.0), ("2026-07-03 10:55", 9.0), ("2026-07-04 00:00", 5.0)])
    assert follow() == batch()
    assert len(batch()) == 3


def test_history_in_any_order_and_cut_into_batches_is_whole(spark, tmp_path):
    source = f"{tmp_path}/in"
    for day in (30, 3, 4):
        put(spark, source, [(f"2026-07-{day:02} 10:05", float(day))])
    store = hourly_store(spark, f"{tmp_path}/store", "ts", "value", ["vehicle"], ["vehicle", "ts"])
    store.follow(stream_parquet(spark, source, 1))
    assert sorted(r.total for r in store.read().collect()) == [3.0, 4.0, 30.0]
    assert {r.n for r in store.read().collect()} == {1}


def test_late_records_are_marked(spark):
    table = spark.createDataFrame(
        [(0, at("2026-07-10 10:00")), (1, at("2026-07-08 10:00")), (1, at("2026-07-08 09:59")), (2, at("2026-07-11 00:00"))],
        "batch long, ts timestamp_ntz",
    )
    assert [r.ts for r in mark_late(table, "ts").where("late").collect()] == [at("2026-07-08 09:59")]


def test_repeats_are_dropped_across_batches(spark, tmp_path):
    source = f"{tmp_path}/in"
    put(spark, source, [("2026-07-03 10:05", 2.0), ("2026-07-03 10:05", 2.0)])
    put(spark, source, [("2026-07-03 10:05", 2.0), ("2026-07-03 11:05", 3.0)])
    once = drop_repeats(stream_parquet(spark, source, 1), "ts", ["vehicle", "ts"])
    drain(once, f"{tmp_path}/cp").format("parquet").start(f"{tmp_path}/out").awaitTermination()
    assert rows(spark.read.parquet(f"{tmp_path}/out").select("ts", "value")) == [
        (at("2026-07-03 10:05"), 2.0),
        (at("2026-07-03 11:05"), 3.0),
    ]


def day_totals(arrivals):
    return arrivals.groupBy("vehicle", "day").agg(total(F.col("value"), 4).alias("total"))


def test_restated_days(spark, tmp_path):
    source = f"{tmp_path}/in"
    store = DayStore(spark, f"{tmp_path}/store", "ts", ["vehicle", "ts"], [], day_totals)

    def follow():
        store.follow(stream_parquet(spark, source))
        return {r.day.day: r.total for r in store.read().collect()}

    put(spark, source, [("2026-07-01 10:00", 1.0), ("2026-07-02 10:00", 2.0), ("2026-07-03 10:00", 3.0)])
    assert follow() == {1: 1.0, 2: 2.0, 3: 3.0}
    untouched = sorted((tmp_path / "store" / "result" / "day=2026-07-01").iterdir())
    # The last two days are fetched again: one value is corrected, one record is new, one repeats.
    put(spark, source, [("2026-07-02 10:00", 20.0), ("2026-07-03 10:00", 3.0), ("2026-07-03 11:00", 30.0)])
    assert follow() == {1: 1.0, 2: 20.0, 3: 33.0}
    assert sorted((tmp_path / "store" / "result" / "day=2026-07-01").iterdir()) == untouched
    assert follow() == {1: 1.0, 2: 20.0, 3: 33.0}
    assert store.last_copies().count() == 4


def batch_of(spark, *values):
    made = [("wg1", at(t), v, pos) for t, v, pos in values]
    return spark.createDataFrame(made, "vehicle string, ts timestamp_ntz, value double, pos int")


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    store = DayStore(spark, f"{tmp_path}/store", "ts", ["vehicle", "ts"], ["pos"], day_totals)
    one, two = batch_of(spark, ("2026-07-01 10:00", 1.0, 0)), batch_of(spark, ("2026-07-01 11:00", 2.0, 0))
    for batch_id, batch, total_ in [(0, one, 1.0), (0, one, 1.0), (1, one.limit(0), 1.0), (2, two, 3.0), (2, two, 3.0), (3, one, 3.0), (4, two, 3.0)]:
        store.add(batch, batch_id)
        assert rows(store.read().select("total")) == [(total_,)]
    assert store.last_copies().count() == 2


def test_the_last_copy_of_a_batch_wins(spark, tmp_path):
    store = DayStore(spark, f"{tmp_path}/store", "ts", ["vehicle", "ts"], ["pos"], day_totals)
    when = "2026-07-01 10:00"
    steps = [
        ([(when, 1.0, 0), (when, 2.0, 1)], 2.0),
        ([(when, 2.0, 7)], 2.0),
        ([(when, 1.0, 0)], 1.0),
        # The first copy differs from what is stored, the last one does not.
        ([(when, 2.0, 0), (when, 1.0, 1)], 1.0),
        ([(when, 1.0, 0), (when, 5.0, 1)], 5.0),
    ]
    for batch_id, (values, expected) in enumerate(steps):
        store.add(batch_of(spark, *values), batch_id)
        assert rows(store.read().select("total")) == [(expected,)]


def test_batches_leave_a_bounded_number_of_files(spark, tmp_path):
    store = DayStore(spark, f"{tmp_path}/store", "ts", ["vehicle", "ts"], ["pos"], day_totals)
    for batch_id in range(50):
        store.add(batch_of(spark, (f"2026-07-0{1 + batch_id % 2} 10:{batch_id:02}", 1.0, 0)), batch_id)
    assert {r.day.day: r.total for r in store.read().collect()} == {1: 25.0, 2: 25.0}
    folders = [p for p in (tmp_path / "store").rglob("*") if p.is_dir()]
    files = [p for p in (tmp_path / "store").rglob("*.parquet") if p.is_file()]
    assert len(folders) <= 12 and len(files) <= 12


def test_days_off_the_calendar_are_set_aside(spark, tmp_path):
    store = DayStore(spark, f"{tmp_path}/store", "ts", ["vehicle", "ts"], ["pos"], day_totals)
    store.add(batch_of(spark, ("1970-01-01 00:00", 7.0, 0), ("2026-07-01 10:00", 1.0, 0)), 0)
    assert rows(store.read().select("total")) == [(1.0,)]
    assert rows(spark.read.parquet(store.outside).select("value")) == [(7.0,)]
