"""Intervals, partial states, moved records, global order, buckets and titles."""

import datetime as dt
import random
import uuid

import pytest
from pyspark.sql import functions as F

from fleetwatt import bindings
from fleetwatt.functions.numbers import one_decimal
from fleetwatt.operators.intervals import interval_join
from fleetwatt.operators.partials import day_ends, hour_figures, hour_states, merged, taken_back, updated
from fleetwatt.sources.tables import write_bucketed, write_ordered
from fleetwatt.streaming.day_tables import Table
from fleetwatt.streaming.moved import RecordStore
from tests.conftest import plan, rows

START = dt.datetime(2026, 7, 1)


def test_titles_round_like_exact_decimals(spark):
    rng = random.Random(3)
    values = [2.25, 0.15, 0.35, 0.25, 0.05, -0.05, -0.25, 0.0, -0.0, -0.04, 1e16, 123456789012345.65, 4503599627370497.5, -1e17, 0.95, 99.95]
    values += [rng.uniform(-1, 1) * 10 ** rng.randint(-3, 17) for _ in range(2000)] + [rng.randint(-4000, 4000) / 80 for _ in range(2000)]
    frame = spark.createDataFrame([(v,) for v in [*values, None]], "v double").select("v", one_decimal(F.col("v")).alias("text"), one_decimal(F.col("v"), True).alias("signed"))
    for row in frame.collect():
        if row.v is None:
            assert row.text is None and row.signed is None
        else:
            assert (row.text, row.signed) == (f"{row.v:.1f}", f"{row.v:+.1f}"), repr(row.v)


def test_intervals_against_every_pair(spark):
    rng = random.Random(4)
    lengths = [0, 1, 59, 60, 61, 3600, 86400, 40 * 86400, 400 * 86400]

    def at(seconds):
        return START + dt.timedelta(seconds=seconds, microseconds=rng.choice([0, 0, 1]))

    points = [(rng.choice(["a", "b"]), n, at(rng.randint(-10**6, 10**7)) if n % 20 else None) for n in range(300)]
    points += [("a", 1000 + n, START) for n in range(50)]
    spans = []
    for n in range(60):
        start = at(rng.randint(-10**6, 10**7))
        spans.append((rng.choice(["a", "b", "c"]), n, start, start + dt.timedelta(seconds=rng.choice(lengths)) if n % 9 else None))
    spans += [("a", 100, START, START + dt.timedelta(microseconds=1)), ("a", 101, START + dt.timedelta(days=1), START)]
    table = spark.createDataFrame(points, "vehicle string, row int, ts timestamp_ntz")
    intervals = spark.createDataFrame(spans, "vehicle string, span int, low timestamp_ntz, high timestamp_ntz")
    found = interval_join(table, "ts", intervals, "low", "high")
    expected = [(r, s) for v, r, t in points for w, s, low, high in spans if v == w and t and low and high and low <= t < high]
    assert rows(found.select("row", "span")) == sorted(expected, key=lambda p: tuple((False, str(x)) for x in p))
    assert interval_join(table, "ts", intervals.where("false"), "low", "high").count() == 0
    assert "CartesianProduct" not in plan(found) and "NestedLoop" not in plan(found)


def readings(n=400, seed=5):
    rng = random.Random(seed)
    found = [(rng.choice(["a", None]), START + dt.timedelta(minutes=rng.randint(0, 4000)), round(rng.uniform(-5, 5), 3)) for _ in range(n)]
    return found + [("a", START, 1.0), ("a", START, -1.0), ("a", None, 3.0), ("a", START, None)]


SCHEMA = "vehicle string, ts timestamp_ntz, value double"


def test_states_merge_in_any_order_and_cut(spark):
    given = readings()
    whole = rows(hour_states(spark.createDataFrame(given, SCHEMA), "ts", "value"))
    rng = random.Random(6)
    for cuts in (2, 5):
        rng.shuffle(given)
        parts = [hour_states(spark.createDataFrame(given[n::cuts], SCHEMA), "ts", "value") for n in range(cuts)]
        assert rows(merged(parts)) == whole
    nested = merged([merged(parts[:2]), merged(parts[2:])])
    assert rows(nested) == whole
    figures = hour_figures(nested).where("vehicle = 'a'").orderBy("sampleHour").first()
    own = [v for c, t, v in given if c == "a" and t and v is not None and t < START + dt.timedelta(hours=1)]
    assert figures.n == len(own) and figures.total == pytest.approx(sum(own)) and figures.mean_value == pytest.approx(sum(own) / len(own))


def test_records_are_taken_back_and_only_open_hours_made_anew(spark):
    given = readings()
    gone, late = given[:60], [("b", START + dt.timedelta(minutes=5), 9.0), ("a", START + dt.timedelta(minutes=1), 2.0)]
    kept = spark.createDataFrame(given[60:] + late, SCHEMA)
    state = hour_states(spark.createDataFrame(given, SCHEMA), "ts", "value")
    removed, added = (hour_states(spark.createDataFrame(part, SCHEMA), "ts", "value") for part in (gone, late))
    asked = []

    def again(hours):
        asked.extend(hours.collect())
        chosen = kept.withColumn("sampleHour", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
        same = [F.col("c.vehicle").eqNullSafe(F.col("h.vehicle")), F.col("c.sampleHour") == F.col("h.sampleHour")]
        return hour_states(chosen.alias("c").join(hours.alias("h"), same, "left_semi").drop("sampleHour"), "ts", "value")

    assert rows(updated(state, added, removed, again)) == rows(hour_states(kept, "ts", "value"))
    left = taken_back(state, removed)
    assert 0 < len(asked) == left.where("open").count() < left.count()
    ends = {(r.vehicle, r.day): (r.first_value, r.last_value, r.n) for r in day_ends(state).collect()}
    own = sorted((t, v) for c, t, v in given if c == "a" and t and v is not None and t.date() == START.date())
    assert ends["a", START.date()] == (own[0][1], own[-1][1], len(own))


def test_a_record_that_moves_to_another_day_counts_once(spark, tmp_path):
    schema = "id int, ts timestamp_ntz, value double, pos int"

    def build(records):
        return records.groupBy("day").agg(F.sum("value").alias("total"), F.count("*").alias("n"))

    store = RecordStore(spark, f"{tmp_path}/store", "ts", ["id"], ["pos"], [Table("daily", ["records"], build, [])])

    def put(number, *records):
        spark.createDataFrame([(i, dt.datetime.fromisoformat(t) if t else None, v, p) for i, t, v, p in records], schema).coalesce(1).write.parquet(f"{tmp_path}/in/{number}")
        store.follow(spark.readStream.schema(schema).parquet(f"{tmp_path}/in/*"))
        return rows(store.read("daily"))

    def day(n, total, count):
        return (dt.date(2026, 7, n), total, count)

    assert put(0, (1, "2026-07-03 10:00", 1.0, 0), (2, "2026-07-03 11:00", 2.0, 0), (3, None, 9.0, 0)) == [day(3, 3.0, 2)]
    assert put(1, (1, "2026-07-04 10:00", 5.0, 0)) == [day(3, 2.0, 1), day(4, 5.0, 1)]
    # The last record of a day leaves it: the day is gone.
    assert put(2, (2, "2026-07-04 00:00", 2.0, 0)) == [day(4, 7.0, 2)]
    # Two copies in one file: the later place counts; and a return to a former day.
    assert put(3, (1, "2026-07-05 10:00", 6.0, 1), (1, "2026-07-03 10:00", 8.0, 2)) == [day(3, 8.0, 1), day(4, 2.0, 1)]
    assert sorted(r.id for r in store.read().collect()) == [1, 2]


def test_files_are_in_one_order(spark, tmp_path):
    table = spark.range(20000).select((F.col("id") % 3).alias("hot"), F.xxhash64("id").alias("key"), "id").repartition(7)
    write_ordered(table, f"{tmp_path}/out", ["hot", "key"])
    files = sorted({r.f for r in spark.read.parquet(f"{tmp_path}/out").select(F.col("_metadata.file_path").alias("f")).distinct().collect()})
    found = [tuple(r) for f in files for r in spark.read.parquet(f).select("hot", "key").collect()]
    assert found == sorted(found) and len(found) == 20000


def test_bucketed_tables_join_without_a_shuffle(spark, sf_dir, tmp_path):
    sides = [spark.range(500).select((F.col("id") % 7).alias("vehicle"), "id", F.rand(n).alias(f"v{n}")) for n in range(2)]
    name = f"t{uuid.uuid4().hex}"
    stored = [write_bucketed(side, f"{tmp_path}/{n}", f"{name}_{n}", ["vehicle", "id"], 4) for n, side in enumerate(sides)]
    joined = stored[0].join(stored[1].hint("merge"), ["vehicle", "id"])
    assert "Exchange" not in plan(joined) and joined.count() == 500
    assert plan(bindings.q_bucketed_join(spark, sf_dir)).count("Exchange") == 0
