"""Each query against its SQL on the given tables."""

import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as entry
from fleetwatt import bindings, oracles
from tests.conftest import plan

QUERIES = bindings.queries()
ORACLES = oracles.ORACLES


@pytest.fixture(scope="module")
def database(sf_dir):
    connection = duckdb.connect()
    for name in bindings.TABLES:
        connection.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return connection


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    if isinstance(value, dt.date) and not isinstance(value, dt.datetime):
        return dt.datetime.combine(value, dt.time()).isoformat()
    return value.isoformat() if isinstance(value, dt.datetime) else repr(value)


def result(names, records):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted(tuple(plain(record[i]) for i in order) for record in records)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, database, name):
    frame = QUERIES[name](spark, sf_dir)
    found = result(frame.columns, [tuple(row) for row in frame.collect()])
    cursor = database.execute(ORACLES[name])
    names = [column[0] for column in cursor.description]
    assert found == result(names, cursor.fetchall())
    assert found[1]


@pytest.mark.parametrize("name", sorted(name for name in QUERIES if "stream" not in name and "restate" not in name))
def test_plan(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "BatchEvalPython", "ArrowEvalPython"):
        assert unwanted not in text


@pytest.mark.parametrize(
    ("name", "scans", "shuffles"), [("q_series_long", 4, 2), ("q_day_summary", 2, 4), ("q_hourly_flows", 4, 1), ("q_flows_of_rows", 1, 1)]
)
def test_scans_and_shuffles(spark, sf_dir, name, scans, shuffles):
    text = plan(QUERIES[name](spark, sf_dir))
    assert (text.count("FileScan"), text.count("Exchange hashpartitioning")) == (scans, shuffles)
    assert "SortAggregate" not in text


def test_all_queries_are_registered():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_port_order_carries_no_path(spark, sf_dir):
    text = plan(QUERIES["q_port_order"](spark, sf_dir))
    assert "xxhash64(_metadata" in text and "AS _file" in text and text.count("FileScan") == 1
