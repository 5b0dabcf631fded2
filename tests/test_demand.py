"""Hourly demand: exact small results, NULL keys, and one-shuffle against outer join."""

from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from stationflow.operators import demand
from stationflow.operators.stations import with_coordinates
from stationflow.plans.medallion import silver_rows
from tests.conftest import rows

TRIPS = "start_time timestamp, end_time timestamp, row_number long, start_station_id int, end_station_id int"


def at(hour, minute=0, day=19):
    return datetime(2024, 6, day, hour, minute)


def outer(trips):
    return demand.merge_counts(
        demand.hourly_counts(demand.departures(trips)), demand.hourly_counts(demand.arrivals(trips))
    )


def test_legs(spark):
    trips = spark.createDataFrame([(at(1), at(2), 5, 10, 20)], TRIPS)
    assert rows(demand.departures(trips)) == [(5, at(1), 10)]
    assert rows(demand.arrivals(trips)) == [(5, at(2), 20)]
    assert rows(demand.trip_legs(trips)) == [(5, at(1), 10, True), (5, at(2), 20, False)]


def test_hourly_counts(spark):
    legs = spark.createDataFrame(
        [(91, at(5, 59), 3), (92, at(6), 3), (93, at(6, 30), 3), (94, at(6, 59), 4), (95, at(6, 0, 2), 3), (96, at(6, 31), 3)],
        "row_number long, time timestamp, station_id int",
    )
    assert rows(demand.hourly_counts(legs)) == sorted(
        [(3, at(5), 1), (3, at(6), 3), (4, at(6), 1), (3, at(6, 0, 2), 1)], key=repr
    )


def test_merge_counts(spark):
    schema = "station_id int, time timestamp, count int"
    left = spark.createDataFrame([(8, at(1), 7), (8, at(2), 5), (9, at(1), 1)], schema)
    right = spark.createDataFrame([(8, at(2), 6), (8, at(3), 2)], schema)
    got = {(r.station_id, r.time.hour): (r.bike_demand, r.dock_demand) for r in demand.merge_counts(left, right).collect()}
    assert got == {(8, 1): (7, 0), (8, 2): (5, 6), (8, 3): (0, 2), (9, 1): (1, 0)}


def test_null_keys_stay_apart_by_side(spark):
    trips = spark.createDataFrame([(None, None, 1, 1, 1), (at(1), at(1), 2, None, None)], TRIPS)
    expected = sorted([(1, None, 1, 0), (1, None, 0, 1), (0, at(1), 1, 0), (0, at(1), 0, 1)], key=repr)
    assert rows(demand.hourly_demand(trips)) == expected
    assert rows(outer(trips)) == expected


times = st.one_of(st.none(), st.builds(at, st.integers(0, 2), st.integers(0, 59)))
ids = st.one_of(st.none(), st.integers(0, 2))
numbers = st.one_of(st.none(), st.integers(0, 99))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(times, times, numbers, ids, ids), max_size=25))
def test_one_shuffle_equals_outer_join(spark, data):
    trips = spark.createDataFrame(data, TRIPS)
    assert rows(demand.hourly_demand(trips)) == rows(outer(trips), "station_id", "time", "bike_demand", "dock_demand")


def test_demand_shuffles_once(spark, sf_dir):
    from stationflow.sources import testbed

    plan = demand.hourly_demand(testbed.bronze(spark, sf_dir))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "Join" not in plan


def test_unknown_station_keeps_its_demand(spark):
    table = spark.createDataFrame([(1, "A", 1.0, 2.0)], "id int, name string, latitude float, longitude float")
    counts = spark.createDataFrame([(1, 5), (2, 6)], "station_id int, bike_demand long")
    assert rows(with_coordinates(counts, table)) == [(5, 1.0, 2.0), (6, None, None)]
    assert "station_id" in with_coordinates(counts, table, keep_keys=True).columns


@pytest.mark.parametrize("keep", [False, True])
def test_silver_columns(spark, keep):
    trips = spark.createDataFrame([(at(1), None, 1, 1, 1)], TRIPS)
    table = spark.createDataFrame([(1, "A", 1.0, 2.0)], "id int, name string, latitude float, longitude float")
    silver = silver_rows(trips, table, keep_keys=keep)
    expected = {
        "bike_demand", "dock_demand", "latitude", "longitude", "year", "month", "dayofmonth",
        "weekday", "weekofyear", "dayofyear", "hour", "is_holiday",
    }
    assert set(silver.columns) == expected | ({"station_id", "time"} if keep else set())
    assert {r.is_holiday for r in silver.filter("year IS NULL").collect()} == {False}
