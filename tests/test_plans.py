"""What the plans must keep on a cluster: pruned scans, pushed filters, few shuffles, no Python."""

import pytest

from stationflow.operators import demand, stations, trips
from stationflow.plans import medallion
from stationflow.plans.catalog import QUERIES
from stationflow.session import fresh_path
from stationflow.sources import testbed
from stationflow.sources.tables import read_layer, write_layer


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def lake(spark, sf_dir):
    lake = medallion.LakePaths(fresh_path(spark, "plans"))
    write_layer(testbed.raw(spark, sf_dir), lake.layer("raw"))
    medallion.refine_to_bronze(spark, lake)
    return lake


def test_trip_fact_is_one_scan_without_shuffle(spark, lake):
    raw = read_layer(spark, lake.layer("raw"))
    plan = plan_of(trips.trip_fact(medallion.clean_trips(raw)))
    assert plan.count("FileScan") == 1 and "Exchange" not in plan
    assert "IsNotNull(start_station_id)" in plan and "IsNotNull(end_station_id)" in plan
    assert "station_name" not in plan and "latitude" not in plan


def test_station_dimension_does_not_parse_times(spark, lake):
    cleaned = medallion.clean_trips(read_layer(spark, lake.layer("raw")))
    plan = plan_of(stations.station_dimension(stations.station_observations(cleaned)))
    assert "start_time" not in plan and plan.count("FileScan") == 1


def test_silver_broadcasts_small_stations_and_shuffles_once(spark, lake):
    silver = medallion.silver_rows(read_layer(spark, lake.layer("bronze")), read_layer(spark, lake.layer("station")))
    plan = plan_of(silver)
    assert plan.count("Exchange hashpartitioning") == 1 and "BroadcastHashJoin" in plan
    assert "name#" not in plan  # the station's name is not read


def test_each_side_of_the_demand_reads_its_own_columns(spark, lake):
    plan = plan_of(demand.hourly_demand(read_layer(spark, lake.layer("bronze"))))
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) == 2
    assert not any("start_time" in s and "end_time" in s for s in scans)


@pytest.mark.parametrize(
    "name", ["parse_trip_times", "hourly_demand", "station_enriched", "forecast_grid_calendar", "cyclic_encode", "eval_both"]
)
def test_no_python_in_plan(spark, sf_dir, name):
    from stationflow.plans.catalog import QUERIES

    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert "Python" not in plan and "Pandas" not in plan and "CartesianProduct" not in plan


def test_silver_of_the_features_is_worked_out_once(spark, sf_dir):
    assert "Exchange" not in plan_of(QUERIES["feature_model_roundtrip"](spark, sf_dir))
