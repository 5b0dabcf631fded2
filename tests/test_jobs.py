"""The layer jobs from CSV files on, and the query catalog against its SQL."""

from datetime import datetime
from functools import reduce

import pyarrow.parquet as pq
import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.__main__ import main as command_line
from stationflow.operators import demand
from stationflow.plans import medallion
from stationflow.plans.catalog import QUERIES, TRIP_FILE_OPTIONS
from stationflow.plans.oracles import ORACLES
from stationflow.session import build_session, fresh_path, sees_skew, shared_folder
from stationflow.sources import testbed
from stationflow.sources.tables import layer_version, read_layer, read_table, write_layer, write_table
from stationflow.streaming.demand import stream_hourly_demand, streamed_hourly_demand
from tests.check_oracles import compare, duck
from tests.conftest import rows

ERA_1_FILE = """h,h,h,h,h,h,h,h,h,h,h,h,h,h,h
60,1/1/2015 0:01,1/1/2015 0:09,10,Ten,40.1,-73.1,20,Twenty,40.2,-73.2,1,Subscriber,1980,1
60,1/1/2015 1:01,1/1/2015 1:09,20,Twenty,40.2,-73.2,10,Ten,40.1,-73.1,1,Customer,1980,1
"""
ERA_2_FILE = """h,h,h,h,h,h,h,h,h,h,h,h,h
a,b,2021-07-10 05:06:07.1,2021-08-10 05:30:00.2,Ten,10.5,Thirty,30.25,40.1,-73.1,40.3,-73.3,member
c,b,2021-08-10 05:06:07.1,2021-08-10 05:30:00.2,Ten,SYS1,Thirty,30.25,40.1,-73.1,40.3,-73.3,casual
"""


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    for era, name, text in (("era_1", "201501-trips.csv", ERA_1_FILE), ("era_2", "202108-trips.csv", ERA_2_FILE)):
        folder = root / "csv" / era
        folder.mkdir(parents=True)
        (folder / name).write_text(text)
    lake = medallion.LakePaths(str(root))
    medallion.ingest(spark, lake)
    medallion.refine_to_bronze(spark, lake)
    medallion.refine_to_silver(spark, lake, keep_keys=True)
    return lake


def test_ingested(spark, lake):
    raw = read_layer(spark, lake.layer("raw"))
    assert raw.count() == 4 and raw.columns[-2:] == ["row_number", "file_path"]


def test_bronze(spark, lake):
    got = sorted(str(r.start_time) for r in read_layer(spark, lake.layer("bronze")).collect())
    assert got == ["2015-01-01 00:01:00", "2015-01-01 01:01:00", "2021-08-10 00:00:00"]
    stations = {r.id: r.name for r in read_layer(spark, lake.layer("station")).collect()}
    assert stations == {10: "Ten", 20: "Twenty", 30: "Thirty"}


def test_silver(spark, lake):
    got = {
        (r.station_id, str(r.time)): (r.bike_demand, r.dock_demand)
        for r in read_layer(spark, lake.layer("silver")).collect()
    }
    assert got == {
        (10, "2015-01-01 00:00:00"): (1, 0),
        (20, "2015-01-01 00:00:00"): (0, 1),
        (20, "2015-01-01 01:00:00"): (1, 0),
        (10, "2015-01-01 01:00:00"): (0, 1),
        (10, "2021-08-10 00:00:00"): (1, 0),
        (30, "2021-08-10 05:00:00"): (0, 1),
    }


def test_silver_by_year(spark, lake):
    medallion.refine_to_silver(spark, lake, partition_by_year=True)
    plan = read_layer(spark, lake.layer("silver")).filter("year = 2015")
    assert plan.count() == 4 and len(plan.inputFiles()) > 0


def test_shared_folder_is_the_sessions(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert fresh_path(spark, "x") != fresh_path(spark, "x")
    assert fresh_path(spark, "x").startswith(shared_folder(spark))


def test_every_sql_has_its_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    assert compare(QUERIES[name](spark, sf_dir), duck(sf_dir), ORACLES[name]) is None


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


@pytest.mark.parametrize("name", ["station_enriched", "station_lookup", "forecast_grid", "job_bronze"])
def test_joins_beyond_the_broadcast_threshold(spark, sf_dir, no_broadcast, name):
    df = QUERIES[name](spark, sf_dir)
    assert "SortMergeJoin" in df._jdf.queryExecution().executedPlan().toString()
    assert compare(df, duck(sf_dir), ORACLES[name]) is None


def test_command_line(spark, tmp_path):
    root = tmp_path / "lake"
    for era, name, text in (("era_1", "201501-trips.csv", ERA_1_FILE), ("era_2", "202108-trips.csv", ERA_2_FILE)):
        folder = root / "csv" / era
        folder.mkdir(parents=True)
        (folder / name).write_text(text)
    for job in ("ingest", "bronze", "silver", "gold"):
        command_line(["--root", str(root), job, "--keep-keys", "--preserve-time", "--unreadable", "reject"], spark)
    gold = medallion.read_gold(spark, medallion.LakePaths(str(root)))
    assert gold.columns == ["station_id", "time", "final_features", "bike_demand", "dock_demand", "split"]
    assert gold.count() == 6


def test_a_running_session_keeps_its_settings(spark):
    before = {key: spark.conf.get(key, None) for key in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.initialPartitionNum")}
    assert build_session("other", shuffle_gb=1000, **{"spark.sql.shuffle.partitions": "77"}) is spark
    assert {key: spark.conf.get(key, None) for key in before} == before


def test_sessions_that_hide_hot_keys_are_told(spark):
    assert sees_skew(spark)
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        assert not sees_skew(spark)
        with pytest.warns(UserWarning, match="hot keys"):
            build_session("other")
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")


def test_a_broken_write_leaves_the_layer_as_it_was(spark):
    layer = fresh_path(spark, "layer")
    first = write_layer(spark.range(5), layer)
    broken = spark.range(0, 100, 1, 4).select(F.when(F.col("id") == 99, F.raise_error(F.lit("killed"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="killed"):
        write_layer(broken, layer)
    assert layer_version(spark, layer) == first and read_layer(spark, layer).count() == 5
    second = write_layer(spark.range(7), layer)
    assert layer_version(spark, layer) == second and read_layer(spark, layer).count() == 7
    assert read_layer(spark, layer, version=first).count() == 5
    with pytest.raises(LookupError):
        read_layer(spark, fresh_path(spark, "nothing"))


def test_a_job_that_breaks_off_leaves_every_layer_readable(spark, lake, monkeypatch):
    layers = ("bronze", "station", "station_point", "silver")
    before = {n: sorted(map(str, read_layer(spark, lake.layer(n)).collect())) for n in layers}
    monkeypatch.setattr(medallion, "trip_fact", lambda trips: trips.select(F.raise_error(F.lit("killed")).cast("long").alias("row_number")))
    monkeypatch.setattr(medallion, "station_dimension", lambda seen, how: seen.select(F.raise_error(F.lit("killed")).cast("int").alias("id")))
    monkeypatch.setattr(medallion, "silver_rows", lambda *args: spark.range(1).select(F.raise_error(F.lit("killed")).cast("int").alias("year")))
    for job in (medallion.refine_to_bronze, medallion.refine_to_silver):
        with pytest.raises(Exception, match="killed"):
            job(spark, lake)
    assert {n: sorted(map(str, read_layer(spark, lake.layer(n)).collect())) for n in layers} == before


def test_a_new_month_rewrites_its_folder_only(spark, tmp_path):
    lake = medallion.LakePaths(str(tmp_path))
    day = lambda text: F.to_timestamp(F.lit(text))

    def trips(*rows):
        parts = [spark.range(1).select(day(a).alias("start_time"), day(b).alias("end_time"), F.lit(1).alias("start_station_id"), F.lit(2).alias("end_station_id"), F.lit(i).cast("long").alias("row_number")) for i, (a, b) in enumerate(rows)]
        return reduce(DataFrame.unionByName, parts)

    old = [("2021-07-05 10:00:00", "2021-07-05 10:20:00"), ("2021-07-31 23:50:00", "2021-08-01 00:10:00")]
    new = [*old, ("2021-08-03 09:00:00", "2021-08-03 09:05:00")]
    write_layer(spark.createDataFrame([(1, "One", 1.0, 2.0), (2, "Two", 3.0, 4.0)], "id int, name string, latitude float, longitude float"), lake.layer("station"))
    write_layer(trips(*old), lake.layer("bronze"))
    medallion.refine_months_to_silver(spark, lake, keep_keys=True)
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "layers/monthly_silver").rglob("*.parquet")}
    july = [p for p in files if "file_month=7" in str(p)]
    write_layer(trips(*new), lake.layer("bronze"))
    medallion.refine_months_to_silver(spark, lake, ["2021-08"], keep_keys=True)
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "layers/monthly_silver").rglob("*.parquet")}
    assert july and all(after.get(p) == files[p] for p in july)
    whole = medallion.silver_rows(read_layer(spark, lake.layer("bronze")), read_layer(spark, lake.layer("station")), keep_keys=True)
    monthly = medallion.read_monthly_silver(spark, lake).select(*whole.columns)
    assert sorted(map(str, monthly.collect())) == sorted(map(str, whole.collect())) and monthly.count() == 6


def test_a_stream_goes_on_where_it_stopped(spark, tmp_path):
    rows = testbed.bronze(spark, "/root/testdata/sf0.001", gaps=True).filter("start_time is not null and end_time is not null").cache()
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    wanted = demand.hourly_demand(rows)
    for third in range(3):  # hours get more trips with every run
        rows.filter(F.col("row_number") % 3 == third).repartition(2).write.mode("append").parquet(source)
        stream_hourly_demand(spark, source, rows.schema, out, checkpoint, "6000 days", 1).awaitTermination()
    stream_hourly_demand(spark, source, rows.schema, out, checkpoint, "6000 days").awaitTermination()  # nothing new
    found = streamed_hourly_demand(spark, out)
    assert sorted(map(str, found.collect())) == sorted(map(str, wanted.collect()))
    # A batch that is run again replaces what it wrote.
    last = max(int(p.name.partition("=")[2]) for p in (tmp_path / "out").iterdir())
    batch = read_table(spark, f"{out}/batch={last}").collect()
    spark.createDataFrame(batch, read_table(spark, f"{out}/batch={last}").schema).write.mode("overwrite").parquet(f"{out}/batch={last}")
    assert streamed_hourly_demand(spark, out).count() == wanted.count()
    rows.unpersist()


def test_the_last_batch_of_an_hour_is_found_without_a_sort(spark, tmp_path):
    schema = "station_id int, time timestamp, unmatched_side boolean, bike_demand long, dock_demand long, batch long"
    hour = datetime(2024, 5, 1, 8)
    batches = {0: [(0, None, 1, 0), (0, True, 4, 0), (7, None, 2, 5)], 1: [(7, None, 3, 5)], 10: [(0, True, 6, 0), (7, None, 3, 9)]}
    for batch, hours in batches.items():
        written = [(station, hour, side, bikes, docks, batch) for station, side, bikes, docks in hours]
        spark.createDataFrame(written, schema).write.parquet(str(tmp_path / f"batch={batch}"))
    found = streamed_hourly_demand(spark, str(tmp_path))
    assert rows(found) == [(0, hour, 1, 0), (0, hour, 6, 0), (7, hour, 3, 9)]
    assert found.columns == ["station_id", "time", "bike_demand", "dock_demand"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_several_tasks_can_read_a_trip_file(spark, tmp_path):
    some = spark.range(2_000_000).select(
        F.timestamp_seconds(F.col("id") * 7919 % 100_000_007).alias("start_time"),
        F.timestamp_seconds(F.col("id") * 7907 % 100_000_007).alias("end_time"),
        (F.col("id") % 500).cast("int").alias("start_station_id"),
        (F.col("id") % 499).cast("int").alias("end_station_id"),
        F.col("id").alias("row_number"),
    )
    write_table(some.coalesce(1), str(tmp_path / "trips"), options=TRIP_FILE_OPTIONS)
    (file,) = (tmp_path / "trips").glob("*.parquet")
    groups = pq.ParquetFile(file).metadata
    assert groups.num_rows == 2_000_000 and groups.num_row_groups > 1


def test_testbed_covers_all_formats_and_eras(spark, sf_dir):
    months = testbed.published(testbed.trips(spark, sf_dir)).select("file_name").distinct()
    assert months.filter("file_name LIKE '202108%'").count() == 1
    assert months.count() > 130
