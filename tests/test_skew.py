"""A third of all rows on one key: results stay whole, and the hot key shuffles few rows."""

import pytest
from pyspark.sql import functions as F

from stationflow.operators import demand, stations
from stationflow.operators.stations import lookup_by_name, station_points
from stationflow.session import fresh_path
from stationflow.sources.tables import read_table, write_table

ROWS = 30000


@pytest.fixture(scope="module")
def trips(spark):
    """Every third trip starts and ends at station 1 in the same hour."""
    hot = F.col("id") % 3 == 0
    hour = F.when(hot, 0).otherwise(F.col("id") % 100)
    start = F.timestamp_seconds(F.lit(1700000000) + hour * 3600)
    station = F.when(hot, 1).otherwise(F.col("id") % 50 + 2).cast("int")
    return spark.range(0, ROWS, 1, 8).select(
        start.alias("start_time"),
        start.alias("end_time"),
        station.alias("start_station_id"),
        station.alias("end_station_id"),
        F.col("id").alias("row_number"),
    )


def test_hot_station_is_counted_whole(spark, trips):
    out = demand.hourly_demand(trips)
    assert out.filter("station_id = 1").first().bike_demand == ROWS // 3
    assert out.agg(F.sum("bike_demand")).first()[0] == ROWS


def test_hot_station_is_combined_before_the_shuffle(spark, trips):
    plan = demand.hourly_demand(trips)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange hashpartitioning"):]
    assert "partial_count" in below


def test_stations_hash_before_they_sort(spark, trips):
    """The sort a text minimum needs comes after the rows were hashed down to one per id and name."""
    named = trips.withColumns(
        {
            f"{side}_station_{field}": value
            for side in ("start", "end")
            for field, value in (
                ("name", F.concat(F.lit("S"), F.col(f"{side}_station_id").cast("string"))),
                ("latitude", F.lit(1.0).cast("float")),
                ("longitude", F.lit(2.0).cast("float")),
            )
        }
    )
    dim = stations.station_dimension(stations.station_observations(named))
    plan = dim._jdf.queryExecution().executedPlan().toString()
    assert plan.index("SortAggregate") < plan.index("HashAggregate")
    assert "partial_min" in plan[plan.index("HashAggregate"):]
    assert dim.count() == 51


@pytest.mark.parametrize("partitions", [16, 4096])
def test_a_hot_name_is_split(spark, partitions):
    """Two thirds of the requests ask for one station; without a broadcast AQE deals them to several tasks."""
    names = F.when(F.col("id") % 3 > 0, F.lit("S1")).otherwise(F.concat(F.lit("S"), (F.col("id") % 900).cast("string")))
    padding = F.sha2(F.col("id").cast("string"), 256)
    asked, table = fresh_path(spark, "asked"), fresh_path(spark, "points")
    write_table(spark.range(60_000).repartition(8).select("id", names.alias("station_name"), padding.alias("padding")), asked)
    known = spark.range(900).select(
        F.col("id").cast("int").alias("id"),
        F.concat(F.lit("S"), F.col("id").cast("string")).alias("name"),
        F.lit(1.0).alias("latitude"),
        F.lit(2.0).alias("longitude"),
    )
    write_table(station_points(known), table)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        found = lookup_by_name(read_table(spark, asked), read_table(spark, table))
        assert found.count() == 60_000
        path = fresh_path(spark, "found")
        write_table(found.withColumn("task", F.spark_partition_id()), path)
        tasks = [r.n for r in read_table(spark, path).groupBy("task").agg(F.count("*").alias("n")).collect()]
        assert max(tasks) <= 20_000 and len(tasks) > 3  # the hot name alone has 40,000 rows
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
