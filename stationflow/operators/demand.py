"""Hourly departures ("bike demand") and arrivals ("dock demand") per station."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS = ("station_id", "time")


def _leg(side: str):
    return [
        F.col("row_number"),
        F.col(f"{side}_time").alias("time"),
        F.col(f"{side}_station_id").alias("station_id"),
    ]


def departures(trips: DataFrame) -> DataFrame:
    """Start leg of every trip."""
    return trips.select(*_leg("start"))


def arrivals(trips: DataFrame) -> DataFrame:
    """End leg of every trip."""
    return trips.select(*_leg("end"))


def trip_legs(trips: DataFrame) -> DataFrame:
    """Both legs of every trip, told apart by ``is_start``.

    Each side of the union reads its own columns only, so on a columnar table both sides together read
    what one scan would, without building an array per trip.
    """
    started = departures(trips).withColumn("is_start", F.lit(True))
    return started.unionByName(arrivals(trips).withColumn("is_start", F.lit(False)))


def hourly_counts(legs: DataFrame) -> DataFrame:
    """Legs per station and hour. Counting starts in each task, so a busy station shuffles at most one
    row per hour and task."""
    return legs.groupBy("station_id", F.date_trunc("hour", "time").alias("time")).agg(
        F.count("row_number").alias("count")
    )


def merge_counts(departed: DataFrame, arrived: DataFrame) -> DataFrame:
    """Full outer join of both counts; a side without trips counts 0. So does a missing station id."""
    bikes = departed.select(*KEYS, F.col("count").alias("bike_demand"))
    docks = arrived.select(*KEYS, F.col("count").alias("dock_demand"))
    return bikes.join(docks, list(KEYS), "fullouter").fillna(0)


def hourly_demand(trips: DataFrame) -> DataFrame:
    """``merge_counts`` of both hourly counts, with one shuffle and no join.

    An outer join never matches a NULL key, so such rows stay apart by side; the extra grouping key
    keeps that.
    """
    legs = trip_legs(trips).withColumn("time", F.date_trunc("hour", "time"))
    unmatched_side = F.when(F.col("station_id").isNull() | F.col("time").isNull(), F.col("is_start"))
    return (
        legs.groupBy(*KEYS, unmatched_side.alias("unmatched_side"))
        .agg(
            F.count(F.when(F.col("is_start"), F.col("row_number"))).alias("bike_demand"),
            F.count(F.when(~F.col("is_start"), F.col("row_number"))).alias("dock_demand"),
        )
        .select(F.coalesce("station_id", F.lit(0)).alias("station_id"), "time", "bike_demand", "dock_demand")
    )
