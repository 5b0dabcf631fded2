"""The two generations of trip files: declared schemas and how each maps to the common trip columns."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The column order of the harmonised trip table.
TRIP_COLUMNS = (
    "start_time",
    "end_time",
    "start_station_name",
    "start_station_latitude",
    "start_station_longitude",
    "end_station_name",
    "end_station_latitude",
    "end_station_longitude",
    "start_station_id",
    "end_station_id",
    "member",
)


@dataclass(frozen=True)
class Era:
    """One file generation. ``schema`` is positional, as the header text is skipped, not matched."""

    schema: str
    source_of: dict[str, str]
    member: Callable[[], Column]


# The file schemas, and the member flag's asymmetric default for a missing rider type.
ERA_1 = Era(
    schema="""
        tripduration int, starttime string, stoptime string,
        `start station id` float, `start station name` string,
        `start station latitude` float, `start station longitude` float,
        `end station id` float, `end station name` string,
        `end station latitude` float, `end station longitude` float,
        bikeid int, usertype string, `birth year` int, gender int
    """,
    source_of={
        "start_time": "starttime",
        "end_time": "stoptime",
        "start_station_name": "start station name",
        "start_station_latitude": "start station latitude",
        "start_station_longitude": "start station longitude",
        "end_station_name": "end station name",
        "end_station_latitude": "end station latitude",
        "end_station_longitude": "end station longitude",
        "start_station_id": "start station id",
        "end_station_id": "end station id",
    },
    member=lambda: F.coalesce(F.col("usertype") == "Subscriber", F.lit(False)).cast("int"),
)

ERA_2 = Era(
    schema="""
        ride_id string, rideable_type string, started_at string, ended_at string,
        start_station_name string, start_station_id float,
        end_station_name string, end_station_id float,
        start_lat float, start_lng float, end_lat float, end_lng float,
        member_casual string
    """,
    source_of={
        "start_time": "started_at",
        "end_time": "ended_at",
        "start_station_name": "start_station_name",
        "start_station_latitude": "start_lat",
        "start_station_longitude": "start_lng",
        "end_station_name": "end_station_name",
        "end_station_latitude": "end_lat",
        "end_station_longitude": "end_lng",
        "start_station_id": "start_station_id",
        "end_station_id": "end_station_id",
    },
    member=lambda: F.coalesce(F.col("member_casual") != "casual", F.lit(True)).cast("int"),
)


def scan_csv(spark: SparkSession, path: str, era: Era, recursive: bool = False) -> DataFrame:
    """Scan a folder of trip files. A value that does not fit its declared type (an id such as
    ``SYS033``) reads as NULL. ``recursive`` also takes the files of nested folders."""
    return spark.read.csv(
        path, schema=era.schema, header=True, mode="PERMISSIVE", recursiveFileLookup=recursive
    )


def scan_both_eras(spark: SparkSession, era_1_path: str, era_2_path: str, recursive: bool = False):
    """(era 1 rows, era 2 rows), each with its own declared schema."""
    return (
        scan_csv(spark, era_1_path, ERA_1, recursive),
        scan_csv(spark, era_2_path, ERA_2, recursive),
    )
