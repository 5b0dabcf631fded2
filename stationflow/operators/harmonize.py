"""Both file generations as one trip table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.functions.numeric import truncate_to_int
from stationflow.sources.eras import ERA_1, ERA_2, TRIP_COLUMNS, Era

STATION_IDS = ("start_station_id", "end_station_id")


def harmonize(df: DataFrame, era: Era, *extra: str) -> DataFrame:
    """One projection from an era's columns to the trip columns, in their order.

    Station ids lose their fraction, so 5177.06 and 5177.6 become one station. ``extra`` columns of
    the scan (its file path) ride along.
    """
    columns = {name: F.col(f"`{source}`") for name, source in era.source_of.items()}
    for name in STATION_IDS:
        columns[name] = truncate_to_int(columns[name])
    columns["member"] = era.member()
    return df.select(*[columns[name].alias(name) for name in TRIP_COLUMNS], *extra)


def with_file_path(scan: DataFrame) -> DataFrame:
    """Source file of each row, taken from the scan itself before anything is joined to it."""
    return scan.select("*", F.col("_metadata.file_path").alias("file_path"))


def with_row_number(df: DataFrame) -> DataFrame:
    """Unique, not dense row id. It follows the scan's splits, so it is final only once written."""
    return df.withColumn("row_number", F.monotonically_increasing_id())


def combine_eras(era_1: DataFrame, era_2: DataFrame) -> DataFrame:
    """Scans of both eras as one table with lineage; no row is moved between tasks."""
    trips = harmonize(with_file_path(era_1), ERA_1, "file_path").unionByName(
        harmonize(with_file_path(era_2), ERA_2, "file_path")
    )
    return with_row_number(trips).select(*TRIP_COLUMNS, "row_number", "file_path")
