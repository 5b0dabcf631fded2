"""Trip clean-up: time parsing by file and the slim trip fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.functions.timetext import (
    TimeFormat,
    file_name_of,
    parse_time,
    parse_time_by_format,
    repair_shifted_month,
    time_format_of,
)

TIME_COLUMNS = ("start_time", "end_time")
FACT_COLUMNS = ("start_time", "end_time", "start_station_id", "end_station_id", "row_number")


def with_file_name(raw: DataFrame) -> DataFrame:
    return raw.withColumn("file_name", file_name_of(F.col("file_path")))


def with_time_format(raw: DataFrame) -> DataFrame:
    """Add ``time_format``, NULL where the file belongs to no known format."""
    return raw.withColumn("time_format", time_format_of(F.col("file_name")))


def rows_of_format(raw: DataFrame, fmt: TimeFormat) -> DataFrame:
    """The rows whose file carries the given time format."""
    return raw.filter(time_format_of(F.col("file_name")) == fmt.name)


def parse_all_as(raw: DataFrame, fmt: TimeFormat) -> DataFrame:
    """Both time columns read with one format, whatever the file."""
    return raw.withColumns({c: parse_time(F.col(c), fmt) for c in TIME_COLUMNS})


def repair_shifted_months(trips: DataFrame, preserve_time: bool = False) -> DataFrame:
    return trips.withColumns(
        {c: repair_shifted_month(F.col(c), F.col("file_name"), preserve_time) for c in TIME_COLUMNS}
    )


def parse_trip_times(raw: DataFrame, preserve_time: bool = False) -> DataFrame:
    """Text times to timestamps, each row with its own file's format, in one pass over the table.

    Rows of files without a known format are dropped; ``unmatched_files`` counts them.
    """
    known = with_time_format(raw).filter(F.col("time_format").isNotNull())
    parsed = known.withColumns(
        {c: parse_time_by_format(F.col(c), F.col("time_format")) for c in TIME_COLUMNS}
    )
    return repair_shifted_months(parsed.drop("time_format"), preserve_time)


def unmatched_files(raw: DataFrame) -> DataFrame:
    """Rows per file that ``parse_trip_times`` drops."""
    return (
        with_time_format(raw)
        .filter(F.col("time_format").isNull())
        .groupBy("file_name")
        .agg(F.count(F.lit(1)).alias("dropped_rows"))
    )


def drop_without_station(trips: DataFrame) -> DataFrame:
    """Trips that know both of their stations. Plain NOT NULL tests, as those reach the file scan."""
    return trips.filter(F.col("start_station_id").isNotNull() & F.col("end_station_id").isNotNull())


def trip_fact(trips: DataFrame) -> DataFrame:
    return trips.select(*FACT_COLUMNS)
