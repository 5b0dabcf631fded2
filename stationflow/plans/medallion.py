"""The layer jobs: trip files -> raw -> bronze and stations -> silver -> gold.

Each ``*_rows`` function is the plan of a layer; each job reads stored layers, writes the next and
returns nothing. A job can be run again after a failure: what it writes becomes a layer's current version when it is complete,
and until then readers have the version before it.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.functions.calendar import is_holiday, with_calendar_parts
from stationflow.functions.cyclic import encode_cycles
from stationflow.operators.demand import hourly_demand
from stationflow.operators.features import fit_features, gold_rows, null_counts
from stationflow.operators.harmonize import combine_eras
from stationflow.operators.stations import station_dimension, station_observations, station_points, with_coordinates
from stationflow.operators.training import in_bounded_partitions, keyed_split, random_split
from stationflow.operators.trips import drop_without_station, parse_trip_times, trip_fact, with_file_name
from stationflow.session import run_together
from stationflow.sources.eras import scan_both_eras
from stationflow.sources.tables import DEFAULT_FORMAT, commit_layer, layer_version, read_layer, read_table, version_path, write_layer, write_table


@dataclass(frozen=True)
class LakePaths:
    """Where the files, layers and models live, all below one shared root."""

    root: str
    fmt: str = DEFAULT_FORMAT

    def csv(self, era: str) -> str:
        return f"{self.root}/csv/{era}"

    def layer(self, name: str) -> str:
        return f"{self.root}/layers/{name}"

    def features(self, version: str) -> str:
        return f"{self.root}/models/features/{version}"

    def gold(self, version: str) -> str:
        return version_path(self.layer("gold"), version)


def silver_rows(
    bronze: DataFrame, stations: DataFrame, keep_keys: bool = False, observed: bool = False
) -> DataFrame:
    """Hourly demand with coordinates, calendar parts and the holiday flag.

    Station id and time are dropped unless ``keep_keys``.
    """
    located = with_coordinates(hourly_demand(bronze), stations, keep_keys)
    parts = with_calendar_parts(located, keep_time=keep_keys)
    return parts.withColumn("is_holiday", is_holiday(observed))


def clean_trips(raw: DataFrame, preserve_time: bool = False) -> DataFrame:
    """Raw trips with parsed times, without trips that lack a station."""
    return drop_without_station(parse_trip_times(with_file_name(raw), preserve_time))


def ingest(spark: SparkSession, lake: LakePaths, recursive: bool = False) -> None:
    """Trip files of both eras to the raw table; no shuffle."""
    era_1, era_2 = scan_both_eras(spark, lake.csv("era_1"), lake.csv("era_2"), recursive)
    write_layer(combine_eras(era_1, era_2), lake.layer("raw"), lake.fmt)


def refine_to_bronze(
    spark: SparkSession, lake: LakePaths, preserve_time: bool = False, representative: str = "independent"
) -> None:
    """Raw to the trip fact (no shuffle), the station dimension (one small shuffle) and its names.

    The two outputs use nearly disjoint columns, so each prunes its own scan, nothing is cached, and both are written at once.
    """
    trips = clean_trips(read_layer(spark, lake.layer("raw"), lake.fmt), preserve_time)

    def write_stations() -> None:
        write_layer(station_dimension(station_observations(trips), representative), lake.layer("station"), lake.fmt)
        write_layer(station_points(read_layer(spark, lake.layer("station"), lake.fmt)), lake.layer("station_point"), lake.fmt)

    run_together(spark, lambda: write_layer(trip_fact(trips), lake.layer("bronze"), lake.fmt), write_stations)


def refine_to_silver(
    spark: SparkSession,
    lake: LakePaths,
    keep_keys: bool = False,
    observed: bool = False,
    partition_by_year: bool = False,
    unreadable: str = "keep",
) -> DataFrame:
    """Bronze and stations to silver: one shuffle on (station, hour). Returns the NULL counts of silver.

    A trip whose time could not be read has no calendar features, and gold refuses such rows.
    ``unreadable="reject"`` writes the trips to the ``rejects`` layer and leaves them out of silver.
    ``partition_by_year`` adds a rebalance, so that each year gets files of an even size, not one file
    per task and year.
    """
    if unreadable not in ("keep", "reject"):
        raise ValueError(f"unreadable must be 'keep' or 'reject', not {unreadable!r}")
    bronze = read_layer(spark, lake.layer("bronze"), lake.fmt)
    stations = read_layer(spark, lake.layer("station"), lake.fmt)
    if unreadable == "reject":
        readable = F.col("start_time").isNotNull() & F.col("end_time").isNotNull()
        write_layer(bronze.filter(~readable), lake.layer("rejects"), lake.fmt)
        bronze = bronze.filter(readable)
    silver = silver_rows(bronze, stations, keep_keys, observed)
    if partition_by_year:
        write_layer(silver.hint("rebalance", "year"), lake.layer("silver"), lake.fmt, ["year"])
    else:
        write_layer(silver, lake.layer("silver"), lake.fmt)
    return null_counts(read_layer(spark, lake.layer("silver"), lake.fmt))


MONTH_KEYS = ("file_year", "file_month")


def refine_months_to_silver(
    spark: SparkSession, lake: LakePaths, months: Sequence[str] | None = None, keep_keys: bool = False, observed: bool = False
) -> None:
    """Bring the monthly silver up to date: only the given months ('2021-08') are worked out and written anew.

    Monthly silver is a table partitioned by the month of its hours, overwritten partition by partition. A month's trips are those
    that begin or end in it, a filter that reaches the scan of bronze; a trip over midnight of the last day counts in both
    months, each leg in its own. Without ``months`` all are written. Stations are read anew, but other months keep the
    coordinates they were written with. Trips without a readable time belong to no month and are left out.
    """
    bronze = read_layer(spark, lake.layer("bronze"), lake.fmt)
    stations = read_layer(spark, lake.layer("station"), lake.fmt)
    if months is not None:
        first = [F.to_timestamp(F.lit(f"{m}-01"), "yyyy-MM-dd") for m in months]
        within = [(F.col(c) >= a) & (F.col(c) < F.add_months(a, 1).cast("timestamp")) for a in first for c in ("start_time", "end_time")]
        bronze = bronze.filter(reduce(Column.__or__, within, F.lit(False)))
    hourly = hourly_demand(bronze).filter(F.col("time").isNotNull()).withColumns(dict(zip(MONTH_KEYS, (F.year("time"), F.month("time")), strict=True)))
    if months is not None:
        hourly = hourly.filter(F.date_format("time", "yyyy-MM").isin(list(months)))
    parts = with_calendar_parts(with_coordinates(hourly, stations, keep_keys), keep_time=keep_keys)
    silver = parts.withColumn("is_holiday", is_holiday(observed)).hint("rebalance", *MONTH_KEYS)
    writer = silver.write.format(lake.fmt).mode("overwrite").partitionBy(*MONTH_KEYS)
    writer.option("partitionOverwriteMode", "dynamic").save(lake.layer("monthly_silver"))


def read_monthly_silver(spark: SparkSession, lake: LakePaths) -> DataFrame:
    """All months of monthly silver, as `read_layer` has silver."""
    return read_table(spark, lake.layer("monthly_silver"), lake.fmt).drop(*MONTH_KEYS)


def refine_to_gold(
    spark: SparkSession, lake: LakePaths, *keys: str, split_keys: Sequence[str] = (), seed: int = 29
) -> str:
    """Silver to feature vectors, stored once by split; returns their version.

    Feature stages and rows are stored under a version of their own, and the version becomes the current one
    last: a job that breaks off leaves the earlier version whole, and models keep the features they were
    trained with. ``split_keys`` splits by a hash of these columns rather than at random.
    """
    version = uuid.uuid4().hex
    encoded = encode_cycles(read_layer(spark, lake.layer("silver"), lake.fmt))
    model = fit_features(encoded)
    model.write().overwrite().save(lake.features(version))
    rows = gold_rows(model, encoded, *dict.fromkeys((*keys, *split_keys)))
    split = keyed_split(rows, split_keys) if split_keys else random_split(in_bounded_partitions(rows), seed=seed)
    write_table(split, lake.gold(version), lake.fmt, partition_by=["split"])
    commit_layer(spark, lake.layer("gold"), version, lake.fmt)
    return version


def gold_version(spark: SparkSession, lake: LakePaths) -> str:
    """Version of the last gold that was completed."""
    return layer_version(spark, lake.layer("gold"), lake.fmt)


def read_gold(spark: SparkSession, lake: LakePaths, version: str | None = None) -> DataFrame:
    """Gold rows with their ``split``, of the current version unless another is named."""
    return read_layer(spark, lake.layer("gold"), lake.fmt, version)


def load_features(lake: LakePaths, version: str) -> PipelineModel:
    return PipelineModel.load(lake.features(version))
