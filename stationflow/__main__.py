"""Run one job, for spark-submit or ``python -m stationflow <job> --root <shared folder>``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from stationflow.operators.forecast import TIME_TEXT
from stationflow.operators.training import DEFAULT_SETTINGS, FAMILIES, TreeSettings
from stationflow.operators.trips import unmatched_files, with_file_name
from stationflow.plans import forecasting, medallion, training
from stationflow.session import build_session
from stationflow.sources.tables import DEFAULT_FORMAT, read_layer, read_table, write_layer

JOBS = ("ingest", "bronze", "silver", "gold", "train", "forecast")


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="stationflow", description=__doc__)
    parser.add_argument("job", choices=JOBS)
    parser.add_argument("--root", required=True, help="folder of the csv, layers and models")
    parser.add_argument("--format", default=DEFAULT_FORMAT, help="table format of the layers")
    parser.add_argument("--family", default="random_forest", choices=sorted(FAMILIES))
    parser.add_argument("--shuffle-gb", type=float, help="expected size of the largest shuffle")
    parser.add_argument("--preserve-time", action="store_true", help="keep the time of day of moved months")
    parser.add_argument("--representative", default="independent", choices=("independent", "row"))
    parser.add_argument("--keep-keys", action="store_true", help="keep station id and time through gold")
    parser.add_argument("--observed", action="store_true", help="mark observed weekdays of fixed holidays")
    parser.add_argument("--recursive", action="store_true", help="read trip files of subfolders too")
    parser.add_argument("--unreadable", default="keep", choices=("keep", "reject"), help="trips whose time can't be read")
    parser.add_argument("--partition-by-year", action="store_true")
    parser.add_argument("--split-keys", nargs="*", default=(), help="split by a hash of these columns; needs --keep-keys")
    parser.add_argument("--num-trees", type=int, default=DEFAULT_SETTINGS.num_trees)
    parser.add_argument("--max-depth", type=int, default=DEFAULT_SETTINGS.max_depth)
    parser.add_argument("--seed", type=int, default=DEFAULT_SETTINGS.seed)
    parser.add_argument("--start", help="first hour of a forecast for all stations, as yyyy-MM-dd HH:mm")
    parser.add_argument("--requests", help="table of requests (station_name, start, is_holiday) to forecast")
    parser.add_argument("--run-id", help="forecast with this run, not the latest")
    parser.add_argument("--holiday", default="flag", choices=("flag", "calendar"))
    return parser.parse_args(argv)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    """Run the job that the arguments name, in this session if one is given."""
    args = parse_args(argv)
    spark = spark or build_session(f"stationflow-{args.job}", shuffle_gb=args.shuffle_gb)
    lake = medallion.LakePaths(args.root.rstrip("/"), args.format)
    keys = ("station_id", "time") if args.keep_keys else ()
    if args.job == "ingest":
        medallion.ingest(spark, lake, args.recursive)
    elif args.job == "bronze":
        medallion.refine_to_bronze(spark, lake, args.preserve_time, args.representative)
        raw = read_layer(spark, lake.layer("raw"), lake.fmt)
        dropped = unmatched_files(with_file_name(raw)).agg(F.count("*").alias("files"), F.sum("dropped_rows").alias("trips")).first()
        print(f"of no known time format: {dropped.files} files, {dropped.trips or 0} trips")
    elif args.job == "silver":
        nulls = medallion.refine_to_silver(
            spark, lake, args.keep_keys, args.observed, args.partition_by_year, args.unreadable
        )
        print(f"missing values by column: {nulls.first().asDict()}")
    elif args.job == "gold":
        medallion.refine_to_gold(spark, lake, *keys, split_keys=args.split_keys, seed=args.seed)
    elif args.job == "train":
        settings = TreeSettings(num_trees=args.num_trees, max_depth=args.max_depth, seed=args.seed)
        training.train_both(spark, lake, args.family, settings)
    else:
        requests = read_table(spark, args.requests, lake.fmt) if args.requests else None
        start = F.to_timestamp(F.lit(args.start), TIME_TEXT) if args.start else None
        result = forecasting.forecast(spark, lake, requests, args.family, args.holiday, start, args.run_id)
        write_layer(result, lake.layer("forecast"), lake.fmt)


if __name__ == "__main__":
    main()
