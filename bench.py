"""Time the headline queries and the job chain; print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS the local cores. Queries run
over stored layers, whole, into the no-op sink, and count as the mean of RUNS after a warm-up; the jobs
run once, each on what the one before it stored. The reference publishes no timings, so two of its plan
shapes run next to ours, outside the total.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import DataFrame

from stationflow.functions.timetext import TIME_FORMATS
from stationflow.operators import demand, trips
from stationflow.operators.evaluation import evaluate
from stationflow.operators.stations import lookup_by_name, station_dimension, station_observations
from stationflow.plans import medallion
from stationflow.plans.forecasting import forecast
from stationflow.plans.training import train_both
from stationflow.session import build_session, fresh_path
from stationflow.sources import testbed
from stationflow.sources.tables import read_layer, write_layer

RUNS = 2
COMPARED = ("parse_trip_times_three_scans", "hourly_demand_outer_join")


def three_scans(raw: DataFrame) -> DataFrame:
    """Time parsing as three filtered slices and a union: three scans of the raw table."""
    named = trips.with_file_name(raw)
    first, *rest = [
        trips.repair_shifted_months(trips.parse_all_as(trips.rows_of_format(named, fmt), fmt))
        for fmt in TIME_FORMATS
    ]
    for part in rest:
        first = first.unionByName(part)
    return trips.trip_fact(trips.drop_without_station(first))


def outer_join(bronze: DataFrame) -> DataFrame:
    return demand.merge_counts(
        demand.hourly_counts(demand.departures(bronze)), demand.hourly_counts(demand.arrivals(bronze))
    )


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    started = time.perf_counter()
    action()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.ui.enabled": "false", "spark.driver.memory": "16g", "spark.sql.shuffle.partitions": cpus},
    )
    spark.sparkContext.setLogLevel("ERROR")
    lake = medallion.LakePaths(fresh_path(spark, "bench"))

    def layer(name: str) -> DataFrame:
        return read_layer(spark, lake.layer(name))

    write_layer(testbed.raw(spark, sf_dir), lake.layer("raw"))
    write_layer(testbed.bronze(spark, sf_dir), lake.layer("typed"))
    write_layer(testbed.requests(spark, sf_dir), lake.layer("requests"))
    medallion.refine_to_bronze(spark, lake)
    raw, typed, stations, requests = layer("raw"), layer("typed"), layer("station"), layer("requests")

    queries = {
        "parse_trip_times": lambda: trips.trip_fact(medallion.clean_trips(raw)),
        "parse_trip_times_three_scans": lambda: three_scans(raw),
        "station_dimension": lambda: station_dimension(station_observations(raw)),
        "hourly_demand": lambda: demand.hourly_demand(typed),
        "hourly_demand_outer_join": lambda: outer_join(typed),
        "silver": lambda: medallion.silver_rows(typed, stations),
        "station_lookup": lambda: lookup_by_name(requests, layer("station_point")),
        "eval_both": lambda: evaluate(demand.hourly_demand(typed), "bike_demand", "dock_demand"),
    }
    taken = {}
    for name, build in queries.items():
        runs = [timed(lambda: run(build())) for _ in range(RUNS + 1)]
        taken[name] = statistics.mean(runs[1:])

    taken["job_bronze"] = timed(lambda: medallion.refine_to_bronze(spark, lake))
    taken["job_silver"] = timed(lambda: medallion.refine_to_silver(spark, lake, unreadable="reject"))
    taken["job_gold"] = timed(lambda: medallion.refine_to_gold(spark, lake))
    taken["train_both_rf"] = timed(lambda: train_both(spark, lake, "random_forest"))
    if os.environ.get("BENCH_BOOSTING"):  # 200 trees one after the other take far longer than all the rest
        taken["train_both_gbt"] = timed(lambda: train_both(spark, lake, "gbt"))
    taken["forecast"] = timed(lambda: run(forecast(spark, lake, requests)))

    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(s for name, s in taken.items() if name not in COMPARED), 3),
                "unit": "sec",
                "queries": {name: round(s, 3) for name, s in taken.items()},
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
