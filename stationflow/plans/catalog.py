"""Every operator and job as a query over the benchmark tables: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce, wraps

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationflow.functions.calendar import (
    FLOATING_HOLIDAYS,
    is_any_fixed_holiday,
    is_fixed_holiday,
    is_floating_holiday,
    is_holiday,
    is_weekend,
    mark_holiday,
    with_calendar_parts,
)
from stationflow.functions.cyclic import CYCLIC_COLUMNS, encode_cycles
from stationflow.functions.numeric import truncate_to_int
from stationflow.operators import demand, features, forecast, harmonize, stations, training, trees, trips
from stationflow.operators.evaluation import evaluate, r2, rmse
from stationflow.plans import forecasting
from stationflow.plans import training as training_jobs
from stationflow.plans.medallion import (
    LakePaths,
    clean_trips,
    ingest,
    load_features,
    read_gold,
    read_monthly_silver,
    refine_months_to_silver,
    refine_to_bronze,
    refine_to_gold,
    refine_to_silver,
    silver_rows,
)
from stationflow.session import fresh_path
from stationflow.sources import testbed
from stationflow.sources.eras import ERA_1, ERA_2, TRIP_COLUMNS, scan_both_eras, scan_csv
from stationflow.sources.tables import read_layer, read_table, write_layer, write_table
from stationflow.streaming import demand as demand_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Runs of a session that several queries read: lake by application and tables, families trained in it.
_LAKES: dict[tuple[str, str], LakePaths] = {}
_TRAINED: dict[tuple[str, str, str], str] = {}

FEATURE_COUNT = 30

# Trip files that are few and grow with the trips: row groups of 16 MB, so that several tasks read a file, and no dictionaries for
# columns that hardly repeat, as each row group would begin one anew.
TRIP_FILE_OPTIONS = {
    "parquet.block.size": str(16 * 1024 * 1024),
    **{f"parquet.enable.dictionary#{c}": "false" for c in ("start_time", "end_time", "row_number")},
}


def query(fn: Query) -> Query:
    """Register under the function's name. Times go out without zone, as the source tables hold them."""

    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        df = fn(spark, sf_dir)
        return df.select(
            *[
                F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name)
                if isinstance(f.dataType, T.TimestampType)
                else F.col(f"`{f.name}`")
                for f in df.schema.fields
            ]
        )

    QUERIES[fn.__name__] = run
    return run


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Doubles to six places, as two engines may differ in the last bits."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _silver(spark: SparkSession, sf_dir: str, keep_keys: bool = False) -> DataFrame:
    return silver_rows(testbed.bronze(spark, sf_dir), testbed.stations(spark, sf_dir), keep_keys)


def _encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoded silver, stored, as fitting the features and transforming take a pass each."""
    path = fresh_path(spark, "encoded")
    write_table(encode_cycles(_silver(spark, sf_dir)), path)
    return read_table(spark, path)


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "points")
    write_table(stations.station_points(testbed.stations(spark, sf_dir)), path)
    return read_table(spark, path)


def _stored_silver(spark: SparkSession, sf_dir: str, keep_keys: bool = False) -> LakePaths:
    """A new lake with bronze, station and silver layers."""
    lake = LakePaths(fresh_path(spark, "lake"))
    write_layer(testbed.bronze(spark, sf_dir), lake.layer("bronze"))
    write_layer(testbed.stations(spark, sf_dir), lake.layer("station"))
    write_layer(stations.station_points(read_layer(spark, lake.layer("station"))), lake.layer("station_point"))
    refine_to_silver(spark, lake, keep_keys=keep_keys)
    return lake


def _stored_gold(spark: SparkSession, sf_dir: str, keys: tuple[str, ...] = ()) -> LakePaths:
    lake = _stored_silver(spark, sf_dir, keep_keys=bool(keys))
    refine_to_gold(spark, lake, *keys)
    return lake


def _trained(spark: SparkSession, sf_dir: str, family: str = "random_forest") -> tuple[LakePaths, str]:
    """A lake and the id of a run of this family with the production settings; queries of a session share them."""
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _LAKES:
        _LAKES[at] = _stored_gold(spark, sf_dir, keys=("station_id", "time"))
    if (*at, family) not in _TRAINED:
        _TRAINED[*at, family] = training_jobs.train_both(spark, _LAKES[at], family)
    return _LAKES[at], _TRAINED[*at, family]


def _unpacked(df: DataFrame, vector: str, size: int, *kept: str) -> DataFrame:
    """Vector slots as columns f00, f01, ...; only the scaled numbers need rounding, the rest is 0 or 1."""
    with_array = df.select(*kept, vector_to_array(vector).alias("slots"))
    scaled = 0 if vector.startswith("encoded") else len(features.NUMERIC_COLUMNS)
    slots = [F.col("slots")[i] for i in range(size)]
    return with_array.select(
        *kept,
        *[(F.round(s, 6) if i < scaled else s).alias(f"f{i:02d}") for i, s in enumerate(slots)],
    )


# -- scans, sources, sinks ---------------------------------------------------------------------------


def _written_csv(spark: SparkSession, rows: DataFrame, name: str) -> str:
    path = fresh_path(spark, name)
    testbed.write_csv(rows, path)
    return path


def _csv_eras(spark: SparkSession, sf_dir: str, by_month: bool = False) -> tuple[DataFrame, DataFrame]:
    root = fresh_path(spark, "csv")
    testbed.write_csv(testbed.era_1_rows(spark, sf_dir), f"{root}/era_1", by_month)
    testbed.write_csv(testbed.era_2_rows(spark, sf_dir), f"{root}/era_2", by_month)
    return scan_both_eras(spark, f"{root}/era_1", f"{root}/era_2", recursive=by_month)


def _era_1(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _written_csv(spark, testbed.era_1_rows(spark, sf_dir), "era_1")
    return scan_csv(spark, path, ERA_1)


@query
def csv_scan_era1(spark, sf_dir):
    return _era_1(spark, sf_dir)


@query
def csv_scan_two_eras(spark, sf_dir):
    era_1, era_2 = _csv_eras(spark, sf_dir)
    first = era_1.select(
        F.lit(1).alias("era"),
        F.col("starttime").alias("start_text"),
        F.col("`start station id`").alias("station_id"),
        F.col("usertype").alias("rider"),
    )
    second = era_2.select(
        F.lit(2).alias("era"),
        F.col("started_at").alias("start_text"),
        F.col("start_station_id").alias("station_id"),
        F.col("member_casual").alias("rider"),
    )
    return first.unionByName(second)


@query
def table_roundtrip(spark, sf_dir):
    path = fresh_path(spark, "table")
    write_table(testbed.bronze(spark, sf_dir), path)
    return read_table(spark, path)


@query
def source_lineage(spark, sf_dir):
    """Rows per source folder, from the file path each row carries."""
    era_1, era_2 = _csv_eras(spark, sf_dir, by_month=True)
    month = F.regexp_extract("file_path", r"file_month=(\d+)/[^/]+$", 1)
    return (
        harmonize.combine_eras(era_1, era_2)
        .groupBy(month.alias("file_month"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


@query
def surrogate_row_id(spark, sf_dir):
    """Row ids count up from 0 within each task, whose number fills the upper bits; this reports rows
    and the tasks whose ids are not exactly 0, 1, ... n-1."""
    era_1, era_2 = _csv_eras(spark, sf_dir)
    position = F.col("row_number").bitwiseAND(2**33 - 1)
    per_task = (
        harmonize.combine_eras(era_1, era_2)
        .groupBy(F.shiftright("row_number", 33).alias("task"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.max(position).alias("last"),
            F.sum(position).alias("total"),
        )
    )
    gap = (F.col("last") + 1 != F.col("n")) | (F.col("total") * 2 != F.col("n") * (F.col("n") - 1))
    return per_task.agg(
        F.sum("n").alias("n_rows"), F.count_if(gap).alias("n_tasks_with_gaps")
    )


@query
def feature_model_roundtrip(spark, sf_dir):
    encoded = _encoded(spark, sf_dir)
    lake = LakePaths(fresh_path(spark, "lake"))
    features.fit_features(encoded).write().overwrite().save(lake.features("one"))
    loaded = load_features(lake, "one")
    return _unpacked(
        features.gold_rows(loaded, encoded), features.FEATURES, FEATURE_COUNT, *features.LABELS
    )


@query
def model_roundtrip(spark, sf_dir):
    """How many rows a saved and loaded model predicts exactly as the fitted one."""
    lake = _stored_gold(spark, sf_dir)
    gold = read_gold(spark, lake)
    model = training.fit(training.random_forest("bike_demand", "fitted"), gold)
    path = training_jobs.model_path(lake, "random_forest", "bike_demand", "roundtrip")
    model.write().overwrite().save(path)
    loaded = training_jobs.load_model(lake, "random_forest", "bike_demand", "roundtrip")
    both = loaded.setPredictionCol("loaded").transform(model.transform(features.dense(gold)))
    return both.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("fitted") == F.col("loaded")).alias("n_same"),
    )


@query
def station_names(spark, sf_dir):
    return stations.station_names(testbed.stations(spark, sf_dir))


# -- projections -------------------------------------------------------------------------------------


@query
def harmonize_era1(spark, sf_dir):
    return harmonize.harmonize(_era_1(spark, sf_dir), ERA_1)


@query
def harmonize_era2(spark, sf_dir):
    path = _written_csv(spark, testbed.era_2_rows(spark, sf_dir), "era_2")
    return harmonize.harmonize(scan_csv(spark, path, ERA_2), ERA_2)


@query
def station_id_truncate(spark, sf_dir):
    price = F.col("l_extendedprice").cast("float")
    return testbed.load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", price.alias("raw_id"), truncate_to_int(price).alias("station_id")
    )


@query
def member_flag(spark, sf_dir):
    flag, line = F.col("l_returnflag"), F.col("l_linenumber")
    riders = testbed.load(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(line != 4, F.when(flag == "N", "Customer").otherwise("Subscriber")).alias("usertype"),
        F.when(line != 4, F.when(flag == "N", "casual").otherwise("member")).alias("member_casual"),
    )
    return riders.select(
        "l_orderkey",
        "l_linenumber",
        ERA_1.member().alias("member_era_1"),
        ERA_2.member().alias("member_era_2"),
    )


@query
def trip_legs(spark, sf_dir):
    return demand.trip_legs(testbed.bronze(spark, sf_dir))


@query
def bronze_trip_fact(spark, sf_dir):
    return trips.trip_fact(clean_trips(testbed.raw(spark, sf_dir)))


# -- filters and time text ---------------------------------------------------------------------------


@query
def time_format_slice_counts(spark, sf_dir):
    raw = trips.with_time_format(trips.with_file_name(testbed.raw(spark, sf_dir)))
    return (
        raw.filter(F.col("time_format").isNotNull())
        .groupBy("time_format")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


@query
def drop_null_stations(spark, sf_dir):
    return trips.drop_without_station(testbed.raw(spark, sf_dir)).select(
        "row_number", "start_station_id", "end_station_id"
    )


@query
def unmatched_slice_count(spark, sf_dir):
    return trips.unmatched_files(trips.with_file_name(testbed.raw(spark, sf_dir)))


@query
def file_name_from_path(spark, sf_dir):
    return trips.with_file_name(testbed.raw(spark, sf_dir)).select("row_number", "file_name")


@query
def parse_trip_times(spark, sf_dir):
    raw = trips.with_file_name(testbed.raw(spark, sf_dir))
    return trips.parse_trip_times(raw).select("row_number", "start_time", "end_time")


def _times_as_published(spark, sf_dir) -> DataFrame:
    return testbed.published(testbed.trips(spark, sf_dir)).select(
        "row_number", "file_name", "start_time", "end_time"
    )


@query
def month_shift_repair(spark, sf_dir):
    return trips.repair_shifted_months(_times_as_published(spark, sf_dir))


@query
def month_shift_repair_keeping_time(spark, sf_dir):
    return trips.repair_shifted_months(_times_as_published(spark, sf_dir), preserve_time=True)


# -- unions and the station dimension ----------------------------------------------------------------


@query
def combine_eras(spark, sf_dir):
    return harmonize.combine_eras(*_csv_eras(spark, sf_dir)).select(*TRIP_COLUMNS)


@query
def station_observations(spark, sf_dir):
    return stations.station_observations(testbed.raw(spark, sf_dir))


@query
def station_dimension(spark, sf_dir):
    return stations.station_dimension(stations.station_observations(testbed.raw(spark, sf_dir)))


@query
def station_dimension_whole_row(spark, sf_dir):
    observations = stations.station_observations(testbed.raw(spark, sf_dir))
    return stations.station_dimension(observations, representative="row")


# -- demand ------------------------------------------------------------------------------------------


@query
def hourly_departures(spark, sf_dir):
    return demand.hourly_counts(demand.departures(testbed.bronze(spark, sf_dir)))


@query
def hourly_arrivals(spark, sf_dir):
    return demand.hourly_counts(demand.arrivals(testbed.bronze(spark, sf_dir)))


@query
def hourly_demand(spark, sf_dir):
    return demand.hourly_demand(testbed.bronze(spark, sf_dir))


@query
def hourly_demand_with_gaps(spark, sf_dir):
    return demand.hourly_demand(testbed.bronze(spark, sf_dir, gaps=True))


@query
def hourly_demand_outer_join(spark, sf_dir):
    bronze = testbed.bronze(spark, sf_dir, gaps=True)
    return demand.merge_counts(
        demand.hourly_counts(demand.departures(bronze)), demand.hourly_counts(demand.arrivals(bronze))
    )


@query
def station_enriched(spark, sf_dir):
    return stations.with_coordinates(
        demand.hourly_demand(testbed.bronze(spark, sf_dir)), testbed.stations(spark, sf_dir)
    )


# -- calendar ----------------------------------------------------------------------------------------


def _calendar(spark, sf_dir) -> DataFrame:
    """Calendar parts of every trip's start, next to its row number."""
    starts = testbed.bronze(spark, sf_dir).select("row_number", F.col("start_time").alias("time"))
    return with_calendar_parts(starts)


@query
def time_features(spark, sf_dir):
    return _calendar(spark, sf_dir)


def _marked(rule_of: Callable[[], object]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        unmarked = _calendar(spark, sf_dir).withColumn("is_holiday", F.lit(False))
        return mark_holiday(unmarked, rule_of()).select(
            "row_number", "month", "dayofmonth", "weekday", "is_holiday"
        )

    return run


HOLIDAY_RULES: dict[str, Callable[[], object]] = {
    "holiday_weekend": is_weekend,
    **{f"holiday_{name}": (lambda n=name: is_floating_holiday(n)) for name in FLOATING_HOLIDAYS},
    "holiday_fixed_date": lambda: is_fixed_holiday(7, 4),
    "holiday_fixed_date_observed": lambda: is_fixed_holiday(7, 4, observed=True),
    "holiday_fixed_dates": is_any_fixed_holiday,
    "holiday_all": is_holiday,
}
for _name, _rule in HOLIDAY_RULES.items():
    _run = _marked(_rule)
    _run.__name__ = _name
    query(_run)


@query
def cyclic_encode(spark, sf_dir):
    return _rounded(encode_cycles(_calendar(spark, sf_dir)), *CYCLIC_COLUMNS)


# -- features ----------------------------------------------------------------------------------------


@query
def scaled_features(spark, sf_dir):
    encoded = encode_cycles(_silver(spark, sf_dir, keep_keys=True))
    scaled = features.fit_features(encoded).transform(encoded)
    return _unpacked(scaled, "scaled_features", 11, "station_id", "time")


@query
def onehot_month(spark, sf_dir):
    encoded = encode_cycles(_silver(spark, sf_dir, keep_keys=True))
    return _unpacked(
        features.fit_features(encoded).transform(encoded), "encoded_month", 12, "station_id", "time"
    )


@query
def onehot_weekday(spark, sf_dir):
    encoded = encode_cycles(_silver(spark, sf_dir, keep_keys=True))
    return _unpacked(
        features.fit_features(encoded).transform(encoded), "encoded_weekday", 6, "station_id", "time"
    )


@query
def gold_features(spark, sf_dir):
    encoded = encode_cycles(_silver(spark, sf_dir))
    gold = features.gold_rows(features.fit_features(encoded), encoded)
    return _unpacked(gold, features.FEATURES, FEATURE_COUNT, *features.LABELS)


@query
def silver_null_counts(spark, sf_dir):
    return features.null_counts(
        silver_rows(testbed.bronze(spark, sf_dir, gaps=True), testbed.stations(spark, sf_dir))
    )


# -- evaluation: arrivals as a naive forecast of departures ---------------------------------------------


def _naive_forecast(spark, sf_dir) -> DataFrame:
    return demand.hourly_demand(testbed.bronze(spark, sf_dir))


@query
def eval_rmse(spark, sf_dir):
    naive = _naive_forecast(spark, sf_dir)
    return _rounded(naive.agg(rmse("bike_demand", "dock_demand").alias("rmse")), "rmse")


@query
def eval_r2(spark, sf_dir):
    naive = _naive_forecast(spark, sf_dir)
    return _rounded(naive.agg(r2("bike_demand", "dock_demand").alias("r2")), "r2")


@query
def eval_both(spark, sf_dir):
    naive = _naive_forecast(spark, sf_dir).withColumn("year", F.year("time"))
    return _rounded(evaluate(naive, "bike_demand", "dock_demand", "year"), "rmse", "r2")


# -- training ----------------------------------------------------------------------------------------


@query
def train_split(spark, sf_dir):
    """Rows of stored silver, and those that the split column deals to another part than randomSplit does."""
    path = fresh_path(spark, "silver")
    write_table(_silver(spark, sf_dir, keep_keys=True), path)
    silver = training.in_bounded_partitions(read_table(spark, path))
    parts = silver.randomSplit(list(training.SPLIT_WEIGHTS), 29)
    drawn = reduce(DataFrame.unionByName, [part.withColumn("split", F.lit(name)) for part, name in zip(parts, training.SPLITS, strict=True)])
    ours = training.random_split(silver, seed=29)
    both = ours.withColumn("side", F.lit(1)).unionByName(drawn.withColumn("side", F.lit(-1)))
    per_row = both.groupBy(*ours.columns).agg(F.sum("side").alias("surplus"), F.count_if(F.col("side") == 1).alias("n"))
    return per_row.agg(F.sum("n").alias("n_rows"), F.count_if(F.col("surplus") != 0).alias("n_differ"))


@query
def train_split_keyed(spark, sf_dir):
    keyed = demand.hourly_demand(testbed.bronze(spark, sf_dir)).withColumn(
        "hour_key", F.date_format("time", "yyyy-MM-dd HH")
    )
    return training.keyed_split(keyed, ["station_id", "hour_key"]).select("station_id", "time", "split")


def _keyed_flags(spark, sf_dir, *flags: Column) -> DataFrame:
    """Stored rows of 0/1 features, bike demand and keyed split."""
    silver = _silver(spark, sf_dir, keep_keys=True).withColumn("hour_key", F.date_format("time", "yyyy-MM-dd HH"))
    vector = array_to_vector(F.array(*[f.cast("double") for f in flags])).alias(features.FEATURES)
    rows = training.keyed_split(silver, ["station_id", "hour_key"]).select(vector, "bike_demand", "split")
    path = fresh_path(spark, "flags")
    write_table(rows, path, partition_by=["split"])
    return read_table(spark, path)


def _flag_metrics(family: str, rows: DataFrame, num_trees: int) -> DataFrame:
    """Metrics of an ensemble of trees with one split each."""
    settings = training.TreeSettings(num_trees=num_trees, max_depth=1, subsampling_rate=1.0, min_instances_per_node=1)
    estimator = training.family_of(family).estimator("bike_demand", "predicted_bike_demand", settings)
    if family == "random_forest":
        estimator = estimator.setBootstrap(False)
    return _rounded(training.fit_and_evaluate(estimator, rows)[1], "value")


@query
def train_rf(spark, sf_dir):
    """One tree of one split on the holiday flag: its predictions are the two group means."""
    return _flag_metrics("random_forest", _keyed_flags(spark, sf_dir, F.col("is_holiday")), 1)


@query
def train_gbt(spark, sf_dir):
    """Four boosted trees of one split each, on the holiday flag or the flag of morning hours: each predicts the two means of what
    those before it left over, split by the flag that leaves less."""
    return _flag_metrics("gbt", _keyed_flags(spark, sf_dir, F.col("is_holiday"), F.col("hour") < 12), 4)


def _recomputed(spark, sf_dir, family: str) -> DataFrame:
    """Logged metrics of a full run, and whether metrics worked out anew from its models' predictions agree."""
    lake, run_id = _trained(spark, sf_dir, family)
    logged = read_table(spark, lake.layer(training_jobs.METRICS)).filter(F.col("run_id") == run_id)
    held_out = read_gold(spark, lake).filter(F.col("split") != "train")
    anew = None
    for label, prediction in zip(features.LABELS, forecast.PREDICTIONS, strict=True):
        scored = training_jobs.load_model(lake, family, label, run_id).transform(features.dense(held_out))
        error = F.pow(F.col(label) - F.col(prediction), 2)
        sums = scored.groupBy("split").agg(
            F.sqrt(F.avg(error)).alias("rmse"), (1 - F.sum(error) / (F.var_pop(label) * F.count("*"))).alias("r2")
        )
        rows = sums.unpivot("split", ["rmse", "r2"], "metric", "anew").withColumn("label", F.lit(label))
        anew = rows if anew is None else anew.unionByName(rows)
    near = F.abs(F.col("value") - F.col("anew")) <= 1e-6 * F.greatest(F.lit(1.0), F.abs("anew"))
    return logged.join(anew, ["label", "split", "metric"], "full").select(
        "label", "split", "metric", F.coalesce(near, F.lit(False)).alias("agrees"), "model"
    )


@query
def train_two_targets(spark, sf_dir):
    return _recomputed(spark, sf_dir, "random_forest").drop("model")


@query
def experiment_metrics(spark, sf_dir):
    """Metrics of the runs logged so far whose features and models are stored under their versions."""
    lake, _ = _trained(spark, sf_dir)
    rows = read_table(spark, lake.layer(training_jobs.METRICS))
    ids = rows.groupBy("model", "label", "split", "metric").agg(
        F.count_distinct("run_id").alias("n_runs"), F.count_distinct("features").alias("n_features"),
        F.count_if(F.col("logged_at").isNull() | F.col("value").isNull()).alias("n_null"),
    )
    return ids


@query
def model_version_score(spark, sf_dir):
    """Rows of each year, and those an earlier run predicts as it did before gold and its features were
    fitted again on other rows."""
    lake = _stored_silver(spark, sf_dir, keep_keys=True)
    silver = read_layer(spark, lake.layer("silver"))
    path = fresh_path(spark, "silver")
    write_table(silver, path)
    silver = read_table(spark, path)
    refine_to_gold(spark, lake, "station_id", "time")
    first = training_jobs.train_both(spark, lake, "random_forest")
    keys = ["station_id", "time"]
    before, after = fresh_path(spark, "before"), fresh_path(spark, "after")
    write_table(forecasting.predict(spark, silver, lake, "random_forest").select(*keys, *forecast.PREDICTIONS), before)
    write_layer(silver.filter("year >= 2021"), lake.layer("silver"))
    refine_to_gold(spark, lake, "station_id", "time")
    write_table(
        forecasting.predict(spark, silver, lake, "random_forest", first).select(*keys, *[F.col(p).alias(f"again_{p}") for p in forecast.PREDICTIONS]), after
    )
    both = read_table(spark, before).join(read_table(spark, after), keys)
    same = [F.col(p) == F.col(f"again_{p}") for p in forecast.PREDICTIONS]
    return both.groupBy(F.year("time").alias("year")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(same[0] & same[1]).alias("n_same")
    )


def _walked(spark, rows: DataFrame, keys: list[str], lake: LakePaths, run_id: str) -> DataFrame:
    """keys of rows with calendar parts, coordinates and holiday flag, and both predictions by walking the saved trees."""
    run = training_jobs.latest_run(spark, lake, "random_forest", run_id)
    out = load_features(lake, run.features).transform(encode_cycles(rows)).select(*keys, features.FEATURES)
    for label in features.LABELS:
        nodes = trees.node_table(spark, training_jobs.model_path(lake, "random_forest", label, run_id))
        out = trees.walk(out, nodes, features.FEATURES, f"walked_{label}", average=True)
    return out.drop(features.FEATURES)


def _agrees(within: float) -> Column:
    """Whether both predictions are the walked ones."""
    parts = [F.abs(F.col(p) - F.col(f"walked_{label}")) <= within for label, p in zip(features.LABELS, forecast.PREDICTIONS, strict=True)]
    return F.coalesce(parts[0] & parts[1], F.lit(False)).alias("agrees")


@query
def score_both_targets(spark, sf_dir):
    """Both predictions of every silver row, and whether they are what its leaves in the saved trees say."""
    lake, run_id = _trained(spark, sf_dir)
    silver = read_layer(spark, lake.layer("silver"))
    scored = forecasting.predict(spark, silver, lake, "random_forest", run_id)
    walked = _walked(spark, silver, ["station_id", "time"], lake, run_id)
    return scored.join(walked, ["station_id", "time"], "left").select("station_id", "time", *features.LABELS, _agrees(1e-9))


def _forecast_agrees(spark, rows: DataFrame, lake: LakePaths, run_id: str) -> DataFrame:
    """Forecast rows, and whether they are the rounded predictions that walking the saved trees gives for their hour."""
    path = fresh_path(spark, "forecast")
    write_table(rows.withColumn("hour_time", F.date_trunc("hour", "time")), path)
    stored = read_table(spark, path)
    keys = ["latitude", "longitude", "hour_time", "is_holiday"]
    asked = stored.select(*keys).distinct().withColumn("time", F.col("hour_time"))
    walked = _walked(spark, with_calendar_parts(asked, keep_time=True), keys, lake, run_id)
    found = stored.join(walked, keys, "left")
    # A prediction that lies on the half of a number may be rounded either way by the last bit of a sum.
    return found.withColumn("agrees", _agrees(0.5 + 1e-9))


# -- forecast ----------------------------------------------------------------------------------------


@query
def station_lookup(spark, sf_dir):
    return stations.lookup_by_name(
        testbed.requests(spark, sf_dir), _points(spark, sf_dir)
    ).select("event_id", "station_name", "latitude", "longitude")


@query
def forecast_horizon(spark, sf_dir):
    hours = forecast.with_horizon(testbed.requests(spark, sf_dir))
    text = forecast.format_time(hours).withColumn("time_text", F.col("time"))
    return forecast.parse_time_text(text).select("event_id", "time_text", "time")


def _grid(spark, sf_dir, holiday: str = "flag") -> DataFrame:
    return forecast.forecast_grid(
        testbed.requests(spark, sf_dir), _points(spark, sf_dir), holiday
    )


@query
def forecast_grid(spark, sf_dir):
    return _grid(spark, sf_dir).select("event_id", "latitude", "longitude", "time", "is_holiday")


@query
def forecast_grid_calendar(spark, sf_dir):
    return _grid(spark, sf_dir, "calendar").select(
        "event_id", "latitude", "longitude", "time", "is_holiday"
    )


@query
def forecast_features(spark, sf_dir):
    fitted = features.fit_features(_encoded(spark, sf_dir))
    rows = forecast.forecast_features(_grid(spark, sf_dir), fitted)
    return _unpacked(rows, features.FEATURES, FEATURE_COUNT, "event_id", "time")


@query
def forecast_round(spark, sf_dir):
    return forecast.round_predictions(
        testbed.load(spark, sf_dir, "lineitem").select(
            "l_orderkey",
            "l_linenumber",
            (F.col("l_quantity") / 2).alias("predicted_bike_demand"),
            (F.col("l_quantity") / 4).alias("predicted_dock_demand"),
        )
    )


@query
def forecast_unify(spark, sf_dir):
    """Half of each hour's count stands for its prediction."""
    bronze = testbed.bronze(spark, sf_dir)
    bike = demand.hourly_counts(demand.departures(bronze)).select(
        *demand.KEYS, (F.col("count") / 2).alias("predicted_bike_demand")
    )
    dock = demand.hourly_counts(demand.arrivals(bronze)).select(
        *demand.KEYS, (F.col("count") / 2).alias("predicted_dock_demand")
    )
    return forecast.unify_forecasts(bike, dock)


@query
def forecast_demand(spark, sf_dir):
    lake, run_id = _trained(spark, sf_dir)
    rows = forecasting.forecast(spark, lake, testbed.requests(spark, sf_dir), run_id=run_id)
    return _forecast_agrees(spark, rows, lake, run_id).select("event_id", "station_name", "time", "agrees")


@query
def forecast_every_station(spark, sf_dir):
    """Every station's next day, starting at the last departure seen anywhere."""
    lake, run_id = _trained(spark, sf_dir)
    last = read_layer(spark, lake.layer("bronze")).agg(F.max("start_time").alias("start")).first().start
    rows = forecasting.forecast(spark, lake, holiday="calendar", start=F.lit(last), run_id=run_id)
    return _forecast_agrees(spark, rows, lake, run_id).select("station_id", "time", "is_holiday", "agrees")


# -- jobs --------------------------------------------------------------------------------------------


@query
def job_ingest(spark, sf_dir):
    lake = LakePaths(fresh_path(spark, "lake"))
    testbed.write_csv(testbed.era_1_rows(spark, sf_dir), lake.csv("era_1"))
    testbed.write_csv(testbed.era_2_rows(spark, sf_dir), lake.csv("era_2"))
    ingest(spark, lake)
    return read_layer(spark, lake.layer("raw")).select(*TRIP_COLUMNS)


@query
def job_bronze(spark, sf_dir):
    lake = LakePaths(fresh_path(spark, "lake"))
    write_layer(testbed.raw(spark, sf_dir), lake.layer("raw"))
    refine_to_bronze(spark, lake)
    bronze = read_layer(spark, lake.layer("bronze"))
    station = read_layer(spark, lake.layer("station"))
    return stations.with_coordinates(
        bronze.withColumnRenamed("start_station_id", "station_id"), station, keep_keys=True
    ).withColumnRenamed("station_id", "start_station_id")


@query
def job_silver(spark, sf_dir):
    lake = _stored_silver(spark, sf_dir)
    return read_layer(spark, lake.layer("silver"))


@query
def job_gold(spark, sf_dir):
    lake = _stored_gold(spark, sf_dir)
    return _unpacked(read_gold(spark, lake), features.FEATURES, FEATURE_COUNT, *features.LABELS)


@query
def job_train(spark, sf_dir):
    return _recomputed(spark, sf_dir, "random_forest")


@query
def job_chain(spark, sf_dir):
    """Raw trips to forecasts through every layer, unreadable times rejected: one row of what each layer holds."""
    lake = LakePaths(fresh_path(spark, "lake"))
    write_layer(testbed.raw(spark, sf_dir), lake.layer("raw"))
    refine_to_bronze(spark, lake)
    refine_to_silver(spark, lake, unreadable="reject")
    refine_to_gold(spark, lake)
    run_id = training_jobs.train_both(spark, lake)
    rows = forecasting.forecast(spark, lake, start=F.lit("2024-01-01 08:00:00").cast("timestamp"), holiday="calendar")
    rows = _forecast_agrees(spark, rows, lake, run_id)
    counted = [read_layer(spark, lake.layer(n)).agg(F.count("*").alias(f"n_{n}")) for n in ("raw", "bronze", "rejects", "silver", "station")]
    counted += [read_gold(spark, lake).agg(F.count("*").alias("n_gold")), rows.agg(F.count_if("agrees").alias("n_forecast"))]
    first, *rest = [c.withColumn("one", F.lit(1)) for c in counted]  # a row each
    for other in rest:
        first = first.join(other, "one")
    return first.drop("one")


@query
def streamed_demand(spark, sf_dir):
    """Hourly demand from a stream of trip files in two runs: half of the files, then all, in batches of three."""
    trips_at, out, checkpoint = (fresh_path(spark, name) for name in ("arrivals", "streamed", "checkpoint"))
    rows = testbed.bronze(spark, sf_dir)
    for part in (0, 1):  # the later half of the trips arrives first
        arriving = rows.filter((F.year("start_time") < 2017) == (part == 1)).repartition(4, "row_number")
        write_table(arriving, f"{trips_at}/part={part}", options=TRIP_FILE_OPTIONS)
        source = f"{trips_at}/part=*"
        demand_stream.stream_hourly_demand(spark, source, rows.schema, out, checkpoint, lateness="6000 days", files_per_batch=3).awaitTermination()
    return demand_stream.streamed_hourly_demand(spark, out)


@query
def monthly_silver(spark, sf_dir):
    """Silver by month: all months without the last, then that one alone, when its trips have come."""
    lake = LakePaths(fresh_path(spark, "lake"))
    rows = testbed.bronze(spark, sf_dir)
    last = rows.agg(F.date_format(F.max("end_time"), "yyyy-MM").alias("month"), F.trunc(F.max("end_time"), "month").alias("first")).first()
    write_layer(testbed.stations(spark, sf_dir), lake.layer("station"))
    write_layer(rows.filter(F.col("end_time") < F.lit(last["first"])), lake.layer("bronze"))
    refine_months_to_silver(spark, lake)
    write_layer(rows, lake.layer("bronze"))
    before = rows.filter(F.col("end_time") >= F.lit(last["first"])).agg(F.date_format(F.min("start_time"), "yyyy-MM").alias("month")).first()
    refine_months_to_silver(spark, lake, sorted({before["month"], last["month"]}))
    return read_monthly_silver(spark, lake)
