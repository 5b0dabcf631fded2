"""Trips, stations and forecast requests derived from the benchmark tables by row-wise arithmetic.

Every line item is one trip. Its ship date is stretched from 7 to 11.4 years (40 hours a day, from
June 2013), so all file months, time formats and holidays occur; order and part keys spread the
minutes and seconds. Supplier and part keys give the two stations. No join or shuffle is involved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.functions.timetext import ISO_SECONDS, US_MINUTES, US_SECONDS, time_format_of
from stationflow.operators.stations import station_dimension, station_observations

FIRST_DAY = "2013-06-01"
FIRST_EPOCH_SECOND = 1370044800
STATION_COUNT = 500
FIRST_STATION_ID = 100
ERA_2_YEAR = 2020


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def _latitude(station_id: Column, jitter: Column) -> Column:
    return ((F.lit(406000) + station_id * 5 + jitter).cast("double") / 10000).cast("float")


def _longitude(station_id: Column, jitter: Column) -> Column:
    return ((F.lit(-740000) + station_id * 3 - jitter).cast("double") / 10000).cast("float")


def station_name(station_id: Column) -> Column:
    return F.concat(F.lit("Station "), station_id.cast("string"))


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed trips, one per line item."""
    days = F.datediff(F.col("l_shipdate").cast("date"), F.lit("1995-01-01").cast("date"))
    seconds = (
        days.cast("long") * 144000 + F.col("l_orderkey") % 1440 * 60 + F.col("l_partkey") % 60
    )
    duration = F.lit(120) + (F.col("l_quantity") * 60).cast("long") + F.col("l_suppkey") % 60
    df = load(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("row_number"),
        F.timestamp_seconds(F.lit(FIRST_EPOCH_SECOND) + seconds).alias("start_time"),
        F.timestamp_seconds(F.lit(FIRST_EPOCH_SECOND) + seconds + duration).alias("end_time"),
        (FIRST_STATION_ID + F.col("l_suppkey") % STATION_COUNT).cast("int").alias("start_station_id"),
        (FIRST_STATION_ID + F.col("l_partkey") % STATION_COUNT).cast("int").alias("end_station_id"),
        F.col("l_linenumber").alias("line"),
        F.col("l_returnflag").alias("flag"),
    )
    return df


def bronze(spark: SparkSession, sf_dir: str, gaps: bool = False) -> DataFrame:
    """Typed trip fact. ``gaps`` blanks some times and station ids."""
    df = trips(spark, sf_dir)
    if gaps:
        df = df.withColumns(
            {
                "start_time": F.when(F.col("line") != 3, F.col("start_time")),
                "end_time": F.when(F.col("line") != 5, F.col("end_time")),
                "start_station_id": F.when(
                    ~((F.col("line") == 7) & (F.col("flag") == "A")), F.col("start_station_id")
                ),
                "end_station_id": F.when(
                    ~((F.col("line") == 7) & (F.col("flag") == "R")), F.col("end_station_id")
                ),
            }
        )
    return df.select("start_time", "end_time", "start_station_id", "end_station_id", "row_number")


def published(df: DataFrame) -> DataFrame:
    """Add the file a trip was published in, and its times as that file shows them.

    Trips of the August 2021 file with flag R are dated one month early; line 6 with flag N comes from
    files whose name starts with no month.
    """
    month = F.date_format("start_time", "yyyyMM")
    prefix = F.when((F.col("line") == 6) & (F.col("flag") == "N"), F.lit("JC-")).otherwise(F.lit(""))
    early = (month == "202108") & (F.col("flag") == "R")
    named = df.withColumn("file_name", F.concat(prefix, month, F.lit("-trips.csv")))
    return named.withColumns(
        {
            c: F.when(early, F.col(c) - F.expr("INTERVAL 1 MONTH")).otherwise(F.col(c))
            for c in ("start_time", "end_time")
        }
    )


def _text(time: Column, file_name: Column) -> Column:
    fmt = time_format_of(F.substring_index(file_name, "JC-", -1))
    return (
        F.when(fmt == ISO_SECONDS.name, F.date_format(time, "yyyy-MM-dd HH:mm:ss.SSSS"))
        .when(fmt == US_MINUTES.name, F.date_format(time, "M/d/yyyy H:mm"))
        .when(fmt == US_SECONDS.name, F.date_format(time, "M/d/yyyy HH:mm:ss"))
    )


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw layer: text times, station text, lineage. Line 7 with flag A has no start station, line 7
    with flag N no readable end time."""
    shown = published(trips(spark, sf_dir))
    lost = (F.col("line") == 7) & (F.col("flag") == "A")
    unreadable = (F.col("line") == 7) & (F.col("flag") == "N")
    start_id, end_id, line = F.col("start_station_id"), F.col("end_station_id"), F.col("line")
    file_name = F.col("file_name")
    return shown.select(
        _text(F.col("start_time"), file_name).alias("start_time"),
        F.when(unreadable, F.lit("unknown"))
        .otherwise(_text(F.col("end_time"), file_name))
        .alias("end_time"),
        F.when(~lost, station_name(start_id)).alias("start_station_name"),
        F.when(~lost, _latitude(start_id, line)).alias("start_station_latitude"),
        F.when(~lost, _longitude(start_id, line)).alias("start_station_longitude"),
        station_name(end_id).alias("end_station_name"),
        _latitude(end_id, line).alias("end_station_latitude"),
        _longitude(end_id, line).alias("end_station_longitude"),
        F.when(~lost, start_id).alias("start_station_id"),
        end_id.alias("end_station_id"),
        F.when(F.col("flag") == "N", 0).otherwise(1).alias("member"),
        "row_number",
        F.concat(F.lit("/lake/trips/"), file_name).alias("file_path"),
    )


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station dimension of the typed trips."""
    df = trips(spark, sf_dir)
    line = F.col("line")
    ends = [
        expr
        for side in ("start", "end")
        for expr in (
            F.col(f"{side}_station_id"),
            station_name(F.col(f"{side}_station_id")).alias(f"{side}_station_name"),
            _latitude(F.col(f"{side}_station_id"), line).alias(f"{side}_station_latitude"),
            _longitude(F.col(f"{side}_station_id"), line).alias(f"{side}_station_longitude"),
        )
    ]
    return station_dimension(station_observations(df.select(*ends)))


def era_1_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips before 2020 in the first file generation's columns, as text and numbers to write as CSV.
    Line 7 with flag A carries a station id that is no number; line 4 has no rider type."""
    df = trips(spark, sf_dir).filter(F.year("start_time") < ERA_2_YEAR)
    start_id, end_id, line = F.col("start_station_id"), F.col("end_station_id"), F.col("line")
    time_text = "yyyy-MM-dd HH:mm:ss.SSSS"
    return df.select(
        (F.unix_timestamp("end_time") - F.unix_timestamp("start_time")).cast("int").alias("tripduration"),
        F.date_format("start_time", time_text).alias("starttime"),
        F.date_format("end_time", time_text).alias("stoptime"),
        F.when((line == 7) & (F.col("flag") == "A"), F.lit("SYS033"))
        .otherwise(start_id.cast("string"))
        .alias("start station id"),
        station_name(start_id).alias("start station name"),
        _latitude(start_id, line).alias("start station latitude"),
        _longitude(start_id, line).alias("start station longitude"),
        end_id.cast("string").alias("end station id"),
        station_name(end_id).alias("end station name"),
        _latitude(end_id, line).alias("end station latitude"),
        _longitude(end_id, line).alias("end station longitude"),
        (F.col("row_number") % 40000).cast("int").alias("bikeid"),
        F.when(line == 4, F.lit(None))
        .when(F.col("flag") == "N", F.lit("Customer"))
        .otherwise(F.lit("Subscriber"))
        .alias("usertype"),
        F.lit(1980).alias("birth year"),
        line.alias("gender"),
    )


def era_2_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips from 2020 on in the second file generation's columns. Station ids carry a fraction; line 7
    with flag A carries one that is no number; line 4 has no rider type."""
    df = trips(spark, sf_dir).filter(F.year("start_time") >= ERA_2_YEAR)
    start_id, end_id, line = F.col("start_station_id"), F.col("end_station_id"), F.col("line")
    time_text = "yyyy-MM-dd HH:mm:ss"
    return df.select(
        F.hex("row_number").alias("ride_id"),
        F.lit("classic_bike").alias("rideable_type"),
        F.date_format("start_time", time_text).alias("started_at"),
        F.date_format("end_time", time_text).alias("ended_at"),
        station_name(start_id).alias("start_station_name"),
        F.when((line == 7) & (F.col("flag") == "A"), F.lit("SYS033"))
        .otherwise(F.concat(start_id.cast("string"), F.lit(".15")))
        .alias("start_station_id"),
        station_name(end_id).alias("end_station_name"),
        F.concat(end_id.cast("string"), F.lit(".04")).alias("end_station_id"),
        _latitude(start_id, line).alias("start_lat"),
        _longitude(start_id, line).alias("start_lng"),
        _latitude(end_id, line).alias("end_lat"),
        _longitude(end_id, line).alias("end_lng"),
        F.when(line == 4, F.lit(None))
        .when(F.col("flag") == "N", F.lit("casual"))
        .otherwise(F.lit("member"))
        .alias("member_casual"),
    )


def write_csv(df: DataFrame, path: str, by_month: bool = False) -> None:
    """Trip files in ``path``, or one folder per month of the trips' start in it.

    The rebalance gives a month about one task, and splits a month too large for one.
    """
    if not by_month:
        df.write.csv(path, header=True)
        return
    time = "starttime" if "starttime" in df.columns else "started_at"
    month = F.regexp_replace(F.substring(F.col(time), 1, 7), "-", "")
    monthly = df.withColumn("file_month", month).hint("rebalance", "file_month")
    monthly.write.partitionBy("file_month").csv(path, header=True)


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecast requests: every event asks for the station named by its ``k``, from its own time on,
    with the holiday box ticked for purchases."""
    k = F.get_json_object("props", "$.k").cast("int")
    df = load(spark, sf_dir, "events").select(
        "event_id",
        station_name(FIRST_STATION_ID + k).alias("station_name"),
        F.col("ts").cast("timestamp").alias("start"),
        (F.col("event_type") == "purchase").cast("int").alias("is_holiday"),
    )
    return df
