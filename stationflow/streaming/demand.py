"""Hourly demand as a stream of trip files: counts grow while files arrive, and a late file changes the hours it belongs to.

The query keeps one count for each station and hour until the watermark has passed the hour. Each micro-batch writes the hours
it changed to a folder of its own, whole, so a batch that is run again after a failure replaces what it wrote before. A reader takes the
last batch of each hour. Files that a finished run has seen aren't read again by the next one with the same checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stationflow.operators.demand import trip_legs
from stationflow.sources.tables import DEFAULT_FORMAT, read_table, write_table

#: How long after the newest trip seen an hour still takes trips; what comes later is dropped.
LATENESS = "45 days"


def changed_hours(trips: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Streaming ``hourly_demand``: station_id, time, bike_demand, dock_demand of all open hours.

    Each leg of a trip is counted in its own hour, and both sides meet in one state. A station that is NULL counts as
    station 0, apart from its own 0, as in the batch form. Legs without a time have no window and are left out.
    """
    legs = trip_legs(trips).withWatermark("time", lateness)
    side = F.when(F.col("station_id").isNull(), F.col("is_start")).alias("unmatched_side")
    counted = legs.groupBy(F.window("time", "1 hour").alias("hour"), "station_id", side).agg(
        F.count(F.when(F.col("is_start"), F.col("row_number"))).alias("bike_demand"),
        F.count(F.when(~F.col("is_start"), F.col("row_number"))).alias("dock_demand"),
    )
    return counted.select(
        F.coalesce("station_id", F.lit(0)).alias("station_id"), F.col("hour.start").alias("time"), "unmatched_side", "bike_demand", "dock_demand"
    )


def stream_hourly_demand(
    spark: SparkSession,
    source: str,
    schema: str,
    out: str,
    checkpoint: str,
    lateness: str = LATENESS,
    files_per_batch: int | None = None,
    fmt: str = DEFAULT_FORMAT,
) -> StreamingQuery:
    """Count all trip files that are in ``source`` now and weren't there in an earlier run, then stop."""
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    changed = changed_hours(reader.load(source), lateness)

    def keep(rows: DataFrame, batch: int) -> None:
        write_table(rows.withColumn("batch", F.lit(batch).cast("long")), f"{out}/batch={batch}", fmt)

    return (
        changed.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def streamed_hourly_demand(spark: SparkSession, out: str, fmt: str = DEFAULT_FORMAT) -> DataFrame:
    """The demand as of the last batch: of each hour what the last batch that changed it wrote."""
    rows = read_table(spark, f"{out}/*", fmt)
    # One maximum a column, as their buffers are numbers and so hashed; a struct's would be sorted. A batch has an hour once.
    last = [F.max_by(c, "batch").alias(c) for c in ("bike_demand", "dock_demand")]
    return rows.groupBy("station_id", "time", "unmatched_side").agg(*last).drop("unmatched_side")
