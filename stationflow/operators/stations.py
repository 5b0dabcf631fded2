"""The station dimension and its joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATION_FIELDS = ("id", "name", "latitude", "longitude")


def _ends(side: str):
    return [F.col(f"{side}_station_{field}").alias(field) for field in STATION_FIELDS]


def station_observations(trips: DataFrame) -> DataFrame:
    """(id, name, latitude, longitude) as seen at the start and at the end of every trip."""
    both = F.array(F.struct(*_ends("start")), F.struct(*_ends("end")))
    return trips.select(F.explode(both).alias("end")).select("end.*")


def station_dimension(observations: DataFrame, representative: str = "independent") -> DataFrame:
    """One row per station id.

    By default name, latitude and longitude take their own minimum, so they may stem from different
    observations. ``representative="row"`` keeps one whole observation: the smallest that has a name.

    A minimum over text or structs makes Spark sort every input row, so a first aggregation with
    numeric minima only, which hashes and combines in each task, reduces the rows before it.
    """
    if representative == "independent":
        per_name = observations.groupBy("id", "name").agg(
            F.min("latitude").alias("latitude"), F.min("longitude").alias("longitude")
        )
        return per_name.groupBy("id").agg(
            *[F.min(field).alias(field) for field in STATION_FIELDS if field != "id"]
        )
    if representative == "row":
        # Names first: a hashed count per (id, name) leaves few rows for the text minimum. The names then meet
        # the observations again, of which only those of an id's name go on to the minimum over points.
        names = observations.groupBy("id", "name").agg(F.count("*").alias("n")).groupBy("id").agg(F.min("name").alias("first"))
        names = names.select(F.col("id").alias("of"), "first")
        same = F.col("id").eqNullSafe(F.col("of")) & F.col("name").eqNullSafe(F.col("first"))
        chosen = observations.join(names, same, "left_semi")
        per_point = chosen.groupBy("id", "name", "latitude").agg(F.min("longitude").alias("longitude"))
        seen = F.min(F.struct("latitude", "longitude")).alias("seen")
        return per_point.groupBy("id", "name").agg(seen).select("id", "name", "seen.*")
    raise ValueError(f"representative must be 'independent' or 'row', not {representative!r}")


def station_names(stations: DataFrame) -> DataFrame:
    return stations.select("name")


def with_coordinates(demand: DataFrame, stations: DataFrame, keep_keys: bool = False) -> DataFrame:
    """Latitude and longitude of each row's station, NULL for an unknown one.

    No broadcast is forced: Spark broadcasts the stations while their size is under
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffles on the id, splitting hot ids, beyond it.
    """
    points = stations.select(F.col("id").alias("station_id"), "latitude", "longitude")
    joined = demand.join(points, "station_id", "left")
    return joined if keep_keys else joined.drop("station_id")


def station_points(stations: DataFrame) -> DataFrame:
    """One row per station name: station_name, station_id and coordinates of the lowest id that bears it."""
    return (
        stations.filter(F.col("name").isNotNull())
        .groupBy(F.col("name").alias("station_name"))
        .agg(F.min(F.struct("id", "latitude", "longitude")).alias("point"))
        .select("station_name", F.col("point.id").alias("station_id"), "point.latitude", "point.longitude")
    )


def lookup_by_name(requests: DataFrame, points: DataFrame) -> DataFrame:
    """Coordinates for each request's station name; requests for unknown names drop out.

    ``points`` is a stored table of ``station_points``: both sides are then plain scans under their
    shuffles, which is what lets AQE split a name that most requests ask for.
    """
    return requests.join(points, "station_name", "inner")
