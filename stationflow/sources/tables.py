"""Layer tables. ``fmt`` may name any installed source, such as delta.

A plain overwrite of a Parquet folder deletes before it writes, so a job that breaks off leaves neither the old rows nor
the new. A layer is therefore a folder of versions and a log of commits: rows are written to a version of their own, and one
appended log row, moved into place as a whole when its job commits, makes it the current one. Readers see the old version until then.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_FORMAT = "parquet"
COMMITS = "number long, version string, committed_at timestamp"


def read_table(spark: SparkSession, path: str, fmt: str = DEFAULT_FORMAT) -> DataFrame:
    return spark.read.format(fmt).load(path)


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = DEFAULT_FORMAT,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    options: Mapping[str, str] | None = None,
) -> None:
    writer = df.write.format(fmt).mode(mode).options(**(options or {}))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def version_path(layer: str, version: str) -> str:
    return f"{layer}/versions/{version}"


def write_layer(
    df: DataFrame, layer: str, fmt: str = DEFAULT_FORMAT, partition_by: Sequence[str] = (), version: str | None = None
) -> str:
    """Write df as a new version of a layer, then make it the current one. Returns the version."""
    version = version or uuid.uuid4().hex
    write_table(df, version_path(layer, version), fmt, partition_by=partition_by)
    commit_layer(df.sparkSession, layer, version, fmt)
    return version


def commit_layer(spark: SparkSession, layer: str, version: str, fmt: str = DEFAULT_FORMAT) -> None:
    """Make a complete version the current one."""
    last = _commits(spark, layer, fmt)
    number = 0 if last is None else last.number + 1
    row = spark.range(1).coalesce(1).select(F.lit(number).cast("long").alias("number"), F.lit(version).alias("version"), F.current_timestamp().alias("committed_at"))
    write_table(row, f"{layer}/commits", fmt, mode="append")


def _commits(spark: SparkSession, layer: str, fmt: str):
    """The last commit of a layer (of two at once, the later one), or None."""
    reader = spark.read.format(fmt)
    try:  # naming the columns of plain files saves a look into them
        log = (reader.schema(COMMITS) if fmt == DEFAULT_FORMAT else reader).load(f"{layer}/commits")
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    return log.orderBy(F.desc("number"), F.desc("committed_at"), F.desc("version")).first()


def layer_version(spark: SparkSession, layer: str, fmt: str = DEFAULT_FORMAT) -> str:
    """The current version of a layer."""
    last = _commits(spark, layer, fmt)
    if last is None:
        raise LookupError(f"nothing committed to {layer}")
    return last.version


def read_layer(spark: SparkSession, layer: str, fmt: str = DEFAULT_FORMAT, version: str | None = None) -> DataFrame:
    """Rows of a layer's current version, or of the one named."""
    return read_table(spark, version_path(layer, version or layer_version(spark, layer, fmt)), fmt)
