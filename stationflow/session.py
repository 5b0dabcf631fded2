"""Session factory and the shared folder every intermediate table is written to."""

from __future__ import annotations

import math
import tempfile
import uuid
import warnings
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.legacy.timeParserPolicy": "CORRECTED",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Beyond 2000 partitions shuffles report mean block sizes, which hides hot keys from AQE. Blocks of five times the
    # median and more are reported exactly with this; it holds for sessions started with it only.
    "spark.shuffle.accurateBlockSkewedFactor": "5.0",
}

# Partitions up to which shuffles report every block's size anyway.
EXACT_SIZES_UP_TO = 2000

# A shuffle partition of this size fits an executor core's share of memory with room for its sort or hash.
SHUFFLE_PARTITION_MB = 128
# A shuffle without a size given starts with the partitions of this one; AQE merges what is too small.
DEFAULT_SHUFFLE_GB = 512


def build_session(
    app_name: str = "stationflow",
    master: str | None = None,
    shuffle_gb: float | None = None,
    **conf: str,
) -> SparkSession:
    """Session with the defaults above. On a cluster leave ``master`` to spark-submit.

    ``shuffle_gb``, the expected size of the largest shuffle, sets how many partitions shuffles start
    with; AQE merges what turns out too small, but splits no aggregation that starts with too few. So the
    default is high; naming ``spark.sql.shuffle.partitions`` instead takes that number.

    A session that already runs is returned as it is.
    """
    running = SparkSession.getActiveSession()
    if running is not None:
        if not sees_skew(running):
            warnings.warn("AQE can't see hot keys: start the session with spark.shuffle.accurateBlockSkewedFactor", stacklevel=2)
        return running
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    if shuffle_gb is not None or "spark.sql.shuffle.partitions" not in conf:
        partitions = math.ceil((shuffle_gb or DEFAULT_SHUFFLE_GB) * 1024 / SHUFFLE_PARTITION_MB)
        builder = builder.config(
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(partitions)
        )
    for key, value in {**SESSION_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def sees_skew(spark: SparkSession) -> bool:
    """Whether AQE splits hot keys of joins in this session: it must be on and know the sizes of shuffled blocks."""
    on = all(spark.conf.get(f"spark.sql.adaptive.{key}", "true") == "true" for key in ("enabled", "skewJoin.enabled"))
    partitions = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) or spark.conf.get("spark.sql.shuffle.partitions", "200")
    exact = float(spark.sparkContext.getConf().get("spark.shuffle.accurateBlockSkewedFactor", "-1")) > 0
    return on and (exact or int(partitions) <= EXACT_SIZES_UP_TO)


def run_together(spark: SparkSession, *jobs: Callable[[], object], at_once: int | None = None) -> list:
    """Run independent jobs at once (or so many of them), so that one fills the cores that another leaves idle; results in order."""
    with ThreadPoolExecutor(min(len(jobs), at_once or len(jobs))) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]]


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can read: the session's ``spark.checkpoint.dir``.

    Only a local-mode session without the setting (tests) gets a folder of its own; on a cluster a
    machine-local folder would be lost with its machine, so the missing setting is an error there.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can read")
        folder = tempfile.mkdtemp(prefix="stationflow-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
