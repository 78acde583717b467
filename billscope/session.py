"""Session settings for jobs that start their own session."""

from __future__ import annotations

import math

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Columns take about three times their file size in memory; broadcasts are chosen by that size.
    "spark.sql.sources.fileCompressionFactor": "3.0",
    "spark.sql.session.timeZone": "UTC",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
}
PARTITION_BYTES = 512 * 1024**2
MOST_PARTITIONS = 100_000


def shuffle_partitions(input_bytes: int, cores: int) -> int:
    """Shuffle partitions for an input of this size, at least one per core.

    Too many cost little, as adaptive execution joins small ones; too few spill, as it cannot split a
    partition of an aggregate.
    """
    return max(cores, min(MOST_PARTITIONS, math.ceil(input_bytes / PARTITION_BYTES)))


def build_session(
    app: str = "billscope",
    master: str | None = None,
    input_bytes: int | None = None,
    cores: int = 200,
    **settings: str,
) -> SparkSession:
    """Start a session, sized for ``input_bytes`` of input where that is known.

    ``settings`` use ``__`` for dots and come last: ``spark__sql__shuffle__partitions="2000"``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    chosen = dict(SETTINGS)
    if input_bytes is not None:
        chosen["spark.sql.shuffle.partitions"] = str(shuffle_partitions(input_bytes, cores))
    chosen.update({key.replace("__", "."): value for key, value in settings.items()})
    for key, value in chosen.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
