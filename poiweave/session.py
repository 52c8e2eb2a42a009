"""Session settings the jobs are designed for.

AQE does the run-time work: it merges small shuffle partitions, splits the skewed side
of a join when one title holds much of the rows, and lays out output partitions.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Shuffles start with many partitions and AQE joins small ones, so large runs need no setting.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "2000",
    # Hash joins only where every partition's build side is small.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
}


def build_session(app_name: str = "poiweave", **extra: str) -> SparkSession:
    """A session with the settings above; ``extra`` overrides them."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
